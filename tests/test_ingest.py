"""Ingestion edge rows: nested pages, NULL user / recording, duplicates,
empty feeds, artifacts named by string id, language merge, history append."""

import json

from pyspark.sql import functions as F

from callweave import schemas
from callweave.operators import ingest, worklist
from callweave.sources.feed import read_pages

USER = {"id": 7, "name": "Ada", "email": "ada@host.example", "available": True}


def call(i, started=1_700_000_000, answered=1_700_000_005, recording="r.mp3", user=USER):
    return {"id": i, "number": {"id": 1, "name": "Main"}, "started_at": started,
            "answered_at": answered, "ended_at": started + 60, "direction": "inbound",
            "recording": recording, "user": user}


def land(tmp_path, pages):
    folder = tmp_path / "pages"
    folder.mkdir()
    for n, calls in enumerate(pages):
        link = None if n == len(pages) - 1 else f"https://host.example/p{n + 1}"
        (folder / f"page-{n:03d}.json").write_text(
            json.dumps({"calls": calls, "meta": {"next_page_link": link}}, indent=2))
    return str(folder)


def test_flatten_edge_rows(spark, tmp_path):
    pages = [
        [call(1), call(2, user=None), call(3, recording=None)],
        [call(4, answered=None), call(1)],                      # id 1 again on page 2
        [],                                                     # empty page
    ]
    flat = ingest.flatten_calls(read_pages(spark, land(tmp_path, pages)))
    assert flat.schema == schemas.FLAT_CALL
    rows = {r.id: r for r in flat.collect() if r.id != 1}
    assert [r.id for r in flat.collect()].count(1) == 2          # kept twice by default
    no_user = rows[2]
    assert (no_user.user_id, no_user.user_name, no_user.user_email, no_user.user_available) == \
        ("null",) * 4
    assert rows[4].user_id == "7" and rows[4].user_available == "true"

    rec = ingest.call_timestamps(ingest.recorded_calls(flat))
    ids = sorted(r.id for r in rec.collect())
    assert ids == [1, 1, 2, 4]                                   # NULL recording dropped
    missed = rec.where("id = 4").first()
    assert missed.answered_at_ts is None and missed.started_at_ts is not None

    deduped = ingest.flatten_calls(read_pages(spark, str(tmp_path / "pages")), dedupe_on_id=True)
    assert deduped.where("id = 1").count() == 1


def test_present_user_with_missing_field_keeps_null(spark, tmp_path):
    u = dict(USER, email=None)
    flat = ingest.flatten_calls(read_pages(spark, land(tmp_path, [[call(9, user=u)]])))
    r = flat.first()
    assert r.user_email is None and r.user_name == "Ada"


def test_empty_feed_keeps_schema(spark, tmp_path):
    flat = ingest.flatten_calls(read_pages(spark, land(tmp_path, [[]])))
    assert flat.count() == 0 and flat.schema == schemas.FLAT_CALL
    none = spark.createDataFrame([], schemas.PAGE)
    hist = ingest.history_rows(ingest.call_timestamps(ingest.recorded_calls(
        ingest.flatten_calls(none))))
    assert hist.count() == 0
    assert [f.name for f in hist.schema.fields] == [f.name for f in schemas.HISTORY.fields][:-1]


def test_epoch_to_timestamp_is_utc_wall_clock(spark):
    df = spark.createDataFrame([(0,), (1_700_000_000,), (None,)], "e bigint")
    out = ingest.call_timestamps(df.select(F.col("e").alias("started_at"),
                                           F.col("e").alias("answered_at"),
                                           F.col("e").alias("ended_at")))
    got = [r.started_at_ts for r in out.collect()]
    assert str(got[0]) == "1970-01-01 00:00:00"
    assert str(got[1]) == "2023-11-14 22:13:20"
    assert got[2] is None


def _recorded(spark, ids):
    rows = [(i, f"r{i}.mp3") for i in ids]
    return spark.createDataFrame(rows, "id bigint, recording string")


def test_worklist_compares_ids_as_strings(spark):
    rec = _recorded(spark, [1, 2, 3, None])
    arts = spark.createDataFrame(
        [("audio", "1.mp3", "1"), ("audio", "2", "2"), ("transcript", "3.txt", "3")],
        schemas.ARTIFACT)
    todo = worklist.download_worklist(rec, arts)
    assert sorted((r.id for r in todo.collect()), key=lambda x: (x is None, x)) == [3, None]
    counts = worklist.run_counts(rec, arts).first()
    assert (counts.n_recorded, counts.n_to_download) == (4, 2)


def test_language_attach_and_history_append(spark):
    new = spark.createDataFrame([(1,), (2,)], "id bigint")
    results = spark.createDataFrame([("1", "hello", "de")], schemas.TRANSCRIPT)
    rows = worklist.attach_language(new, results)
    assert dict((r.id, r.language) for r in rows.collect()) == {1: "de", 2: "null"}

    hist = spark.createDataFrame([(1, "de")], "id bigint, language string")
    both = worklist.append_history(hist, rows)
    assert both.count() == 3                                    # bag union (parity)
    once = worklist.append_history(hist, rows, dedupe_on="id")
    assert sorted(r.id for r in once.collect()) == [1, 2]
    twice = worklist.append_history(once, rows, dedupe_on="id")
    assert twice.count() == once.count()                       # idempotent


def test_lookback_window(spark):
    df = spark.createDataFrame([(1, 1_000_000), (2, 1_000_000 - 86400 * 15), (3, 1_000_000 - 86400 * 15 - 1)],
                               "id bigint, started_at bigint")
    as_of = F.lit("1970-01-12 13:46:40").cast("timestamp_ntz")     # epoch 1_000_000
    got = [r.id for r in ingest.lookback_calls(df, as_of=as_of, days=15).collect()]
    assert got == [1, 2]


def test_recent_pages_drops_only_pages_outside_the_window(spark, tmp_path):
    now = 1_000_000
    old, new = now - 86400 * 30, now - 60
    pages = [[call(1, started=old), call(2, started=old)],          # entirely outside
             [call(3, started=old), call(4, started=new)],          # mixed
             [call(5, started=new)]]
    raw = read_pages(spark, land(tmp_path, pages))
    as_of = F.lit("1970-01-12 13:46:40").cast("timestamp_ntz")      # epoch 1_000_000
    kept = ingest.recent_pages(raw, as_of=as_of, days=15)
    assert kept.count() == 2
    with_pre = ingest.lookback_calls(ingest.flatten_calls(kept), as_of=as_of, days=15)
    without = ingest.lookback_calls(ingest.flatten_calls(raw), as_of=as_of, days=15)
    assert [r.id for r in with_pre.collect()] == [r.id for r in without.collect()] == [4, 5]   # same start: by id
