"""Landed pages that cannot be read, chains of links, streams with state, folder listing, key guards, attempts."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from callweave import schemas
from callweave.operators import attempts, cohort, inference, worklist
from callweave.operators.keyed import one_per_key, unique_key
from callweave.plans.stored import listing
from callweave.sources import feed
from callweave.streaming.landing import start_dead_letters, start_landing_ingest
from test_plans import USER

HOST = "https://host.example/p"


def page(folder, n, ids, nxt=None, link=None, start=1_700_000_000):
    calls = [{"id": i, "number": {"id": 1, "name": "Main"}, "started_at": start + i, "answered_at": None, "ended_at": start + 100 + i,
              "direction": "inbound", "recording": f"https://host.example/r/{i}.mp3", "user": USER} for i in ids]
    text = json.dumps({"calls": calls, "meta": {"next_page_link": nxt and HOST + str(nxt)}, "page_link": HOST + str(link or n)}, indent=1)
    (folder / f"page-{n:03d}.json").write_text(text)
    return text


def report(checked):
    return {k: v for k, v in feed.page_report(checked).first().asDict().items()}


def test_unreadable_pages_are_set_aside(spark, tmp_path):
    page(tmp_path, 1, [1, 2], nxt=2)
    whole = page(tmp_path, 2, [3], nxt=3)
    page(tmp_path, 3, [], nxt=4)
    page(tmp_path, 4, [4])
    checked = feed.read_landed(spark, str(tmp_path))
    assert report(checked) == {"n_pages": 4, "n_bad": 0, "n_calls": 4, "n_repeated": 0, "n_missing": 0, "n_starts": 1, "n_ends": 1, "is_whole": True}
    (tmp_path / "page-002.json").write_text(whole[:70])
    (tmp_path / "page-005.json").write_text("")
    (tmp_path / "page-006.json").write_text('{"meta": {"next_page_link": null}}')
    checked = feed.read_landed(spark, str(tmp_path))
    letters = {os.path.basename(r.source): r.raw for r in feed.dead_letters(checked).collect()}
    assert set(letters) == {"page-002.json", "page-006.json"} and letters["page-002.json"] == whole[:70]
    got = report(checked)
    assert not got["is_whole"] and (got["n_pages"], got["n_bad"], got["n_missing"], got["n_starts"]) == (5, 2, 1, 2)
    assert [r.page_link for r in feed.missing_links(checked).collect()] == [HOST + "2"]
    calls = feed.whole_pages(checked).select(F.explode("calls.id").alias("id"))
    assert sorted(r.id for r in calls.collect()) == [1, 2, 4]


def _links(spark, pairs):
    rows = [(HOST + str(a) if a is not None else None, json.dumps({"calls": [], "meta": {"next_page_link": None if b is None else HOST + str(b)}})) for a, b in pairs]
    return feed.parse_landed(spark.createDataFrame(rows, "page_link string, value string"))


def test_chains_of_links(spark):
    whole = [(i, i + 1) for i in range(1, 13)] + [(13, None)]
    assert report(_links(spark, whole))["is_whole"]
    for damaged, key in ((whole[1:], None), ([p for p in whole if p[0] != 5], "n_missing"), (whole[:-1], "n_missing"), ([*whole, (3, 4)], "n_repeated"), ([*whole, (20, None)], "n_ends")):
        got = report(_links(spark, damaged))
        if key is None:  # a chain that begins later is whole by itself
            assert got["is_whole"]
        else:
            assert not got["is_whole"] and got[key] >= 1
    assert report(_links(spark, [(1, 2), (2, 1)]))["n_ends"] == 0
    got = {r.page_link: (r.to_end, r.reaches_end) for r in feed.chain_positions(_links(spark, [*whole, (30, 31), (31, 32), (32, 30)])).collect()}
    assert [got[HOST + str(i)] for i in range(1, 14)] == [(13 - i, True) for i in range(1, 14)]
    assert not any(got[HOST + str(i)][1] for i in (30, 31, 32))
    empty = report(_links(spark, []))
    assert empty["n_pages"] == 0 and not empty["is_whole"]


def _drain(spark, land, arts, table, ckpt, **more):
    q = start_landing_ingest(spark, str(land), arts, table, str(ckpt), **more)
    q.awaitTermination(300)
    return q


def test_stream_state_stays_as_large_as_the_window(spark, tmp_path):
    land, day = tmp_path / "land", 86400
    land.mkdir()
    arts = spark.createDataFrame([("audio", "2.mp3", "2")], schemas.ARTIFACT)
    for n in range(50):  # a day of two new calls each, and two of the day before again
        page(land, n, [2 * n, 2 * n + 1, *([2 * n - 2, 2 * n - 1] if n else [])], start=1_700_000_000)
        text = json.loads((land / f"page-{n:03d}.json").read_text())
        for c in text["calls"]:
            c["started_at"] = 1_700_000_000 + c["id"] // 2 * day
        (land / f"page-{n:03d}.json").write_text(json.dumps(text))
        os.utime(land / f"page-{n:03d}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    q = _drain(spark, land, arts, "t_pending_state", tmp_path / "ckpt", days=5, max_files_per_trigger=1)
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert len(sizes) >= 50 and max(sizes) <= 24 and max(sizes[-10:]) <= max(sizes[15:25])  # 100 ids were seen
    spark.catalog.refreshTable("t_pending_state")
    assert sorted(r.id for r in spark.table("t_pending_state").collect()) == [i for i in range(100) if i != 2]
    # the same pages landed once more, under other names: nothing of the window is appended again
    for n in (48, 49):
        (land / f"again-{n}.json").write_text((land / f"page-{n:03d}.json").read_text())
    _drain(spark, land, arts, "t_pending_state", tmp_path / "ckpt", days=5)
    spark.catalog.refreshTable("t_pending_state")
    assert spark.table("t_pending_state").count() == 99


def test_stream_keeps_unreadable_pages_and_calls_without_an_id(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    text = page(land, 1, [1, 2])
    (land / "cut.json").write_text(text[:50])
    odd = json.loads(text)
    for c, start in zip(odd["calls"], (None, 1_700_000_500), strict=True):
        c["id"], c["started_at"] = None, start
    (land / "odd.json").write_text(json.dumps(odd))
    arts = spark.createDataFrame([], schemas.ARTIFACT)
    _drain(spark, land, arts, "t_pending_odd", tmp_path / "ckpt")
    start_dead_letters(spark, str(land), "t_dead_odd", str(tmp_path / "dead")).awaitTermination(120)
    spark.catalog.refreshTable("t_pending_odd")
    assert sorted((r.id for r in spark.table("t_pending_odd").collect()), key=str) == [1, 2, None, None]
    assert [(os.path.basename(r.source), r.raw) for r in spark.table("t_dead_odd").collect()] == [("cut.json", text[:50])]


def test_empty_artifacts_are_held(spark, tmp_path):
    for shard, name, content in (("00", "1.mp3", b"x"), ("00", "2.mp3", b""), ("17", "3.mp3", b"yy"), ("17", "note.txt", b"z")):
        (tmp_path / shard).mkdir(exist_ok=True)
        (tmp_path / shard / name).write_bytes(content)
    files = listing.artifact_files(spark, str(tmp_path), "audio", shards=listing.SHARDS)
    assert files.rdd.getNumPartitions() == 100  # one task per shard
    got = {(r.call_id, r.size) for r in files.collect()}
    assert got == {("1", 1), ("2", 0), ("3", 2)} and files.first().modified_at is not None
    recorded = spark.createDataFrame([(1,), (2,), (4,)], "id long")
    assert [r.id for r in worklist.download_worklist(recorded, files).collect()] == [4]
    flat = listing.artifact_files(spark, "file:" + str(tmp_path / "17"), "audio")
    assert [r.name for r in flat.collect()] == ["3.mp3"]
    assert listing.artifact_files(spark, str(tmp_path / "none"), "audio").collect() == []


def test_keys_that_are_there_twice(spark):
    rows = spark.createDataFrame([("u", "Uma"), ("u", "Anna"), ("v", None), (None, "x"), (None, "y")], schemas.USER_DIM)
    assert sorted((r.pk_user, r.ds_full_name) for r in unique_key(rows, "pk_user", "first").collect()) == [("u", "Anna"), ("v", None)]
    with pytest.raises(Exception, match="more than one row with pk_user u"):
        unique_key(rows, "pk_user").collect()
    assert unique_key(rows.where("pk_user = 'v'"), "pk_user").count() == 1
    assert unique_key(rows, "pk_user", "keep").count() == 5
    with pytest.raises(ValueError):
        unique_key(rows, "pk_user", "last")


def test_a_user_that_is_there_twice_does_not_multiply_calls(spark):
    tasks = spark.createDataFrame([("t1", "A", "u", "https://h/calls/1/r"), ("t2", "A", None, "https://h/calls/2/r")], "Id string, AccountId string, OwnerId string, aircall__Call_Recording__c string")
    tasks = tasks.select(*[F.col(f.name) if f.name in tasks.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.TASK.fields])
    users = spark.createDataFrame([("u", "Uma"), ("u", "Anna"), (None, "x")], schemas.USER_DIM)
    accounts = spark.createDataFrame([("A", "Acme"), ("A", "Acme")], "pk_account string, ds_account string")
    assert cohort.icp_calls(tasks, users, accounts).count() == 6
    got = cohort.icp_calls(tasks, users, accounts, "first")
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 3  # each table once
    assert sorted((r.Id, r.ds_full_name) for r in got.collect()) == [("t1", "Anna"), ("t2", None)]
    with pytest.raises(Exception, match="more than one row with pk_"):
        cohort.icp_calls(tasks, users, accounts, "fail").collect()


def test_one_per_key_is_the_same_on_every_run(spark):
    rows = spark.createDataFrame([(1, "b", "null"), (1, "a", "de"), (1, "c", "null"), (None, "x", "null"), (None, "y", "null"), (None, "x", "null"), (2, None, None)], "id long, name string, language string")
    for n in (1, 3, 7):
        got = sorted((tuple(r) for r in one_per_key(rows.repartition(n), "id", F.col("language") != "null").collect()), key=str)
        assert got == [(1, "a", "de"), (2, None, None), (None, "x", "null"), (None, "y", "null")]


def _at(minutes):
    return None if minutes is None else dt.datetime(2025, 1, 6) + dt.timedelta(minutes=minutes)


def test_states_of_calls(spark):
    rows = [("late success", 1, None, None, "busy"), ("late success", 2, "hi", "de", None),
            ("late failure", 1, "hi", "de", None), ("late failure", 2, None, None, "busy"), ("late failure", 3, None, None, "gone"),
            ("replaced", 1, "old", "en", None), ("replaced", 5, "new", "de", None), ("replaced", 3, "mid", "fr", None),
            ("never", 0, None, None, "a"), ("never", 10, None, None, "b"), ("never", 20, None, None, "c"),
            ("same time", 1, None, None, "busy"), ("same time", 1, "hi", "de", None),
            ("no time", None, None, None, "busy"), ("text only", 1, "hi", None, None), (None, 1, "x", "y", None)]
    log = spark.createDataFrame([(c, _at(m), t, lang, e) for c, m, t, lang, e in rows], schemas.ATTEMPT)
    got = {r.call_id: (r.n_attempts, r.n_failures, r.text, r.language, r.error, r.next_due_at) for r in attempts.call_states(log).collect()}
    assert got == {
        "late success": (2, 0, "hi", "de", None, None), "late failure": (3, 2, "hi", "de", "gone", _at(33)),
        "replaced": (3, 0, "new", "de", None, None), "never": (3, 3, None, None, "c", _at(80)),
        "same time": (2, 0, "hi", "de", None, None), "no time": (1, 1, None, None, "busy", None),
        "text only": (1, 0, "hi", None, None, None), None: (1, 0, "x", "y", None, None)}
    due = attempts.due_calls(attempts.call_states(log), F.lit("2025-01-06 00:40:00").cast("timestamp_ntz"))
    assert sorted(r.call_id for r in due.collect()) == ["late failure", "no time"]


def test_language_of_the_latest_success(spark):
    calls = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    log = spark.createDataFrame([("1", _at(1), "a", "aa", None), ("1", _at(2), "b", "zz", None), ("1", _at(3), None, None, "busy"), ("2", _at(1), None, None, "busy")], schemas.ATTEMPT)
    got = {r.id: r.language for r in worklist.attach_language(calls, log).collect()}
    assert got == {1: "zz", 2: "null", 3: "null"}
    plain = spark.createDataFrame([("2", None, None), ("3", "t", "fr")], schemas.TRANSCRIPT)
    assert {r.id: r.language for r in worklist.attach_language(calls, plain).collect()} == {1: "null", 2: "null", 3: "fr"}
    errors = {r.call_id: r.error for r in attempts.attempt_log(plain).collect()}
    assert errors == {"2": "no result", "3": None}


def test_dimension_as_of_run_dates(spark):
    d = [dt.date(2025, 1, n) for n in range(1, 10)]
    parts = spark.createDataFrame([("A", 0, 2, "Acme"), ("A", 1, 2, "Acme"), ("B", 0, 1, "Bolt")], "account_id string, part_no long, n_parts long, ds_account string")
    rows = [("A", 0, "translation", d[1], " t1 "), ("A", 0, "translation", d[4], "t4"), ("A", 0, "summary", d[2], "s2\n"), ("A", 1, "summary", d[4], "p"), ("C", 0, "summary", d[1], "other")]
    responses = spark.createDataFrame(rows, schemas.RESPONSE)
    got = {(r.AccountId, r.part_no, r.as_of): (r.translation, r.translation_date, r.summary, r.summary_date) for r in inference.account_dim_as_of(parts, responses, [d[0], d[3], d[8]]).collect()}
    none = (None,) * 4
    assert got == {("A", 0, d[0]): none, ("A", 1, d[0]): none, ("B", 0, d[0]): none, ("B", 0, d[3]): none, ("B", 0, d[8]): none,
                   ("A", 0, d[3]): ("t1", d[1], "s2", d[2]), ("A", 1, d[3]): none,
                   ("A", 0, d[8]): ("t4", d[4], "s2", d[2]), ("A", 1, d[8]): (None, None, "p", d[4])}
