"""Versioned stores: pruned merges, deltas, atomic commits, expiry; and the queries that write and read back."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from callweave import schemas, stores
from callweave.operators import worklist
from callweave.plans import ingestion, summarization
from callweave.plans.stored import QUERIES, STORED_SQL
from callweave.session import ensure_checkpoint_dir, materialize
from compare import diff, duck, duck_rows, spark_rows
from conftest import SF_ORACLE

SF = os.environ.get("ORACLE_SF_DIR", SF_ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duck(SF)
    yield c
    c.close()


def test_every_stored_query_has_an_oracle():
    assert set(QUERIES) == set(STORED_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_stored_query_matches_oracle(spark, con, name):
    s_cols, s_rows = spark_rows(QUERIES[name](spark, SF))
    d_cols, d_rows = duck_rows(con, STORED_SQL[name])
    assert s_cols == d_cols
    assert s_rows == d_rows, diff(s_rows, d_rows)


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))


def _calls(spark, ids, language="null"):
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    return rows.select("id", F.concat(F.lit("line "), F.col("id")).alias("number_name"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("user_email"), F.lit(language).alias("language"))


def test_a_run_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    store = ingestion.history_store(spark, str(tmp_path / "h"), 100)
    first = ingestion.update_history(store, _calls(spark, range(10_000)))
    assert len(first.base) == 100
    whole = _bytes(store.folder(first.version))
    # one late language, two new ids beside it: two buckets of 101
    late = _calls(spark, [4217], "de").unionByName(_calls(spark, [10_005, 10_006], "en"))
    second = ingestion.update_history(store, late)
    assert {b for b, v in second.base.items() if v == second.version} == {"42", "100"}
    assert _bytes(store.folder(second.version)) < whole / 50
    got = {r.id: r.language for r in store.read().collect()}
    assert len(got) == 10_002 and got[4217] == "de" and got[10_005] == "en" and got[4218] == "null"
    # a merge reads the touched buckets' folders only
    assert all(f"version={second.version}/bucket=42/" in f for f in store._base(second, {"42"}).inputFiles())
    # the same run again writes the same rows; an empty run nothing
    ingestion.update_history(store, late)
    assert {r.id: r.language for r in store.read().collect()} == got
    v = store.snapshot().version
    assert ingestion.update_history(store, late.limit(0)).version == v


def test_a_larger_run_writes_more(spark, tmp_path):
    store = ingestion.history_store(spark, str(tmp_path / "h"), 100)
    ingestion.update_history(store, _calls(spark, range(10_000)))
    sizes = []
    for n in (1, 4, 16):
        s = ingestion.update_history(store, _calls(spark, range(0, 100 * n, 100), "fr"))
        sizes.append(_bytes(store.folder(s.version)))
    assert 3 < sizes[1] / sizes[0] < 5 and 3 < sizes[2] / sizes[1] < 5


def test_rows_without_an_id(spark, tmp_path):
    """Told apart by their other columns, and not appended again by every run."""
    store = ingestion.history_store(spark, str(tmp_path / "h"), 10)
    rows = spark.createDataFrame([(None, "a", "null"), (None, "b", "null"), (None, "b", "null"), (1, "x", "null"), (1, "x", "de"), (1, "w", "de"), (-3, "n", "en")],
                                 "id long, number_name string, language string")
    for _ in range(3):
        ingestion.update_history(store, rows)
    got = sorted(((r.id, r.number_name, r.language) for r in store.read().collect()), key=str)
    assert got == [(-3, "n", "en"), (1, "x", "de"), (None, "a", "null"), (None, "b", "null")]
    ingestion.update_history(store, spark.createDataFrame([(None, "b", "fr")], rows.schema))
    assert sorted(r.language for r in store.read().where("id IS NULL").collect()) == ["fr", "null"]


def _texts(spark, rows):
    return spark.createDataFrame(rows, "call_id string, text string, language string, n_chars long")


def test_a_delta_holds_its_own_rows_and_compaction_changes_nothing(spark, tmp_path):
    store = ingestion.transcript_store(spark, str(tmp_path / "t"), 4)
    store.append(_texts(spark, [(str(i), f"text {i}", "de", 6) for i in range(50)]))
    second = store.append(_texts(spark, [("7", "new", "en", 3), ("99", "more", "en", 4)]))
    third = store.append(_texts(spark, [("7", "newest", "fr", 6)]))
    assert spark.read.parquet(store.folder(second.version)).count() == 2
    assert len(third.deltas) == 3

    def rows():
        return sorted(tuple(r) for r in store.read().collect())

    want = rows()
    assert len(want) == 51 and dict((r[0], r[1]) for r in want)["7"] == "newest"
    old = {r[0]: r[1] for r in store.read(second.version).collect()}  # an earlier version is still there
    assert old["7"] == "new"
    packed = store.compact()
    assert packed.deltas == () and set(packed.base) <= {"0", "1", "2", "3"} and rows() == want
    # one more delta, folded into the one bucket it touches
    store.append(_texts(spark, [("7", "last", "es", 4)]))
    again = store.compact()
    assert sum(v == again.version for v in again.base.values()) == 1
    assert {r[0]: r[1] for r in rows()} == {**{r[0]: r[1] for r in want}, "7": "last"}
    before = rows()
    gone = store.expire(1)
    assert gone and rows() == before
    assert {int(n.split("=")[1]) for n in os.listdir(store.path) if n.startswith("version=")} == again.versions()
    kept = {b for b, v in again.base.items() if v == packed.version}
    assert {n.split("=")[1] for n in os.listdir(store.folder(packed.version)) if n.startswith("bucket=")} == kept


def test_a_write_killed_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    store = stores.Store(spark, str(tmp_path / "d"))
    with pytest.raises(FileNotFoundError):
        store.read()
    store.replace(spark.range(3))
    reader = store.read()

    def killed(self, new, after):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(stores.Store, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            store.replace(spark.range(500))
    assert store.read().count() == 3
    staged = {n for n in os.listdir(store.path) if n.startswith("version=")}
    assert len(staged) == 2
    store.replace(spark.range(7))
    assert store.read().count() == 7 and reader.count() == 3  # a reader holds on to its snapshot
    gone = store.expire(1)
    assert {os.path.basename(g) for g in gone if "version=" in g} == staged
    assert store.read().count() == 7


def test_a_half_written_snapshot_is_passed_over(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path / "d"))
    store.replace(spark.range(3))
    (tmp_path / "d" / "_snapshots" / "000000000009.json").write_text('{"version": 9, "ba')
    assert store.read().count() == 3
    assert store.replace(spark.range(4)).version == 10 and store.read().count() == 4


def test_of_two_writers_one_commits(spark, tmp_path):
    path = str(tmp_path / "d")
    store = stores.Store(spark, path)
    store.replace(spark.range(3))
    before = store.snapshot()
    stores.Store(spark, path).replace(spark.range(5))
    with pytest.raises(stores.WriteConflict):
        store.commit(stores.Snapshot(9, before.schema, {"": 9}), before)
    now = store.snapshot()
    with pytest.raises(stores.WriteConflict):  # the same version, committed between the look and the write
        store.commit(stores.Snapshot(now.version, before.schema, {"": 9}), now)
    assert store.read().count() == 5


def test_intermediate_tables_expire(spark):
    table = materialize(spark.range(5), "to-expire")
    folder = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("///", "/")
    assert os.path.isdir(folder) and folder.startswith(ensure_checkpoint_dir(spark).rstrip("/"))
    assert not any(folder.endswith(p.rsplit("/", 1)[1]) for p in stores.expire_materialized(spark, 3600))
    assert any(folder.endswith(p.rsplit("/", 1)[1]) for p in stores.expire_materialized(spark, -5))
    assert not os.path.isdir(folder)


def test_counts_are_taken_by_the_write(spark, tmp_path):
    from pyspark.sql import Observation

    artifacts = spark.createDataFrame([("audio", "2.mp3", "2")], schemas.ARTIFACT)
    recorded = spark.createDataFrame([(i, f"r{i}") for i in (1, 2, 3, None)], "id long, recording string")
    o = Observation()
    todo = worklist.counted(worklist.download_worklist(recorded, artifacts), o, "n_to_download")
    assert "CollectMetrics" in todo._jdf.queryExecution().executedPlan().toString()
    materialize(todo, "observed")
    assert o.get == {"n_to_download": worklist.run_counts(recorded, artifacts).first().n_to_download} == {"n_to_download": 3}


def test_run_dates_of_texts(spark, tmp_path):
    path = str(tmp_path / "texts")

    def rows(*values):
        return spark.createDataFrame(list(values), "account_id string, part_no long, text string")

    summarization.save_texts(rows(("A", 0, "old"), ("A", 1, "one"), ("B", 0, "b")), "summary", path, dt.date(2025, 1, 5))
    summarization.save_texts(rows(("A", 0, "new")), "summary", path, dt.date(2025, 1, 6))
    summarization.save_texts(rows(("A", 0, "newer")), "summary", path, dt.date(2025, 1, 6))
    got = {(r.account_id, r.part_no, str(r.run_date)): r.text for r in summarization.read_texts(spark, path, "summary").collect()}
    assert got == {("A", 0, "2025-01-05"): "old", ("A", 1, "2025-01-05"): "one", ("B", 0, "2025-01-05"): "b", ("A", 0, "2025-01-06"): "newer"}


def test_attempts_are_logged_once(spark):
    day = dt.datetime(2025, 1, 6)
    log = [("1", day, None, None, "busy"), ("1", day, None, None, "busy"), ("2", day, "hi", "de", None)]
    ingestion.log_attempts(spark, spark.createDataFrame(log, schemas.ATTEMPT), "t_attempts_once")
    later = [("1", day, None, None, "busy"), ("1", day + dt.timedelta(hours=1), None, None, "gone")]
    states = {r.call_id: r for r in ingestion.log_attempts(spark, spark.createDataFrame(later, schemas.ATTEMPT), "t_attempts_once").collect()}
    assert (states["1"].n_attempts, states["1"].n_failures, states["1"].error) == (2, 2, "gone")
    assert states["1"].next_due_at == day + dt.timedelta(minutes=90) and states["2"].next_due_at is None
