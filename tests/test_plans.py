"""End-to-end runs with their table writes, the streaming ingest, and plan
guards over every registered query."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from callweave import schemas, sinks
from callweave.plans import ingestion, summarization
from callweave.plans.catalogue import QUERIES
from callweave.sources import overlay
from callweave.streaming.landing import start_landing_ingest
from conftest import SF_SMALL

USER = {"id": 7, "name": "Ada", "email": "ada@host.example", "available": False}


def page(folder, n, ids, user=USER):
    calls = [{"id": i, "number": {"id": 1, "name": "Main"}, "started_at": 1_700_000_000 + i,
              "answered_at": None, "ended_at": 1_700_000_100 + i, "direction": "inbound",
              "recording": f"https://host.example/r/{i}.mp3", "user": user} for i in ids]
    (folder / f"page-{n:03d}.json").write_text(json.dumps({"calls": calls, "meta": {}}))


def test_ingestion_run_appends_once(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    page(land, 0, [1, 2, 3])
    page(land, 1, [4], user=None)
    arts = spark.createDataFrame([("audio", "2.mp3", "2")], schemas.ARTIFACT)

    prep = ingestion.prepare_ingestion(spark, str(land), arts, "t_recorded", days=None)
    assert spark.table("t_recorded").count() == 4
    assert sorted(r.call_id for r in prep.requests.collect()) == ["1", "3", "4"]
    results = spark.createDataFrame([("1", "hi", "de"), ("3", "yo", "en")], schemas.TRANSCRIPT)
    ingestion.complete_ingestion(spark, prep.new_rows, results, "t_history")
    hist = {r.id: r.language for r in spark.table("t_history").collect()}
    assert hist == {1: "de", 3: "en", 4: "null"}
    assert spark.table("t_history").where("id = 4").first().user_id == "null"

    # the next pull overlaps the last one: nothing is appended twice, the call
    # that failed is asked for again, and its language reaches its old row
    page(land, 2, [5])
    prep2 = ingestion.prepare_ingestion(spark, str(land), arts, "t_recorded", days=None)
    assert sorted(r.call_id for r in prep2.requests.collect()) == ["1", "3", "4", "5"]
    results = spark.createDataFrame([("4", "na", "fr"), ("4", "na", None), ("5", "oi", "es")], schemas.TRANSCRIPT)
    ingestion.complete_ingestion(spark, prep2.new_rows, results, "t_history")
    hist = sorted((r.id, r.language) for r in spark.table("t_history").collect())
    assert hist == [(1, "de"), (3, "en"), (4, "fr"), (5, "es")]


def test_last_transcript_wins(spark):
    first = spark.createDataFrame([("1", "old", "de"), ("2", "two", "en")], schemas.TRANSCRIPT)
    again = spark.createDataFrame([("1", "new", "de"), ("3", None, "en")], schemas.TRANSCRIPT)
    ingestion.store_transcripts(spark, first, "t_transcripts")
    ingestion.store_transcripts(spark, again, "t_transcripts")
    got = {r.call_id: (r.text, r.n_chars) for r in spark.table("t_transcripts").collect()}
    assert got == {"1": ("new", 3), "2": ("two", 3)}
    with pytest.raises(Exception, match="two transcripts"):
        ingestion.store_transcripts(spark, first.unionByName(again.where("call_id = '1'")), "t_transcripts")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_building_a_query_runs_no_job(spark, name):
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        QUERIES[name](spark, SF_SMALL)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["account_bundle", "translate_requests"])
def test_orders_are_scanned_twice_in_total(spark, name):
    """Once for the tasks, once for the opportunities: numbering shares its input."""
    plan = _final_plan(QUERIES[name](spark, SF_SMALL))
    assert plan.count("orders.parquet") == 2


def test_summarization_run(spark, tmp_path):
    sf = SF_SMALL
    b = summarization.build_bundles(
        overlay.tasks(spark, sf), overlay.opportunities(spark, sf), overlay.accounts(spark, sf),
        overlay.users(spark, sf), overlay.transcripts(spark, sf), overlay.artifacts(spark, sf))
    n_accounts = b.calls.select("AccountId").distinct().count()
    assert b.bundles.count() == n_accounts == b.translate.count()
    assert b.translate.where(F.col("system").contains("{account_name}")).count() == 0
    texts = str(tmp_path / "texts")
    summarization.save_bundles(b, texts, dt.date(2025, 1, 6))
    stored = spark.read.parquet(texts)
    assert stored.where("kind = 'bundle'").count() == n_accounts

    dim = summarization.publish_dim(b.bundles, overlay.responses(spark, sf), overlay.RUN_DATE,
                                    "t_dim_icp_account")
    assert spark.table("t_dim_icp_account").count() == dim.count() == n_accounts
    assert spark.table("t_dim_icp_account").schema.names == schemas.ACCOUNT_DIM.names


def test_keyed_texts_keep_earlier_dates(spark, tmp_path):
    path = str(tmp_path / "store")
    d1, d2 = dt.date(2025, 1, 5), dt.date(2025, 1, 6)
    rows = lambda day, txt: spark.createDataFrame(                          # noqa: E731
        [("A", 0, "summary", day, txt)], schemas.RESPONSE)
    sinks.write_keyed_texts(rows(d1, "old"), path)
    sinks.write_keyed_texts(rows(d2, "new"), path)
    sinks.write_keyed_texts(rows(d2, "newer"), path)                      # replaces d2 only
    got = {(str(r.run_date), r.text) for r in spark.read.parquet(path).collect()}
    assert got == {("2025-01-05", "old"), ("2025-01-06", "newer")}


def test_streaming_landing_ingest(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    page(land, 0, [1, 2])
    arts = spark.createDataFrame([("audio", "2.mp3", "2")], schemas.ARTIFACT)
    ckpt = str(tmp_path / "ckpt")
    q = start_landing_ingest(spark, str(land), arts, "t_pending", ckpt)
    q.awaitTermination(120)
    spark.catalog.refreshTable("t_pending")       # written through the stream's session
    assert [r.id for r in spark.table("t_pending").collect()] == [1]
    page(land, 1, [1, 3])                                   # id 1 arrives again
    q = start_landing_ingest(spark, str(land), arts, "t_pending", ckpt)
    q.awaitTermination(120)
    spark.catalog.refreshTable("t_pending")
    assert sorted(r.id for r in spark.table("t_pending").collect()) == [1, 3]


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
             "BroadcastNestedLoopJoin", "Python UDF")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{name} plans {node}"
    if "FileScan parquet" in plan:
        assert "ReadSchema" in plan


def _final_plan(df):
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()            # run this plan so AQE finalises it
    return qe.executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_account_join_is_split(spark):
    """A cohort join where one account holds 40% of the calls: with the skew
    thresholds scaled down to this data, AQE splits the hot partition."""
    from callweave import schemas
    from callweave.operators import cohort

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = [(f"t{i}", "HOT" if i % 5 < 2 else f"a{i % 400}", f"https://h/calls/{i}/r")
                for i in range(20000)]
        tasks = spark.createDataFrame(rows, "Id string, AccountId string, rec string").select(
            *[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("Id", "AccountId")
              else F.col(f.name) for f in schemas.TASK.fields[:7]],
            F.col("rec").alias("aircall__Call_Recording__c"),
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.TASK.fields[8:]])
        accounts = spark.createDataFrame([("HOT", "Hot")] + [(f"a{i}", f"A{i}") for i in range(400)],
                                         "pk_account string, ds_account string")
        users = spark.createDataFrame([("u", "U")], schemas.USER_DIM)
        calls = cohort.icp_calls(tasks, users, accounts)
        plan = _final_plan(calls)
        assert "isSkew=true" in plan or "skew=true" in plan
        assert calls.count() == 20000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name,table,columns,pushed", [
    ("inbound_accounts", "orders", {"o_custkey", "o_orderpriority"},
     "EqualTo(o_orderpriority,1-URGENT)"),
    ("cohort_accounts", "customer", {"c_custkey", "c_name"}, None),
    ("run_counts", "labels", {"doc_id"}, None),
])
def test_scans_read_only_used_columns(spark, name, table, columns, pushed):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and f"/{table}.parquet" in ln]
    assert scans
    for scan in scans:
        read = scan.split("ReadSchema: struct<")[1].split(">")[0]
        assert {c.split(":")[0] for c in read.split(",")} <= columns
    if pushed:
        assert any(pushed in scan for scan in scans)
