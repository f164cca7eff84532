"""File-backed sources and storage layout: artifact listing, transcript
store, bucketed transcripts."""

from pyspark.sql import functions as F

from callweave import schemas, sinks
from callweave.operators import bundle
from callweave.plans import ingestion
from callweave.sources.files import list_artifacts


def test_list_artifacts_reads_names_only(spark, tmp_path):
    (tmp_path / "101.mp3").write_bytes(b"ID3....")
    (tmp_path / "102.mp3").write_bytes(b"ID3....")
    (tmp_path / "notes.txt").write_text("x")
    arts = list_artifacts(spark, str(tmp_path), "audio")
    assert sorted((r.kind, r.name, r.call_id) for r in arts.collect()) == [
        ("audio", "101.mp3", "101"), ("audio", "102.mp3", "102")]
    plan = arts._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]   # bytes pruned


def test_store_transcripts_keeps_one_per_call(spark):
    res = spark.createDataFrame([("1", "hallo", "de"), ("2", None, None), ("1", "hallo", "de")],
                                schemas.TRANSCRIPT)
    first = ingestion.store_transcripts(spark, res, "t_transcripts_once")
    again = ingestion.store_transcripts(spark, res, "t_transcripts_once")
    assert first.count() == 1 and again.count() == 1
    spark.catalog.refreshTable("t_transcripts_once")
    assert [(r.call_id, r.text) for r in spark.table("t_transcripts_once").collect()] == [("1", "hallo")]


def test_bucketed_transcripts_shuffle_only_the_call_side(spark):
    texts = spark.range(0, 2000).select(F.col("id").cast("string").alias("call_id"),
                                        F.concat(F.lit("text "), F.col("id")).alias("text"))
    sinks.save_bucketed(texts, "t_tx_bucketed", "call_id", 8)
    calls = spark.range(0, 500).select(
        (F.col("id") % 7).cast("string").alias("AccountId"), F.col("id").cast("string").alias("Id"),
        F.col("id").cast("string").alias("call_id"), F.lit("Acme").alias("ds_account"), F.lit("Uma").alias("ds_full_name"),
        F.lit(None).cast("timestamp_ntz").alias("CreatedDate"), F.lit(5).cast("bigint").alias("CallDurationInSeconds"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        tx = spark.table("t_tx_bucketed")
        joined = calls.join(tx, calls["call_id"] == tx["call_id"], "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1      # only the call side moves
        assert "SortMergeJoin" in plan
        out = bundle.account_bundle(calls, tx)
        assert out.select("account_id").distinct().count() == 7
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16MB")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")


def test_task_scan_prunes_columns_and_pushes_the_sentinel_filter(spark, tmp_path):
    from callweave.operators import cohort
    from callweave.sources import crm, overlay
    from conftest import SF_SMALL

    wide = overlay.tasks(spark, SF_SMALL).withColumn("Description", F.lit("x" * 50))
    wide.write.mode("overwrite").saveAsTable("t_crm_task")
    calls = cohort.recorded_tasks(crm.read_tasks(spark, "t_crm_task"))
    plan = calls._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "Description" not in scan.split("ReadSchema")[-1]
    assert "IsNotNull(aircall__Call_Recording__c)" in scan
    assert "Not(EqualTo(aircall__Call_Recording__c,null))" in scan


def test_listing_skips_zero_byte_files_so_held_ness_needs_a_manifest(spark, tmp_path):
    """Spark's file scans drop zero-byte files; an empty artifact therefore
    counts as held only through the manifest table, as documented."""
    (tmp_path / "1.mp3").write_bytes(b"x")
    (tmp_path / "2.mp3").write_bytes(b"")
    listed = {r.call_id for r in list_artifacts(spark, str(tmp_path), "audio").collect()}
    assert listed == {"1"}
    manifest = spark.createDataFrame([("audio", "1.mp3", "1"), ("audio", "2.mp3", "2")],
                                     schemas.ARTIFACT)
    recorded = spark.createDataFrame([(1,), (2,)], "id bigint")
    from callweave.operators import worklist
    assert worklist.download_worklist(recorded, manifest).count() == 0
