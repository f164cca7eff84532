"""Registered queries that write and read back: stores, files and what is counted on the way.

Like ``catalogue`` each entry takes ``(spark, sf_dir)`` and returns a
DataFrame, but these run the writes when they are called. They write below
the shared checkpoint folder, each call in a fresh folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from callweave import stores
from callweave.constants import AUDIO_EXT, TEXT_EXT
from callweave.operators import ingest, worklist
from callweave.plans import catalogue, ingestion, summarization
from callweave.plans.oracle import DAY, ORACLE_SQL, _crm
from callweave.session import ensure_checkpoint_dir, materialize
from callweave.sources import listing, overlay
from callweave.sources.files import read_keyed_texts

ID_WIDTH = 500


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/callweave/{name}-{uuid.uuid4().hex}"


def history_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history merged bucket by bucket over two runs (SNK-2, SET-1)."""
    store = ingestion.history_store(spark, _folder(spark, "history"), ID_WIDTH)
    ingestion.update_history(store, overlay.history(spark, sf_dir))
    ingestion.update_history(store, catalogue.language_attach(spark, sf_dir))
    return store.read()


def _two_runs(spark: SparkSession, sf_dir: str) -> stores.KeyedStore:
    store = ingestion.transcript_store(spark, _folder(spark, "transcripts"), 16)
    given = overlay.transcripts(spark, sf_dir)
    store.append(ingestion.transcript_rows(given))
    held = worklist.held_keys(overlay.artifacts(spark, sf_dir), "audio")
    again = given.join(held, given["call_id"] == held["_held"], "left_semi")
    store.append(ingestion.transcript_rows(again.withColumn("text", F.concat(F.lit("again: "), F.col("text")))))
    return store


def transcript_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts after a run over every call and one over those with audio: the last write wins (SNK-4)."""
    return _two_runs(spark, sf_dir).read()


def transcript_store_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after its deltas were folded in and the old snapshots expired."""
    store = _two_runs(spark, sf_dir)
    store.compact()
    store.expire(1)
    return store.read()


def text_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles, translations and summaries of a run, stored and read back (SNK-5..7)."""
    path, day = _folder(spark, "texts"), catalogue.RUN_DATE
    bundles = catalogue.account_bundle(spark, sf_dir).withColumnRenamed("bundle", "text")
    summarization.save_texts(bundles.withColumn("text", F.lit("of a run that was repeated")), "bundle", path, day)
    summarization.save_texts(bundles, "bundle", path, day)
    summarization.save_responses(overlay.responses(spark, sf_dir), path, day)
    return summarization.read_texts(spark, path)


def published_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recorded calls replaced in one commit (SNK-1)."""
    store = stores.Store(spark, _folder(spark, "recorded"))
    store.replace(ingest.call_timestamps(catalogue.flatten_calls(spark, sf_dir)))
    store.replace(catalogue.call_timestamps(spark, sf_dir))
    return store.read()


def published_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account dimension replaced in one commit (SNK-3)."""
    store = stores.Store(spark, _folder(spark, "dim"))
    store.replace(catalogue.account_dim(spark, sf_dir))
    return store.read()


def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's counts, taken by the jobs that write the recorded calls and the worklist (AG-4)."""
    n_recorded, n_to_download = Observation(), Observation()
    recorded = materialize(worklist.counted(catalogue.recorded_calls(spark, sf_dir), n_recorded, "n_recorded"), "observed-recorded")
    materialize(worklist.counted(worklist.download_worklist(recorded, overlay.artifacts(spark, sf_dir)), n_to_download, "n_to_download"), "observed-worklist")
    counts = {**n_recorded.get, **n_to_download.get}
    return spark.range(1).select(*[F.lit(counts[c]).cast("long").alias(c) for c in ("n_recorded", "n_to_download")])


def artifact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio files listed by tasks; every fifth is empty and held all the same (SRC-5)."""
    folder = _folder(spark, "audio")
    key = F.col("doc_id").cast("string")
    files = overlay.read_table(spark, sf_dir, "labels").select(
        F.concat(listing.shard_of(key), F.lit("/"), key, F.lit(AUDIO_EXT)).alias("path"),
        F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(key).alias("content"))
    listing.write_files(files, folder).write.format("noop").mode("overwrite").save()
    return listing.artifact_files(spark, folder, "audio", shards=listing.SHARDS).drop("modified_at")


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript files, one per call, written and read back as a keyed table (SRC-6)."""
    folder = _folder(spark, "text")
    rows = overlay.transcripts(spark, sf_dir).select(
        F.concat(listing.shard_of(F.col("call_id")), F.lit("/"), F.col("call_id"), F.lit(TEXT_EXT)).alias("path"), F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")).alias("content"))
    listing.write_files(rows, folder).write.format("noop").mode("overwrite").save()
    return read_keyed_texts(spark, folder, "call_id", shards=listing.SHARDS)


QUERIES: dict[str, catalogue.Query] = {f.__name__: f for f in (
    history_store, transcript_store, transcript_store_compacted, text_store, published_calls, published_dim,
    observed_counts, artifact_files, text_files)}

_TRANSCRIPTS = """
SELECT CAST(doc_id AS VARCHAR) AS call_id, t AS text, lang AS language, CAST(length(t) AS BIGINT) AS n_chars
FROM (SELECT *, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'again: ' || text ELSE text END AS t FROM documents)"""

STORED_SQL: dict[str, str] = {
    "history_store": ORACLE_SQL["history_merge"],
    "transcript_store": _TRANSCRIPTS,
    "transcript_store_compacted": _TRANSCRIPTS,
    "text_store": _crm(
        f"SELECT account_id, part_no, 'bundle' AS kind, {DAY} AS run_date, bundle AS text FROM bundles "
        f"UNION ALL SELECT account_id, part_no, kind, run_date, text FROM resp_clean WHERE run_date = {DAY}"),
    "published_calls": ORACLE_SQL["call_timestamps"],
    "published_dim": ORACLE_SQL["account_dim"],
    "observed_counts": ORACLE_SQL["run_counts"],
    "artifact_files": (
        "SELECT 'audio' AS kind, CAST(doc_id AS VARCHAR) || '.mp3' AS name, CAST(doc_id AS VARCHAR) AS call_id, "
        "CAST(CASE WHEN doc_id % 5 = 0 THEN 0 ELSE length(CAST(doc_id AS VARCHAR)) END AS BIGINT) AS size FROM labels"),
    "text_files": "SELECT CAST(doc_id AS VARCHAR) AS call_id, text FROM documents",
}
