"""End-to-end ingestion run: landed pages -> recorded calls -> worklist ->
(external download + transcription) -> history append.

Split in two halves around the external step:

``prepare_ingestion`` replaces ``recorded_calls`` and returns the new
history rows (calls without held audio) plus their transcription requests:
a call whose audio is still missing is asked for again, whether or not an
earlier run put it into the history. ``complete_ingestion`` merges the
results by call id and brings the history up to date by key.

The tables are versioned stores (``callweave.stores``): every write is
staged and becomes visible in one commit. The history lies in buckets of
``ID_WIDTH`` consecutive call ids, so a run rewrites the buckets its rows
fall in; transcripts are appended and folded in now and then.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from callweave import stores
from callweave.constants import LOOKBACK_DAYS, NULL_SENTINEL
from callweave.operators import ingest, worklist
from callweave.operators.attempts import attempt_log, call_states
from callweave.operators.keyed import one_per_key
from callweave.session import materialize
from callweave.sources.feed import read_pages

ID_WIDTH = 1 << 20           # call ids per bucket of the history
TRANSCRIPT_BUCKETS = 256
COMPACT_AFTER = 16           # deltas of a store before they are folded in


@dataclass
class Prepared:
    recorded: DataFrame       # the recorded calls of this pull, with *_ts columns
    new_rows: DataFrame       # history-shaped rows of calls still lacking audio
    requests: DataFrame       # one transcription request per such call, asked again until it succeeds
    counts: dict[str, int] = field(default_factory=dict)  # n_recorded, n_to_download: counted while they were written


def prepare_ingestion(spark: SparkSession, pages_path: str, artifacts: DataFrame,
                      recorded_table: str, as_of: Column | None = None, days: int | None = LOOKBACK_DAYS,
                      audio_folder: str = "audio", dedupe_on_id: bool = False) -> Prepared:
    pages = read_pages(spark, pages_path)
    if days is not None:
        pages = ingest.recent_pages(pages, as_of=as_of, days=days)
    flat = ingest.flatten_calls(pages, dedupe_on_id=dedupe_on_id)
    if days is not None:
        flat = ingest.lookback_calls(flat, as_of=as_of, days=days, newest_first=False)
    n_recorded, n_to_download = Observation(), Observation()
    recorded = stores.replace_table(
        worklist.counted(ingest.call_timestamps(ingest.recorded_calls(flat)), n_recorded, "n_recorded"), recorded_table)

    # written once: the requests and the append must see the same rows
    todo = worklist.counted(worklist.download_worklist(recorded, artifacts), n_to_download, "n_to_download")
    new_rows = materialize(ingest.history_rows(todo), "ingest-new-rows")
    requests = ingest.transcribe_requests(new_rows, audio_folder)
    return Prepared(recorded, new_rows, requests, {**n_recorded.get, **n_to_download.get})


def history_store(spark: SparkSession, path: str, id_width: int = ID_WIDTH) -> stores.KeyedStore:
    """The call history by call id (SNK-2)."""
    return stores.KeyedStore(spark, path, ["id"], F.expr(f"id div {int(id_width)}"))


def update_history(store: stores.KeyedStore, rows: DataFrame) -> stores.Snapshot:
    """Append the ids the history does not have and give late languages to
    their old rows; only the buckets of ``rows`` are read and written."""
    once = one_per_key(rows, "id", F.col("language") != NULL_SENTINEL)
    return store.merge(once, worklist.merge_history)


def complete_ingestion(spark: SparkSession, new_rows: DataFrame, results: DataFrame,
                       history_table: str, id_width: int = ID_WIDTH) -> DataFrame:
    """Attach languages (``'null'`` when a transcription failed) and bring the
    history up to date: ids it does not have are appended, and a call that
    failed before and has a language now gets it in its old row.

    ``results`` is ``(call_id, language, ...)`` from the transcription step.
    Returns the rows of this run.
    """
    rows = materialize(worklist.attach_language(new_rows, results), "ingest-rows")
    store = history_store(spark, stores.table_path(spark, history_table), id_width)
    update_history(store, rows)
    stores.publish(store, history_table)
    return rows


def transcript_store(spark: SparkSession, path: str, buckets: int = TRANSCRIPT_BUCKETS) -> stores.KeyedStore:
    """Transcripts by call (SNK-4): a run appends its own, the last write of a call wins."""
    return stores.KeyedStore(spark, path, ["call_id"], F.pmod(F.xxhash64("call_id"), F.lit(buckets)))


def transcript_rows(results: DataFrame) -> DataFrame:
    """``(call_id, text, language, n_chars)`` of a run's results, one per call.
    Two different results for one call stop the job; a result without a text
    or a call id cannot be looked up and is left out."""
    n = F.count(F.lit(1)).over(Window.partitionBy("call_id"))
    once = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("two transcripts for call "), F.col("call_id")))).otherwise(F.col("text"))
    given = results.select("call_id", "text", "language").where(F.col("text").isNotNull() & F.col("call_id").isNotNull()).distinct()
    return given.withColumn("_n", n).select("call_id", once.alias("text"), "language").withColumn("n_chars", F.length("text").cast("bigint"))


def store_transcripts(spark: SparkSession, results: DataFrame, table: str) -> DataFrame:
    """Keep a run's transcripts (SNK-4): only its own rows are written. A
    transcript that is already stored is replaced. Returns the rows written."""
    rows = materialize(transcript_rows(results), "transcripts-new")
    store = transcript_store(spark, stores.table_path(spark, table))
    if len(store.append(rows).deltas) > COMPACT_AFTER:
        store.compact()
    stores.publish(store, table)
    return rows


def attempt_store(spark: SparkSession, path: str) -> stores.KeyedStore:
    """The attempt log; an attempt written again by a repeated run counts once."""
    return stores.KeyedStore(spark, path, ["call_id", "attempted_at"], F.pmod(F.xxhash64("call_id"), F.lit(TRANSCRIPT_BUCKETS)))


def log_attempts(spark: SparkSession, results: DataFrame, table: str) -> DataFrame:
    """Append a run's attempts to the log (INF-2); the state of every call after it."""
    store = attempt_store(spark, stores.table_path(spark, table))
    log = attempt_log(results).groupBy("call_id", "attempted_at").agg(
        F.max(F.struct(F.col("error").isNull(), "language", "text", "error")).alias("_a"))
    store.append(log.select("call_id", "attempted_at", "_a.text", "_a.language", "_a.error"))
    return call_states(stores.publish(store, table))
