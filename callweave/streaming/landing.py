"""Ingestion of landed feed pages as a file stream.

The reference pulls the feed periodically over an overlapping look-back
window and relies on the id anti-join to avoid double work. Here each page
file is read exactly once (the checkpoint tracks processed files), calls
that an overlapping pull landed again are dropped by a state store, and the
history-shaped rows of calls still lacking audio are appended to a pending
table by the exactly-once file sink. Nothing that was written before is read
again, so a batch costs what its own pages cost.

The state holds one entry per call id seen within the look-back of the
newest call (an event-time watermark on the call's start), so it stays as
large as the window, whatever the history. A call that starts before that
is outside the look-back window and is dropped as the batch run drops it.
Pages that cannot be read go to a dead-letter table by a stream of its own.

``availableNow`` makes it a scheduled batch job that stops when the landing
folder is drained.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.constants import LOOKBACK_DAYS
from callweave.operators import ingest, worklist
from callweave.sources.feed import dead_letters, read_pages_stream, whole_pages


def first_seen_calls(flat: DataFrame, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Flat calls of a stream without those whose id was seen within ``days`` before the newest call.

    A call without an id is told apart by its other fields. A call without a
    start takes its end, its answer or the time of the batch.
    """
    start = F.coalesce(F.timestamp_seconds(F.coalesce("started_at", "answered_at", "ended_at")), F.current_timestamp())
    rows = flat.withColumn("_at", start).withColumn("_key", worklist.row_identity(flat, "id"))
    return rows.withWatermark("_at", f"{int(days)} days").dropDuplicatesWithinWatermark(["_key"]).drop("_at", "_key")


def pending_rows(flat: DataFrame, artifacts: DataFrame) -> DataFrame:
    recorded = ingest.call_timestamps(ingest.recorded_calls(flat))
    return ingest.history_rows(worklist.download_worklist(recorded, artifacts))


def _start(rows: DataFrame, table: str, checkpoint_location: str, available_now: bool, fmt: str):
    writer = rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if available_now else writer).toTable(table)


def start_landing_ingest(spark: SparkSession, landing_dir: str, artifacts: DataFrame,
                         pending_table: str, checkpoint_location: str,
                         available_now: bool = True, fmt: str = "parquet", days: int = LOOKBACK_DAYS,
                         max_files_per_trigger: int | None = None):
    """Start the stream of calls; returns the ``StreamingQuery``."""
    pages = whole_pages(read_pages_stream(spark, landing_dir, max_files_per_trigger=max_files_per_trigger))
    flat = first_seen_calls(ingest.flatten_calls(pages), days)
    return _start(pending_rows(flat, artifacts), pending_table, checkpoint_location, available_now, fmt)


def start_dead_letters(spark: SparkSession, landing_dir: str, table: str, checkpoint_location: str,
                       available_now: bool = True, fmt: str = "parquet"):
    """Start the stream of pages that could not be read; returns the ``StreamingQuery``."""
    return _start(dead_letters(read_pages_stream(spark, landing_dir)), table, checkpoint_location, available_now, fmt)
