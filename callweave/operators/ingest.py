"""Feed ingestion: nested pages -> flat recorded calls -> history rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.constants import (AUDIO_EXT, LOOKBACK_DAYS, NULL_SENTINEL, TRANSCRIBE_FORMAT,
                                 TRANSCRIBE_MODEL, TRANSCRIBE_TEMPERATURE)
from callweave.functions.ids import artifact_path
from callweave.functions.time import epoch_to_timestamp, lookback_start_epoch
from callweave.operators.keyed import one_per_key

_USER_FIELDS = [("id", "user_id"), ("name", "user_name"), ("email", "user_email"),
                ("available", "user_available")]


def flatten_calls(pages: DataFrame, null_sentinel: str | None = NULL_SENTINEL,
                  dedupe_on_id: bool = False) -> DataFrame:
    """Pages x calls -> 12 flat fields (PRJ-1, PRJ-2, FLT-7).

    A call without a user gets ``null_sentinel`` in its four ``user_*``
    fields; a present user with a missing field keeps NULL there, as the
    reference does. ``null_sentinel=None`` keeps real NULLs instead.
    ``user_id``/``user_available`` are strings because the sentinel shares
    their column. Duplicate ids across pages are kept unless ``dedupe_on_id``;
    calls without an id are never duplicates of one another.
    """
    c = pages.select(F.explode("calls").alias("c"))
    no_user = F.col("c.user").isNull()

    def user_field(src: str) -> Column:
        value = F.col(f"c.user.{src}").cast("string")
        if null_sentinel is None:
            return value
        return F.when(no_user, F.lit(null_sentinel)).otherwise(value)

    flat = c.select(
        F.col("c.id").alias("id"),
        F.col("c.number.id").alias("number_id"),
        F.col("c.number.name").alias("number_name"),
        F.col("c.started_at").alias("started_at"),
        F.col("c.answered_at").alias("answered_at"),
        F.col("c.ended_at").alias("ended_at"),
        F.col("c.direction").alias("direction"),
        F.col("c.recording").alias("recording"),
        *[user_field(src).alias(dst) for src, dst in _USER_FIELDS],
    )
    return one_per_key(flat, "id") if dedupe_on_id else flat


def recent_pages(pages: DataFrame, as_of: Column | None = None,
                 days: int = LOOKBACK_DAYS) -> DataFrame:
    """Pages holding at least one call inside the look-back window.

    A page-level pre-filter (JVM-side ``exists`` over the calls array) so
    pages entirely outside the window are dropped before ``explode``; the
    per-call filter of :func:`lookback_calls` still applies afterwards.
    """
    if as_of is None:
        as_of = F.current_timestamp().cast("timestamp_ntz")
    # the bound is a column of its own: a scalar subquery may not sit inside
    # the lambda, but the lambda may read an outer column
    bounded = pages.withColumn("_lb_start", lookback_start_epoch(as_of, days))
    return (bounded.where(F.exists("calls", lambda c: c["started_at"] >= F.col("_lb_start")))
            .drop("_lb_start"))


def recorded_calls(flat: DataFrame) -> DataFrame:
    """Keep calls that have a recording (FLT-2)."""
    return flat.where(F.col("recording").isNotNull())


def call_timestamps(flat: DataFrame) -> DataFrame:
    """Add ``*_ts`` TIMESTAMP_NTZ columns from the epoch fields (PRJ-3, FN-9)."""
    return flat.withColumns({
        "started_at_ts": epoch_to_timestamp("started_at"),
        "answered_at_ts": epoch_to_timestamp("answered_at"),
        "ended_at_ts": epoch_to_timestamp("ended_at"),
    })


def lookback_calls(flat: DataFrame, as_of: Column | None = None,
                   days: int = LOOKBACK_DAYS, newest_first: bool = True) -> DataFrame:
    """Calls started within ``days`` before ``as_of`` (FLT-1, FN-10, SRT-2).

    ``as_of`` defaults to the current timestamp; any column expression,
    including a scalar subquery (``df.select(max(..)).scalar()``), works.
    The bound is evaluated once per run, before the calls are filtered.
    """
    if as_of is None:
        as_of = F.current_timestamp().cast("timestamp_ntz")
    out = flat.where(F.col("started_at") >= lookback_start_epoch(as_of, days))
    if newest_first:
        out = out.orderBy(F.col("started_at").desc(), F.col("id").asc())
    return out


def history_rows(recorded_ts: DataFrame) -> DataFrame:
    """Recorded calls with timestamps -> history column layout (PRJ-4).

    Renames ``user_name -> user_full_name``, ``user_available -> available``
    and ``*_ts -> *``; drops ``recording`` and the raw epochs.
    """
    return recorded_ts.select(
        "id", "number_id", "number_name", "user_id",
        F.col("user_name").alias("user_full_name"), "user_email",
        F.col("started_at_ts").alias("started_at"),
        F.col("answered_at_ts").alias("answered_at"),
        F.col("ended_at_ts").alias("ended_at"),
        "direction", F.col("user_available").alias("available"),
    )


def transcribe_requests(new_rows: DataFrame, audio_folder: str = "audio") -> DataFrame:
    """One transcription request per call without audio (INF-1), asked again
    on every run until the audio is held."""
    return new_rows.select(
        F.col("id").cast("string").alias("call_id"),
        artifact_path(audio_folder, F.col("id"), AUDIO_EXT).alias("audio_path"),
        F.lit(TRANSCRIBE_MODEL).alias("model"), F.lit(TRANSCRIBE_FORMAT).alias("response_format"),
        F.lit(TRANSCRIBE_TEMPERATURE).alias("temperature"))
