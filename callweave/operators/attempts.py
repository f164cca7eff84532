"""The log of transcription attempts and the state of each call.

One row per attempt: ``(call_id, attempted_at, text, language, error)``. An
attempt without an error is a success. A call's text and language are those
of its latest success, so a later transcript replaces an earlier one and a
late success replaces earlier failures; its ``error`` is that of the latest
attempt where that failed. Attempts at the same time are told apart by
success, language and text, so reruns agree. A call that failed is due again
after a delay that doubles with every failure in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RETRY_MINUTES = 15
MOST_DOUBLINGS = 10


def attempt_log(results: DataFrame) -> DataFrame:
    """``results`` of a transcription step in the log's layout. A result with neither text nor
    language has failed; steps that state no time or error leave them NULL."""
    none = {c: F.lit(None).cast(t) for c, t in (("attempted_at", "timestamp_ntz"), ("text", "string"), ("language", "string"), ("error", "string")) if c not in results.columns}
    rows = results.withColumns(none) if none else results
    failed = F.when(F.col("text").isNull() & F.col("language").isNull(), F.coalesce("error", F.lit("no result"))).otherwise(F.col("error"))
    return rows.select("call_id", "attempted_at", "text", "language", failed.alias("error"))


def _late(*also: str) -> Column:
    """Orders attempts; a NULL time is the earliest."""
    return F.struct(F.col("attempted_at").isNotNull(), "attempted_at", F.col("error").isNull(), *also)


def call_states(attempts: DataFrame, retry_minutes: int = RETRY_MINUTES) -> DataFrame:
    """One row per call: ``call_id, n_attempts, n_failures, attempted_at, text, language, error, next_due_at``.

    ``n_failures`` counts the failures after the latest success. All of it is
    two partial aggregates: a call tried often costs one row per task.
    """
    ok = F.col("error").isNull()
    success = attempts.where(ok).groupBy(F.col("call_id").alias("_ok_id")).agg(
        F.max(_late("language", "text")).alias("_ok"))
    last = attempts.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("n_attempts"), F.max(_late("error")).alias("_last"))
    # failures after the latest success: only the failures' times meet the success, as lean rows
    failures = attempts.where(~ok).groupBy("call_id", "attempted_at").agg(F.count(F.lit(1)).alias("_n"))
    later = failures.join(success, failures["call_id"].eqNullSafe(success["_ok_id"]), "left").where(
        F.col("_ok").isNull() | (F.struct(F.col("attempted_at").isNotNull(), "attempted_at") > F.struct(F.col("_ok.attempted_at").isNotNull(), F.col("_ok.attempted_at"))))
    since = later.groupBy(F.col("call_id").alias("_bad_id")).agg(F.sum("_n").alias("_failures"))
    both = last.join(success, last["call_id"].eqNullSafe(success["_ok_id"]), "left").join(since, last["call_id"].eqNullSafe(since["_bad_id"]), "left")
    n = F.coalesce("_failures", F.lit(0)).cast("long")
    wait = F.lit(retry_minutes) * F.pow(F.lit(2.0), F.least(n - 1, F.lit(MOST_DOUBLINGS))).cast("int")
    return both.select(
        "call_id", "n_attempts", n.alias("n_failures"), F.col("_last.attempted_at").alias("attempted_at"),
        F.col("_ok.text").alias("text"), F.col("_ok.language").alias("language"), F.col("_last.error").alias("error"),
        F.when(F.col("_last.error").isNotNull(), F.timestamp_add("MINUTE", wait, F.col("_last.attempted_at"))).alias("next_due_at"))


def due_calls(states: DataFrame, as_of: Column) -> DataFrame:
    """Ids of the calls whose latest attempt failed and whose waiting time is over."""
    return states.where(F.col("error").isNotNull() & (F.col("next_due_at").isNull() | (F.col("next_due_at") <= as_of))).select("call_id")


def latest_language(results: DataFrame) -> DataFrame:
    """(_cid, _lang): the language of each call's latest success."""
    log = attempt_log(results).where(F.col("error").isNull() & F.col("language").isNotNull())
    return log.groupBy(F.col("call_id").alias("_cid")).agg(F.max_by("language", _late("language")).alias("_lang"))
