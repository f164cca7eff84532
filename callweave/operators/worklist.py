"""Which calls still need work, their response merge, and the history append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from callweave.constants import NULL_SENTINEL
from callweave.operators.attempts import latest_language
from callweave.operators.joins import match_key


def _others(df: DataFrame, key: str) -> list:
    """Columns that tell rows without a key apart."""
    return [df[c] for c in df.columns if c != key][:3] or [df[key]]


def held_keys(artifacts: DataFrame, kind: str) -> DataFrame:
    """Call ids held for one artifact kind."""
    return artifacts.where(F.col("kind") == kind).select(F.col("call_id").alias("_held"))


def download_worklist(recorded: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Recorded calls whose string id has no audio file (JN-1, FLT-8).

    A left-anti join instead of a per-row list scan; a NULL id has no match
    and is kept, as a membership test on the string would keep it.
    """
    held = held_keys(artifacts, "audio")
    key = match_key(recorded["id"], *_others(recorded, "id"))
    return recorded.join(held, key == held["_held"], "left_anti")


def artifact_status(calls: DataFrame, artifacts: DataFrame, key: str = "call_id") -> DataFrame:
    """Add ``has_audio`` / ``has_transcript`` flags per call (JN-5).

    The manifest is folded to one row per call id (partial aggregate, so a
    hot id costs one row per map task), then joined once -- instead of one
    join per artifact kind.
    """
    flags = (artifacts.groupBy(F.col("call_id").alias("_fk"))
             .agg(F.max(F.col("kind") == "audio").alias("_a"),
                  F.max(F.col("kind") == "transcript").alias("_t")))
    joined = calls.join(flags, match_key(calls[key], *_others(calls, key)) == flags["_fk"], "left")
    return joined.withColumns({
        "has_audio": F.coalesce(F.col("_a"), F.lit(False)),
        "has_transcript": F.coalesce(F.col("_t"), F.lit(False)),
    }).drop("_fk", "_a", "_t")


def cohort_downloads(status: DataFrame) -> DataFrame:
    """Ids of the cohort's calls whose audio is not held: what to fetch, once each."""
    return status.where(~F.col("has_audio") & F.col("call_id").isNotNull()).select("call_id").distinct()


def attach_language(new_rows: DataFrame, results: DataFrame,
                    sentinel: str = NULL_SENTINEL) -> DataFrame:
    """Attach the detected language by call id; ``sentinel`` when the
    transcription produced none (JN-6, INF-2). Keyed, not positional; of
    several results for one id the latest success counts."""
    res = latest_language(results)
    joined = new_rows.join(res, match_key(new_rows["id"], *_others(new_rows, "id")) == res["_cid"], "left")
    return joined.withColumn("language", F.coalesce(F.col("_lang"), F.lit(sentinel))) \
                 .drop("_cid", "_lang")


def append_history(history: DataFrame, new_rows: DataFrame,
                   dedupe_on: str | None = None) -> DataFrame:
    """History plus new rows, matched by column name (SET-1).

    Bag union by default, like the reference. ``dedupe_on="id"`` first drops
    new rows whose key is already in the history, so re-running a window
    that overlaps the last one appends nothing twice. A new row without a
    key is dropped if the history has the same row, languages aside.
    """
    if dedupe_on:
        known = history.select(row_identity(history, dedupe_on).alias("_known"))
        new_rows = new_rows.withColumn("_mine", row_identity(new_rows, dedupe_on)).join(
            known, F.col("_mine") == F.col("_known"), "left_anti").drop("_mine")
    return history.unionByName(new_rows, allowMissingColumns=True)


def row_identity(rows: DataFrame, key: str, aside: str = "language") -> Column:
    """``key`` as a string; where it is NULL, a text no key equals, of the row's other columns but ``aside``."""
    others = F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns) if c not in (key, aside)]))
    return F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\x00"), others))


def merge_history(history: DataFrame, new_rows: DataFrame, sentinel: str = NULL_SENTINEL) -> DataFrame:
    """Keyed append in which a retried call's language reaches its old row:
    rows whose language is still ``sentinel`` take the one ``new_rows`` has."""
    late = (new_rows.where(F.col("language") != sentinel).groupBy(row_identity(new_rows, "id").alias("_late"))
            .agg(F.max("language").alias("_lang")))
    known = history.withColumn("_mine", row_identity(history, "id")).join(late, F.col("_mine") == F.col("_late"), "left")
    language = F.when(F.col("language") == sentinel, F.coalesce(F.col("_lang"), F.col("language"))).otherwise(F.col("language"))
    return append_history(known.withColumn("language", language).select(*history.columns), new_rows, "id")


def counted(rows: DataFrame, into: Observation, name: str) -> DataFrame:
    """``rows``, counted by the job that writes them (AG-4): ``into.get[name]`` afterwards."""
    return rows.observe(into, F.count(F.lit(1)).alias(name))


def run_counts(recorded: DataFrame, artifacts: DataFrame) -> DataFrame:
    """One row: recorded calls and how many of them need a download (AG-4)."""
    held = held_keys(artifacts, "audio").distinct()
    key = match_key(recorded["id"], *_others(recorded, "id"))
    flagged = recorded.join(held, key == held["_held"], "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("n_recorded"),
        F.count_if(F.col("_held").isNull()).alias("n_to_download"),
    )
