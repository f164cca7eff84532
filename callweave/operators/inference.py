"""Model request tables and response merges (batch inference as data work).

The remote calls themselves are out of scope: these functions build the
table that goes to a batch-inference step and merge what comes back, by
key. Responses are a keyed table ``(account_id, part_no, kind, run_date,
text)``; ``kind`` is ``translation`` or ``summary``, ``part_no`` the bundle
part the request was made for.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callweave.constants import (AUDIO_EXT, CHAT_MODEL, CHAT_SEED, SUMMARY_TEMPLATE,
                                 TRANSCRIBE_FORMAT, TRANSCRIBE_MODEL, TRANSCRIBE_TEMPERATURE,
                                 TRANSLATE_TEMPLATE)
from callweave.functions.ids import artifact_path
from callweave.functions.text import fill_template, strip_whitespace
from callweave.operators.joins import match_key


def transcribe_requests(status: DataFrame, audio_folder: str = "audio") -> DataFrame:
    """One request per call id lacking a transcript (INF-1)."""
    todo = (status.where(~F.col("has_transcript") & F.col("call_id").isNotNull())
            .select("call_id").distinct())
    return todo.select(
        "call_id",
        artifact_path(audio_folder, F.col("call_id"), AUDIO_EXT).alias("audio_path"),
        F.lit(TRANSCRIBE_MODEL).alias("model"),
        F.lit(TRANSCRIBE_FORMAT).alias("response_format"),
        F.lit(TRANSCRIBE_TEMPERATURE).alias("temperature"),
    )


def translate_requests(bundles: DataFrame, template: str = TRANSLATE_TEMPLATE) -> DataFrame:
    """One chat request per bundle part: system = template filled with the
    account name, user = the bundle text (INF-3, FN-6)."""
    return bundles.select(
        "account_id", "part_no", "n_parts",
        F.lit(CHAT_MODEL).alias("model"), F.lit(CHAT_SEED).cast("bigint").alias("seed"),
        fill_template(template, account_name=F.col("ds_account")).alias("system"),
        F.col("bundle").alias("user"),
    )


def current_texts(responses: DataFrame, kind: str, run_date: _dt.date) -> DataFrame:
    """(account_id, part_no, text): the run's stripped responses of one kind.

    Filtering on ``run_date`` prunes to that partition when stored
    partitioned (D2: summaries are read from the run they were written in).
    Two responses for one key stop the job: neither is known to be right.
    """
    rows = responses.where((F.col("run_date") == F.lit(run_date)) & (F.col("kind") == kind))
    if "part_no" not in rows.columns:
        rows = rows.withColumn("part_no", F.lit(0).cast("bigint"))
    n = F.count(F.lit(1)).over(Window.partitionBy("account_id", "part_no"))
    text = F.when(F.col("_n") > 1, F.raise_error(F.concat(
        F.lit(f"more than one {kind} for account "), F.coalesce(F.col("account_id"), F.lit("NULL"))))).otherwise(strip_whitespace("text"))
    return rows.withColumn("_n", n).select("account_id", "part_no", text.alias("text"))


def _answers(parts: DataFrame, responses: DataFrame, kind: str, run_date: _dt.date, strict: bool) -> DataFrame:
    """``parts`` with the run's text of one kind, every part kept; NULL where
    there is none, or the job fails if ``strict``."""
    rows = current_texts(responses, kind, run_date).withColumnsRenamed({"account_id": "_aid", "part_no": "_part", "text": kind})
    joined = parts.join(rows, (match_key(parts["account_id"], parts["part_no"]) == rows["_aid"]) & (parts["part_no"] == rows["_part"]), "left").drop("_aid", "_part")
    if strict:
        name = F.concat(F.lit(f"missing {kind} for account "), F.coalesce(F.col("account_id"), F.lit("NULL")), F.lit(", part "), F.col("part_no").cast("string"))
        joined = joined.withColumn(kind, F.coalesce(F.col(kind), F.raise_error(name).cast("string")))
    return joined


def summary_requests(parts: DataFrame, responses: DataFrame, run_date: _dt.date,
                     template: str = SUMMARY_TEMPLATE, strict: bool = False) -> DataFrame:
    """Second-stage request per bundle part: user = the stripped stage-1
    output of that part (INF-4, FN-7). ``parts`` says which parts there are
    (``bundle.account_parts`` or the bundles), so a part without a stage-1
    answer is seen: its ``user`` is NULL, or the job fails if ``strict``."""
    return _answers(parts, responses, "translation", run_date, strict).select(
        "account_id", "part_no", "n_parts", F.lit(CHAT_MODEL).alias("model"),
        F.lit(CHAT_SEED).cast("bigint").alias("seed"),
        F.lit(template).alias("system"), F.col("translation").alias("user"),
    )


def strip_responses(responses: DataFrame) -> DataFrame:
    """Responses with leading/trailing whitespace removed (FN-7)."""
    return responses.withColumn("text", strip_whitespace("text"))


def account_dim(parts: DataFrame, responses: DataFrame, run_date: _dt.date,
                strict: bool = False) -> DataFrame:
    """(AccountId, part_no, n_parts, ds_account, translation, summary) (JN-8,
    INF-5, PRJ-7): one row per bundle part, by two keyed joins. A part
    without a response has NULL there; ``strict=True`` fails on it instead,
    as a missing file did in the original workflow."""
    both = _answers(_answers(parts, responses, "translation", run_date, strict), responses, "summary", run_date, strict)
    return both.select(F.col("account_id").alias("AccountId"), "part_no", "n_parts", "ds_account", "translation", "summary")


def texts_as_of(responses: DataFrame, kind: str, run_dates: Sequence[_dt.date]) -> DataFrame:
    """(account_id, part_no, as_of, text, text_date): for each of some run
    dates the stripped response of the latest run on or before it.

    One aggregate with a filtered maximum per run date, so a key costs one
    row per task whatever its history; run dates before a key's first
    response give no text. Of several responses of one run the largest text
    is taken.
    """
    rows = responses.where(F.col("kind") == kind)
    if "part_no" not in rows.columns:
        rows = rows.withColumn("part_no", F.lit(0).cast("bigint"))
    latest = [F.expr(f"max(struct(run_date, text)) FILTER (WHERE run_date <= DATE'{d.isoformat()}')").alias(f"_{i}") for i, d in enumerate(run_dates)]
    wide = rows.groupBy("account_id", "part_no").agg(*latest)
    found = F.explode(F.array(*[F.struct(F.lit(d).alias("as_of"), F.col(f"_{i}").alias("found")) for i, d in enumerate(run_dates)])).alias("_f")
    return wide.select("account_id", "part_no", found).select(
        "account_id", "part_no", "_f.as_of", strip_whitespace("_f.found.text").alias("text"), F.col("_f.found.run_date").alias("text_date"))


def account_dim_as_of(parts: DataFrame, responses: DataFrame, run_dates: Sequence[_dt.date]) -> DataFrame:
    """The account dimension at each of some run dates, with the texts of the
    latest runs on or before it and the dates of those (D2): a run without a
    summary of its own shows the last one there was."""
    wanted = parts.withColumn("as_of", F.explode(F.array(*[F.lit(d) for d in run_dates])))
    for kind in ("translation", "summary"):
        rows = texts_as_of(responses, kind, run_dates).withColumnsRenamed(
            {"account_id": "_aid", "part_no": "_part", "as_of": "_on", "text": kind, "text_date": f"{kind}_date"})
        same = (match_key(wanted["account_id"], wanted["part_no"]) == rows["_aid"]) & (wanted["part_no"] == rows["_part"]) & (wanted["as_of"] == rows["_on"])
        wanted = wanted.join(rows, same, "left").drop("_aid", "_part", "_on")
    return wanted.select(F.col("account_id").alias("AccountId"), "part_no", "n_parts", "ds_account", "as_of",
                         "translation", "translation_date", "summary", "summary_date")
