"""Registered queries: one per operator group of the blueprint.

Each entry takes ``(spark, sf_dir)``, reads the driver tables through the
overlay and returns a lazy DataFrame: building one runs no job. The same names are the keys of
``callweave.plans.oracle.ORACLE_SQL``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.constants import TEXT_EXT
from callweave.functions.ids import artifact_path, extract_call_id
from callweave.functions.text import normalize_newlines, strip_whitespace
from callweave.functions.time import run_date_string
from callweave.operators import attempts, bundle, cohort, inference, ingest, worklist
from callweave.sources import feed, overlay
from callweave.sources.feed import parse_pages

AUDIO_DIR = "/data/calls/audio"
TEXT_DIR = "/data/calls/transcripts"
SUMMARY_DIR = "summaries"
# Part size of the queries whose accounts cross part boundaries.
SMALL_PART = 4000
RUN_DATE = overlay.RUN_DATE
# Run dates of the as-of dimension, in days from RUN_DATE; responses exist for -1 and 0.
AS_OF_DAYS = (-2, -1, 0, 3)

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------- ingestion
def flatten_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.flatten_calls(overlay.feed_pages(spark, sf_dir))


def recorded_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.recorded_calls(flatten_calls(spark, sf_dir))


def lookback_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = overlay.read_table(spark, sf_dir, "events").select(F.max("ts")).scalar()
    pages = ingest.recent_pages(overlay.feed_pages(spark, sf_dir), as_of=newest)
    return ingest.lookback_calls(ingest.flatten_calls(pages), as_of=newest)


def call_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.call_timestamps(recorded_calls(spark, sf_dir))


def download_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.download_worklist(call_timestamps(spark, sf_dir),
                                      overlay.artifacts(spark, sf_dir))


def new_call_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.history_rows(download_worklist(spark, sf_dir))


def language_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.attach_language(new_call_rows(spark, sf_dir), overlay.transcripts(spark, sf_dir))


def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.append_history(overlay.history(spark, sf_dir), language_attach(spark, sf_dir))


def history_append_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History append with the keyed de-dup option (D3): new rows whose id the
    history already holds are not appended again."""
    return worklist.append_history(overlay.history(spark, sf_dir), language_attach(spark, sf_dir),
                                   dedupe_on="id")


def history_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed append in which a retried call's late language reaches its old row."""
    return worklist.merge_history(overlay.history(spark, sf_dir), language_attach(spark, sf_dir))


def retry_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcription requests of an ingest run: calls without audio, among
    them those that failed before and are in the history already."""
    return ingest.transcribe_requests(new_call_rows(spark, sf_dir), AUDIO_DIR)


def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed parsed from pages landed as JSON text (SRC-1)."""
    landed = overlay.feed_pages(spark, sf_dir).select(F.to_json(F.struct("calls", "meta")).alias("value"))
    return ingest.flatten_calls(parse_pages(landed))


def landed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls of a damaged landing's readable pages (SRC-1)."""
    return ingest.flatten_calls(feed.whole_pages(feed.parse_landed(overlay.landed_feed(spark, sf_dir))))


def page_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the landed pages form a whole chain of links (SRC-1, SET-2)."""
    return feed.page_report(feed.parse_landed(overlay.landed_feed(spark, sf_dir)))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.dead_letters(feed.parse_landed(overlay.landed_feed(spark, sf_dir)))


def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.missing_links(feed.parse_landed(overlay.landed_feed(spark, sf_dir)))


def call_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, language, error and next attempt of each call from the attempt log (INF-2)."""
    return attempts.call_states(overlay.attempts(spark, sf_dir))


def late_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages by the latest successful attempt (JN-6)."""
    return worklist.attach_language(new_call_rows(spark, sf_dir), overlay.attempts(spark, sf_dir))


def due_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = overlay.read_table(spark, sf_dir, "events").select(F.max("ts")).scalar()
    return attempts.due_calls(call_states(spark, sf_dir), newest)


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.run_counts(recorded_calls(spark, sf_dir), overlay.artifacts(spark, sf_dir))


# ---------------------------------------------------------------- cohort
def recorded_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.recorded_tasks(overlay.tasks(spark, sf_dir))


def inbound_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.inbound_accounts(overlay.opportunities(spark, sf_dir))


def cohort_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.cohort_accounts(overlay.accounts(spark, sf_dir), overlay.opportunities(spark, sf_dir))


def icp_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.icp_calls(overlay.tasks(spark, sf_dir), overlay.users(spark, sf_dir),
                            cohort_accounts(spark, sf_dir))


def icp_calls_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort calls over a user table that holds users twice, each counted once (D8)."""
    return cohort.icp_calls(overlay.tasks(spark, sf_dir), overlay.repeated_users(spark, sf_dir),
                            cohort_accounts(spark, sf_dir), on_duplicate="first")


def _icp_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.with_call_id(icp_calls(spark, sf_dir))


def call_id_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = recorded_tasks(spark, sf_dir)
    return t.select("Id", "aircall__Call_Recording__c",
                    extract_call_id("aircall__Call_Recording__c").alias("call_id"))


# ---------------------------------------------------------------- bundle
def call_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.number_calls(_icp_with_ids(spark, sf_dir))


def first_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.first_calls(_icp_with_ids(spark, sf_dir))


def _headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.call_headers(call_numbers(spark, sf_dir))


def call_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _headed(spark, sf_dir).select("AccountId", "Id", "call_id", "call_no", "header")


def account_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.account_bundle(_icp_with_ids(spark, sf_dir), overlay.transcripts(spark, sf_dir))


def account_bundle_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bundles cut into parts that the data crosses (see the part contract)."""
    return bundle.account_bundle(_icp_with_ids(spark, sf_dir), overlay.transcripts(spark, sf_dir),
                                 part_chars=SMALL_PART)


def account_bundle_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bundle with ``on_missing="drop"`` (D13): calls without a transcript
    are left out but keep their numbers."""
    return bundle.account_bundle(_icp_with_ids(spark, sf_dir), overlay.transcripts(spark, sf_dir), "drop")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small parts of every account: some have no response."""
    return bundle.account_parts(_icp_with_ids(spark, sf_dir), overlay.transcripts(spark, sf_dir), SMALL_PART)


def account_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.account_name(icp_calls(spark, sf_dir))


def account_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.account_pairs(icp_calls(spark, sf_dir))


def conversation_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundle.turn_bundle(overlay.read_table(spark, sf_dir, "conversations"))


# ------------------------------------------------------------- artifacts
def artifact_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = bundle.with_call_id(recorded_tasks(spark, sf_dir))
    return t.select("Id", "call_id",
                    artifact_path(AUDIO_DIR, F.col("call_id"), ".mp3").alias("audio_path"),
                    artifact_path(TEXT_DIR, F.col("call_id"), TEXT_EXT).alias("transcript_path"))


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.artifact_status(_icp_with_ids(spark, sf_dir), overlay.artifacts(spark, sf_dir))


def artifact_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(spark, sf_dir).select("Id", "AccountId", "call_id", "has_audio", "has_transcript")


def cohort_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.cohort_downloads(_status(spark, sf_dir))


def newline_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts landed with ``\\r\\n`` and ``\\r`` line ends, read as text (FN-11)."""
    landed = overlay.read_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")), F.lit("\r")).alias("raw"))
    return landed.select("doc_id", normalize_newlines("raw").alias("text"))


# ------------------------------------------------------------- inference
def transcribe_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference.transcribe_requests(_status(spark, sf_dir), AUDIO_DIR)


def translate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference.translate_requests(account_bundle(spark, sf_dir))


def summary_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference.summary_requests(_parts(spark, sf_dir), overlay.responses(spark, sf_dir), RUN_DATE)


def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = inference.strip_responses(overlay.responses(spark, sf_dir))
    return stripped.select("account_id", "part_no", "kind", "text")


def strip_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses between Unicode spaces, stripped as ``str.strip`` does (FN-7)."""
    wide = F.concat(F.lit("\u2003\u00a0"), F.col("text"), F.lit("\u3000\u2028 "))
    return overlay.responses(spark, sf_dir).select("account_id", "part_no", "kind", "run_date", strip_whitespace(wide, unicode=True).alias("text"))


def run_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = overlay.responses(spark, sf_dir).where(F.col("kind") == "summary")
    day = run_date_string("run_date")
    return r.select("account_id", day.alias("run_dir"),
                    F.concat(F.lit(SUMMARY_DIR + "/"), day, F.lit("/"), F.col("account_id"),
                             F.when(F.col("part_no") > 0, F.concat(F.lit("-"), F.col("part_no").cast("string")))
                              .otherwise(F.lit("")), F.lit(TEXT_EXT)).alias("path"))


def account_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference.account_dim(_parts(spark, sf_dir), overlay.responses(spark, sf_dir), RUN_DATE)


def account_dim_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension at run dates before, at, between and after those with responses (SNK-7, JN-8)."""
    days = [RUN_DATE + dt.timedelta(days=n) for n in AS_OF_DAYS]
    return inference.account_dim_as_of(_parts(spark, sf_dir), overlay.responses(spark, sf_dir), days)


QUERIES: dict[str, Query] = {
    "flatten_calls": flatten_calls,
    "recorded_calls": recorded_calls,
    "lookback_calls": lookback_calls,
    "call_timestamps": call_timestamps,
    "download_worklist": download_worklist,
    "new_call_rows": new_call_rows,
    "language_attach": language_attach,
    "history_append": history_append,
    "history_append_keyed": history_append_keyed,
    "history_merge": history_merge,
    "retry_requests": retry_requests,
    "json_pages": json_pages,
    "landed_calls": landed_calls,
    "page_report": page_report,
    "dead_letters": dead_letters,
    "missing_pages": missing_pages,
    "call_states": call_states,
    "late_languages": late_languages,
    "due_calls": due_calls,
    "run_counts": run_counts,
    "recorded_tasks": recorded_tasks,
    "inbound_accounts": inbound_accounts,
    "cohort_accounts": cohort_accounts,
    "icp_calls": icp_calls,
    "icp_calls_unique": icp_calls_unique,
    "call_id_extract": call_id_extract,
    "call_numbers": call_numbers,
    "first_calls": first_calls,
    "call_headers": call_headers,
    "account_bundle": account_bundle,
    "account_bundle_drop": account_bundle_drop,
    "account_bundle_parts": account_bundle_parts,
    "account_name": account_name,
    "account_pairs": account_pairs,
    "conversation_bundle": conversation_bundle,
    "artifact_paths": artifact_paths,
    "artifact_status": artifact_status,
    "cohort_downloads": cohort_downloads,
    "newline_texts": newline_texts,
    "transcribe_requests": transcribe_requests,
    "translate_requests": translate_requests,
    "summary_requests": summary_requests,
    "strip_text": strip_text,
    "strip_unicode": strip_unicode,
    "run_date": run_date,
    "account_dim": account_dim,
    "account_dim_as_of": account_dim_as_of,
}
