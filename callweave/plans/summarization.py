"""End-to-end summarisation run: cohort calls -> numbered headers ->
per-account bundles -> translation requests; then, after the external model
step, summary requests and the published account dimension.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave import stores
from callweave.constants import COHORT_CUTOFF
from callweave.operators import bundle, cohort, inference, worklist
from callweave.plans.ingestion import COMPACT_AFTER
from callweave.session import materialize


@dataclass
class Bundled:
    calls: DataFrame          # cohort calls with call_id (written once)
    status: DataFrame         # calls with has_audio / has_transcript
    downloads: DataFrame      # call ids whose audio is to be fetched
    transcribe: DataFrame     # transcription requests for calls lacking text
    bundles: DataFrame        # (account_id, part_no, n_parts, n_calls, bundle, ds_account)
    translate: DataFrame      # translation requests per bundle part


def build_bundles(tasks: DataFrame, opportunities: DataFrame, accounts: DataFrame,
                  users: DataFrame, transcripts: DataFrame, artifacts: DataFrame,
                  cutoff: str = COHORT_CUTOFF, part_chars: int = bundle.PART_CHARS,
                  on_missing: str = "empty", audio_folder: str = "audio", on_duplicate: str = "fail") -> Bundled:
    """The cohort calls (read by the bundles and the artifact status) and the
    bundles (read by the requests of both stages and by ``save_bundles``) are
    each written once and read back, so nothing above them runs twice. A user
    or account that is there twice stops the job unless ``on_duplicate`` says otherwise."""
    accs = cohort.cohort_accounts(accounts, opportunities, cutoff)
    calls = materialize(bundle.with_call_id(cohort.icp_calls(tasks, users, accs, on_duplicate)), "icp-calls")
    status = worklist.artifact_status(calls, artifacts)
    bundles = materialize(bundle.account_bundle(calls, transcripts, on_missing, part_chars), "bundles")
    return Bundled(calls, status, worklist.cohort_downloads(status), inference.transcribe_requests(status, audio_folder),
                   bundles, inference.translate_requests(bundles))


TEXT_KEY = ("account_id", "part_no", "kind", "run_date")
TEXT_BUCKETS = 256


def text_store(spark: SparkSession, path: str) -> stores.KeyedStore:
    """Bundles, translations and summaries (SNK-5..7) by account, part, kind and run date."""
    return stores.KeyedStore(spark, path, TEXT_KEY, F.pmod(F.xxhash64("account_id"), F.lit(TEXT_BUCKETS)))


def read_texts(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """The stored texts, each as it was last written."""
    rows = text_store(spark, path).read()
    return rows if kind is None else rows.where(F.col("kind") == kind)


def save_bundles(b: Bundled, texts_path: str, run_date: _dt.date) -> None:
    """Store bundles in the keyed text store (kind ``bundle``, SNK-5)."""
    save_texts(b.bundles.withColumnRenamed("bundle", "text"), "bundle", texts_path, run_date)


def save_texts(texts: DataFrame, kind: str, texts_path: str, run_date: _dt.date) -> None:
    """Store texts of one kind (``bundle``, ``translation`` or ``summary``)
    keyed by account and part under their run date (SNK-5..7). Texts of a
    run that is repeated replace its earlier ones; other dates stay."""
    rows = texts.select("account_id", "part_no", F.lit(kind).alias("kind"), F.lit(run_date).alias("run_date"), "text")
    store = text_store(texts.sparkSession, texts_path)
    if len(store.append(rows).deltas) > COMPACT_AFTER:
        store.compact()


def save_responses(responses: DataFrame, texts_path: str, run_date: _dt.date) -> None:
    """Store the run's translations and summaries (SNK-6, SNK-7)."""
    for kind in ("translation", "summary"):
        save_texts(inference.current_texts(responses, kind, run_date), kind, texts_path, run_date)


def account_dim(bundles: DataFrame, responses: DataFrame, run_date: _dt.date,
                strict: bool = False) -> DataFrame:
    """The account dimension of the bundles' accounts from this run's responses."""
    parts = bundles.select("account_id", "part_no", "n_parts", "ds_account")
    return inference.account_dim(parts, responses, run_date, strict)


def publish_dim(bundles: DataFrame, responses: DataFrame, run_date: _dt.date, table: str,
                strict: bool = False) -> DataFrame:
    """Replace the account dimension table in one commit (SNK-3)."""
    return stores.replace_table(account_dim(bundles, responses, run_date, strict), table)


def summary_requests(bundles: DataFrame, responses: DataFrame, run_date: _dt.date,
                     strict: bool = False) -> DataFrame:
    return inference.summary_requests(bundles.select("account_id", "part_no", "n_parts"), responses, run_date, strict=strict)
