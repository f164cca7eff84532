"""Domain tables presented over the driver's test tables.

The reference reads CRM tables, a nested call feed and folders of files.
The test data has none of these, so each domain table is a projection of
a driver table with a fixed formula (stated in FIXTURES.md and repeated in
the DuckDB oracle). Every formula is a narrow projection except the feed,
which nests ``events`` into pages of ``PAGE_SIZE`` calls.

  feed          <- events     (user NULL for 'error', recording NULL for 'view',
                               answered_at NULL for 'click', a present user's
                               email NULL for 'signup' of every tenth user)
  tasks         <- orders     (recording 'null' for status P, NULL for F,
                               no call id for priority 5-LOW)
  opportunities <- orders     (flag = priority 1-URGENT)
  accounts      <- customer   (created 2024-01-01 + (7 * c_custkey) % 365 days;
                               custkey 26 lands exactly on the cutoff)
  users         <- supplier
  transcripts   <- documents  (call_id = doc_id, language = lang)
  artifacts     <- labels (audio) and documents (transcript)
  landed feed   <- the feed as JSON texts, damaged by page number
  attempts      <- events (three in a row are the attempts of one call)
  history       <- feed calls whose audio is held, and calls that failed
                               before (id % 7 = 0, no audio, language 'null')
  responses     <- documents  (padded translation / summary texts for part 0,
                               for part 1 of even accounts too, plus a stale
                               summary of the previous run date)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.constants import AUDIO_EXT, PAGE_SIZE, TEXT_EXT
from callweave.functions.time import timestamp_to_epoch
from callweave.schemas import DRIVER_TABLES

# Run date of the overlay's stand-in model responses.
RUN_DATE = _dt.date(2025, 1, 6)
ACCOUNT_EPOCH = "2024-01-01 00:00:00"
URL_HOST = "https://host.example"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read with its declared schema (no inference job)."""
    reader = spark.read
    if name in DRIVER_TABLES:
        reader = reader.schema(DRIVER_TABLES[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(col: str) -> Column:
    return F.col(col).cast("string")


# --------------------------------------------------------------------- feed
def feed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested call struct per event (column ``call``) plus its page no."""
    ev = read_table(spark, sf_dir, "events")
    start = timestamp_to_epoch(F.col("ts"))
    number_id = (F.col("user_id") / 25).cast("bigint")
    user = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.struct(
        F.col("user_id").alias("id"),
        F.concat(F.lit("Agent "), _s("user_id")).alias("name"),
        F.when(~((F.col("event_type") == "signup") & (F.col("user_id") % 10 == 0)),
               F.concat(F.lit("agent"), _s("user_id"), F.lit("@host.example"))).alias("email"),
        (F.col("value") >= 50.0).alias("available"),
    ))
    call = F.struct(
        F.col("event_id").alias("id"),
        F.struct(number_id.alias("id"),
                 F.concat(F.lit("Line "), number_id.cast("string")).alias("name")).alias("number"),
        start.alias("started_at"),
        F.when(F.col("event_type") == "click", F.lit(None).cast("bigint"))
         .otherwise(start + 3).alias("answered_at"),
        (start + F.floor(F.col("value")).cast("bigint") + 3).alias("ended_at"),
        F.when(F.col("event_type").isin("purchase", "signup"), F.lit("inbound"))
         .otherwise(F.lit("outbound")).alias("direction"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(URL_HOST + "/recordings/"), _s("event_id"), F.lit(AUDIO_EXT)))
         .alias("recording"),
        user.alias("user"),
    )
    return ev.select((F.col("event_id") / PAGE_SIZE).cast("bigint").alias("page_no"),
                     call.alias("call"))


def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events nested into landed-page shape: ``{calls: [...], meta: {...}}``.

    A page holds at most ``PAGE_SIZE`` calls, so each group is bounded.
    """
    pages = feed_calls(spark, sf_dir).groupBy("page_no").agg(F.collect_list("call").alias("calls"))
    return pages.select("calls", F.struct(_page_link(F.col("page_no") + 1).alias("next_page_link")).alias("meta"))


def _page_link(page_no: Column) -> Column:
    return F.concat(F.lit(URL_HOST + "/v1/calls?page="), page_no.cast("string"))


def landed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a lander left it, ``(page_link, value)``: JSON texts, the
    last page with a null link. Damage is planted by page number: 3 of every
    17 is cut off, 5 of every 23 was never landed, 4 of every 19 came twice,
    6 of every 29 has no calls field."""
    feed = feed_calls(spark, sf_dir)
    last = feed.select(F.max("page_no")).scalar()
    pages = feed.groupBy("page_no").agg(F.collect_list("call").alias("calls"))
    no = F.col("page_no")
    meta = F.struct(F.when(no < last, _page_link(no + 1)).alias("next_page_link")).alias("meta")
    text = F.when(no % 29 == 6, F.to_json(F.struct(meta))).otherwise(F.to_json(F.struct(F.col("calls"), meta)))
    text = F.when(no % 17 == 3, F.substring(text, 1, 10)).otherwise(text)
    times = F.when(no % 23 == 5, F.expr("array()")).when(no % 19 == 4, F.expr("array(1, 2)")).otherwise(F.expr("array(1)"))
    return pages.select(_page_link(no).alias("page_link"), text.alias("value"), F.explode(times.cast("array<int>"))).drop("col")


# ---------------------------------------------------------------------- CRM
def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    key = _s("o_orderkey")
    recording = (F.when(F.col("o_orderstatus") == "P", F.lit("null"))
                 .when(F.col("o_orderstatus") == "F", F.lit(None).cast("string"))
                 .when(F.col("o_orderpriority") == "5-LOW",
                       F.concat(F.lit(URL_HOST + "/voicemail/"), key))
                 .otherwise(F.concat(F.lit(URL_HOST + "/calls/"), key, F.lit("/recording"))))
    inbound = F.col("o_totalprice") >= 200000.0
    return o.select(
        key.alias("Id"),
        F.concat(F.lit("003"), _s("o_custkey")).alias("WhoId"),
        F.concat(F.lit("006"), key).alias("WhatId"),
        _s("o_custkey").alias("AccountId"),
        (F.col("o_orderkey") % 140).cast("string").alias("OwnerId"),
        F.concat(F.lit("Call "), F.col("o_orderpriority")).alias("Subject"),
        F.when(F.col("o_totalprice") >= 100000.0, F.lit("DE")).otherwise(F.lit("AT"))
         .alias("aircall__Country__c"),
        recording.alias("aircall__Call_Recording__c"),
        F.col("o_orderpriority").alias("CallDisposition"),
        F.when(inbound, F.lit("inbound")).otherwise(F.lit("outbound")).alias("aircall__Detailed_type__c"),
        F.lit("connected").alias("aircall__Connection_status__c"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("string"))
         .otherwise(F.lit("agent")).alias("aircall__Answered_by__c"),
        F.timestamp_add("HOUR", F.lit(1), F.col("o_orderdate")).alias("CompletedDateTime"),
        F.floor(F.col("o_totalprice")).cast("bigint").alias("CallDurationInSeconds"),
        F.when(inbound, F.lit("Inbound")).otherwise(F.lit("Outbound")).alias("CallType"),
        F.col("o_orderdate").alias("CreatedDate"),
    )


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(_s("o_custkey").alias("fk_account"),
                    (F.col("o_orderpriority") == "1-URGENT").alias("flg_is_from_pro_form"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    created = F.timestamp_add("DAY", ((F.col("c_custkey") * 7) % 365).cast("int"),
                              F.lit(ACCOUNT_EPOCH).cast("timestamp_ntz"))
    return c.select(_s("c_custkey").alias("pk_account"), F.col("c_name").alias("ds_account"),
                    created.alias("ts_created_at"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(_s("s_suppkey").alias("pk_user"), F.col("s_name").alias("ds_full_name"))


# ------------------------------------------------------------- keyed stores
def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select(_s("doc_id").alias("call_id"), F.col("text"), F.col("lang").alias("language"), F.col("n_chars"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of transcription attempts: three events in a row are the
    attempts of one call; purchases, signups and clicks succeed."""
    ev = read_table(spark, sf_dir, "events")
    ok = F.col("event_type").isin("purchase", "signup", "click")
    return ev.select(
        F.expr("event_id div 3").cast("string").alias("call_id"), F.col("ts").alias("attempted_at"),
        F.when(ok, F.concat(F.lit("text of "), _s("event_id"))).alias("text"),
        F.when(ok, F.when(F.col("user_id") % 2 == 0, F.lit("de")).otherwise(F.lit("en"))).alias("language"),
        F.when(~ok, F.concat(F.lit("service: "), F.col("event_type"))).alias("error"))


def repeated_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users with every third one there twice, under another name."""
    u = users(spark, sf_dir)
    return u.unionByName(u.where(F.col("pk_user").cast("long") % 3 == 0).withColumn("ds_full_name", F.concat(F.lit("~"), F.col("ds_full_name"))))


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of held files: audio <- labels, transcripts <- documents."""
    audio = read_table(spark, sf_dir, "labels").select(
        F.lit("audio").alias("kind"), F.concat(_s("doc_id"), F.lit(AUDIO_EXT)).alias("name"))
    text = read_table(spark, sf_dir, "documents").select(
        F.lit("transcript").alias("kind"), F.concat(_s("doc_id"), F.lit(TEXT_EXT)).alias("name"))
    both = audio.unionByName(text)
    ext = F.when(F.col("kind") == "audio", F.lit(AUDIO_EXT)).otherwise(F.lit(TEXT_EXT))
    return both.select("kind", "name", F.replace(F.col("name"), ext, F.lit("")).alias("call_id"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The previous runs' history: feed calls whose audio is already held,
    and calls whose transcription failed (no audio, language ``'null'``)."""
    from callweave.operators import ingest, worklist  # local: operators import sources

    recorded = ingest.call_timestamps(ingest.recorded_calls(ingest.flatten_calls(
        feed_pages(spark, sf_dir))))
    held = worklist.held_keys(artifacts(spark, sf_dir), "audio")
    done = recorded.join(held, recorded["id"].cast("string") == held["_held"], "left_semi")
    failed = worklist.download_worklist(recorded.where(F.col("id") % 7 == 0), artifacts(spark, sf_dir))
    return worklist.attach_language(ingest.history_rows(done), transcripts(spark, sf_dir)).unionByName(
        ingest.history_rows(failed).withColumn("language", F.lit("null")))


def responses(spark: SparkSession, sf_dir: str, run_date: _dt.date = RUN_DATE) -> DataFrame:
    """Stand-in model responses keyed by (account, part), padded with
    whitespace so that stripping matters; summaries also exist for the
    previous run date. Every account has part 0, even ones part 1 too."""
    d = read_table(spark, sf_dir, "documents")
    key = _s("doc_id")
    today = F.lit(run_date)
    yesterday = F.lit(run_date - _dt.timedelta(days=1))
    part = F.explode(F.when(F.col("doc_id") % 2 == 0, F.expr("array(0L, 1L)")).otherwise(F.expr("array(0L)"))).alias("part_no")
    translation = d.select(key.alias("account_id"), part, F.lit("translation").alias("kind"),
                           today.alias("run_date"),
                           F.concat(F.lit("\n\t "), F.col("text"), F.lit(" \n\n")).alias("text"))
    summary = d.select(key.alias("account_id"), part, F.lit("summary").alias("kind"),
                       today.alias("run_date"),
                       F.concat(F.lit("  "), F.col("lang"), F.lit(" summary, "),
                                _s("n_chars"), F.lit(" chars\t\n")).alias("text"))
    stale = d.select(key.alias("account_id"), part, F.lit("summary").alias("kind"),
                     yesterday.alias("run_date"), F.lit("\tstale summary\n").alias("text"))
    return translation.unionByName(summary).unionByName(stale)
