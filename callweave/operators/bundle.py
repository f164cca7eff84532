"""Per-account call numbering, headers and ordered transcript bundles.

*Part contract.* An account's bundle is one text, stored in parts that are
cut between calls: the calls are laid end to end in call order, each
``CALL_CHARS`` plus its transcript's characters long (at most
``part_chars``), and part ``p`` holds the calls that begin in
``[p * part_chars, (p + 1) * part_chars)``. Parts are numbered 0, 1, ...
without gaps, every row says how many there are (``n_parts``), and the parts
of an account in ``part_no`` order are its whole bundle. The default keeps
one bundle per account, one translation and one summary, up to 64 million
characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.constants import BLOCK_SEP
from callweave.functions.ids import extract_call_id
from callweave.functions.text import call_header
from callweave.operators.joins import match_key
from callweave.operators.numbering import number_within

PART_CHARS = 1 << 26
CALL_CHARS = 64

ON_MISSING = ("empty", "drop", "fail")

# Calls in creation order, missing dates last, ties broken by Id; the bucket
# is the day, and a stretch of ids where there is no date.
CALL_ORDER = ["CreatedDate ASC NULLS LAST", "Id ASC NULLS LAST"]
CALL_BUCKET = ("struct(CreatedDate IS NULL AS a, coalesce(to_date(CreatedDate), DATE'1970-01-01') AS b, "
               "CreatedDate IS NULL AND Id IS NULL AS c, IF(CreatedDate IS NULL, coalesce(substr(Id, 1, 6), ''), '') AS d)")
TURN_ORDER = ["turn ASC NULLS LAST", "role ASC NULLS LAST", "text ASC NULLS LAST"]
TURN_BUCKET = "struct(turn IS NULL AS a, coalesce(floor(turn / 1024), 0) AS b)"


def call_order() -> list[Column]:
    return [F.expr("CreatedDate").asc_nulls_last(), F.expr("Id").asc_nulls_last()]


def with_call_id(calls: DataFrame) -> DataFrame:
    """Add ``call_id`` extracted from the recording URL (FN-1)."""
    return calls.withColumn("call_id", extract_call_id("aircall__Call_Recording__c"))


def number_calls(calls: DataFrame, weight: str | None = None) -> DataFrame:
    """Add ``call_no`` = 1..n per account in call order (SRT-1, WN-1)."""
    return number_within(calls, "AccountId", CALL_ORDER, CALL_BUCKET, "call_no", weight)


def call_headers(numbered: DataFrame) -> DataFrame:
    """Add the per-call header line (FN-5)."""
    return numbered.withColumn("header", call_header(
        "call_no", "CreatedDate", "CallDurationInSeconds", "ds_full_name"))


def first_calls(calls: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` calls in (account, call order) -- a preview (LIM-1).
    Planned as a per-partition top-n then a merge, not a full sort."""
    return calls.orderBy(F.col("AccountId").asc_nulls_last(), *call_order()).limit(n)


def _chars(store: DataFrame) -> Column:
    return F.col("n_chars") if "n_chars" in store.columns else F.length("text")


def parted_calls(calls: DataFrame, transcripts: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Numbered calls with ``part_no`` and ``n_parts``. Only the transcripts'
    lengths are read here (their ``n_chars`` column where the store has one)."""
    size = transcripts.select(F.col("call_id").alias("_sid"), _chars(transcripts).alias("_chars"))
    sized = calls.join(size, match_key(calls["call_id"], calls["Id"]) == size["_sid"], "left").drop("_sid")
    numbered = number_calls(sized, f"least({CALL_CHARS} + coalesce(_chars, 0), {int(part_chars)})")
    return (numbered.withColumn("part_no", F.expr(f"call_no_before div {int(part_chars)}"))
            .withColumn("n_parts", F.expr(f"call_no_before_last div {int(part_chars)} + 1"))
            .drop("_chars", "call_no_before", "call_no_before_last"))


def account_parts(calls: DataFrame, transcripts: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """One row per (account, part) without the texts: what must be answered.

    An account's last part is the one its last call begins in, and parts
    have no gaps, so the characters of its calls and those of its last call
    tell how many parts there are: one aggregate, no numbering. The name is
    that of the account's first call.
    """
    size = transcripts.select(F.col("call_id").alias("_sid"), _chars(transcripts).alias("_chars"))
    sized = calls.join(size, match_key(calls["call_id"], calls["Id"]) == size["_sid"], "left")
    weight = F.least(F.lit(CALL_CHARS) + F.coalesce("_chars", F.lit(0)), F.lit(int(part_chars))).cast("long")
    at = F.struct(F.col("CreatedDate").isNull(), "CreatedDate", F.col("Id").isNull(), "Id")
    sums = sized.withColumn("_weight", weight).groupBy(F.col("AccountId").alias("account_id")).agg(
        (F.sum("_weight") - F.max_by("_weight", at)).alias("_before_last"), F.min_by("ds_account", at).alias("ds_account"))
    n_parts = F.expr(f"_before_last div {int(part_chars)} + 1")
    return sums.withColumn("n_parts", n_parts).select(
        "account_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1)).alias("part_no"), "n_parts", "ds_account")


def ordered_bundle(pieces: DataFrame, keys: list[str], seq: str, piece: str, *carried: Column) -> DataFrame:
    """Concatenate ``piece`` in ``seq`` order per ``keys`` (AG-5); a group is
    bounded by the part contract."""
    return pieces.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.expr(f"listagg(`{piece}`, '') WITHIN GROUP (ORDER BY `{seq}`)").alias("bundle"), *carried)


def account_bundle(calls: DataFrame, transcripts: DataFrame, on_missing: str = "empty",
                   part_chars: int = PART_CHARS) -> DataFrame:
    """``header + sep + transcript + sep`` per call, concatenated per account
    in call order (JN-7, AG-5) -> (account_id, part_no, n_parts, n_calls,
    bundle, ds_account).

    ``on_missing``: ``empty`` -- a call without transcript (or without call
    id) contributes an empty body; ``drop`` -- it is left out but keeps its
    number; ``fail`` -- the job fails on a call id without transcript.
    """
    if on_missing not in ON_MISSING:
        raise ValueError(f"on_missing must be one of {ON_MISSING}")
    headed = call_headers(parted_calls(calls, transcripts, part_chars))
    body = transcripts.select(F.col("call_id").alias("_cid"), F.col("text").alias("_body"))
    how = "inner" if on_missing == "drop" else "left"
    lean = headed.select(F.col("AccountId").alias("account_id"), "part_no", "n_parts", "call_no", "header", "ds_account",
                         "call_id", match_key("call_id", "Id").alias("_key"))
    joined = lean.join(body, lean["_key"] == body["_cid"], how)
    text = F.coalesce(F.col("_body"), F.lit(""))
    if on_missing == "fail":
        missing = F.col("call_id").isNotNull() & F.col("_body").isNull()
        text = F.when(missing, F.raise_error(F.concat(
            F.lit("missing transcript for call "), F.col("call_id")))).otherwise(text)
    pieces = joined.withColumn("_piece", F.concat(F.col("header"), F.lit(BLOCK_SEP), text, F.lit(BLOCK_SEP)))
    return ordered_bundle(pieces, ["account_id", "part_no", "n_parts"], "call_no", "_piece",
                          F.min_by("ds_account", "call_no").alias("ds_account"))


def account_name(calls: DataFrame) -> DataFrame:
    """Account name taken from the account's first call in call order (AG-6).
    ``min_by`` is a partial aggregate: one candidate per map task and key."""
    first_key = F.struct(F.col("CreatedDate").isNull(), F.col("CreatedDate"), F.col("Id").isNull(), F.col("Id"))
    return calls.groupBy("AccountId").agg(F.min_by("ds_account", first_key).alias("ds_account"))


def account_pairs(calls: DataFrame) -> DataFrame:
    """Distinct (AccountId, ds_account) pairs (PRJ-7, AG-2)."""
    return calls.select("AccountId", "ds_account").dropDuplicates()


def turn_bundle(turns: DataFrame, key: str = "conv_id", part_chars: int = PART_CHARS) -> DataFrame:
    """The same ordered bundle over a turn table (conv_id, turn, role, text):
    ``Turn #<n> - <role>`` headers, bodies in the order of turn, role, text."""
    numbered = number_within(turns.select(key, "turn", "role", "text"), key, TURN_ORDER, TURN_BUCKET, "turn_no",
                             f"least({CALL_CHARS} + coalesce(length(text), 0), {int(part_chars)})")
    piece = F.concat(F.lit("Turn #"), F.col("turn_no").cast("string"), F.lit(" - "),
                     F.coalesce(F.col("role"), F.lit("None")), F.lit(BLOCK_SEP),
                     F.coalesce(F.col("text"), F.lit("")), F.lit(BLOCK_SEP))
    pieces = numbered.select(key, "turn_no", F.expr(f"turn_no_before div {int(part_chars)}").alias("part_no"),
                             F.expr(f"turn_no_before_last div {int(part_chars)} + 1").alias("n_parts"), piece.alias("_piece"))
    return ordered_bundle(pieces, [key, "part_no", "n_parts"], "turn_no", "_piece").withColumnRenamed("n_calls", "n_turns")
