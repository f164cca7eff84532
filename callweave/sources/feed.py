"""Call-feed pages landed as JSON files (one page per file or per line).

A landed page is ``{"calls": [...], "meta": {"next_page_link": ...}}``; a
lander that also writes ``page_link``, the link it fetched the page by, lets
:func:`page_report` see whether the pages form one whole chain of links up
to the null one. Pages that cannot be read go to a dead-letter table with
their text and file: they are counted and kept, never lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.schemas import LANDED_PAGE, PAGE
from callweave.session import materialize

_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def read_pages(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Scan landed pages with the declared page schema.

    A multi-file scan replaces the reference's page loop: every file is a
    page, read in parallel. ``multiline=True`` reads pretty-printed files
    holding one JSON document each; ``False`` reads JSON Lines, one page per
    line (splittable, better for very large landings). A page that cannot be
    read stops the job; :func:`read_landed` sets such pages aside instead.
    """
    return (spark.read.schema(PAGE)
            .option("multiLine", multiline)
            .option("mode", "FAILFAST")
            .json(path))


def parse_pages(landed: DataFrame, column: str = "value") -> DataFrame:
    """Pages held as JSON text in a column, with the declared page schema."""
    return landed.select(F.from_json(column, PAGE, {"mode": "FAILFAST"}).alias("p")).select("p.*")


# ------------------------------------------------- whole pages and dead letters
def _checked(rows: DataFrame) -> DataFrame:
    """Landed rows with ``is_bad``: no JSON of the page's shape, or a page without its calls."""
    return rows.withColumn("is_bad", F.col("_corrupt_record").isNotNull() | F.col("calls").isNull())


def read_landed(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Every landed file or line: ``LANDED_PAGE``, ``source`` (its file) and ``is_bad``.

    The rows are written once, because Spark answers a query over the corrupt
    text alone only from a result that was read whole.
    """
    rows = spark.read.schema(LANDED_PAGE).option("multiLine", multiline).options(**_PERMISSIVE).json(path)
    return materialize(_checked(rows.withColumn("source", F.col("_metadata.file_path"))), "landed-pages")


def parse_landed(landed: DataFrame, column: str = "value", link: str = "page_link") -> DataFrame:
    """The same of pages held as JSON text in a column beside the link they were fetched by."""
    read = F.from_json(column, LANDED_PAGE, _PERMISSIVE)
    rows = landed.select(F.col(link).alias("_link"), F.col(column).alias("_text"), read.alias("p"))
    return _checked(rows.select("p.calls", "p.meta", F.coalesce("_link", "p.page_link").alias("page_link"),
                                F.when(F.col("p._corrupt_record").isNotNull() | F.col("p.calls").isNull(), F.col("_text")).alias("_corrupt_record")))


def whole_pages(checked: DataFrame) -> DataFrame:
    """The readable pages, with the page schema."""
    return checked.where(~F.col("is_bad")).select("calls", "meta")


def dead_letters(checked: DataFrame) -> DataFrame:
    """The pages that could not be read: ``page_link, raw`` and, of files, ``source``."""
    also = [c for c in ("source",) if c in checked.columns]
    return checked.where("is_bad").select("page_link", F.col("_corrupt_record").alias("raw"), *also)


def missing_links(checked: DataFrame) -> DataFrame:
    """Links that a readable page names as the next one and that no readable page was fetched by."""
    good = checked.where(~F.col("is_bad"))
    held = good.select(F.col("page_link").alias("_held")).where("_held IS NOT NULL").distinct()
    named = good.select(F.col("meta.next_page_link").alias("page_link")).where("page_link IS NOT NULL").distinct()
    return named.join(held, named["page_link"] == held["_held"], "left_anti")


def page_report(checked: DataFrame) -> DataFrame:
    """One row on the chain of landed pages: ``n_pages, n_bad, n_calls,
    n_repeated`` (readable pages beyond the first of a link), ``n_missing``
    (named links without a readable page), ``n_starts`` (readable links that
    no page names), ``n_ends`` (pages whose next link is null), ``is_whole``.

    All of it is one aggregate per link and one over the links, so nothing
    but counts leaves the tasks. A chain that runs in a circle has neither
    start nor end; a circle beside a whole chain shows in :func:`chain_positions`.
    """
    own = checked.select(F.col("page_link").alias("link"), (~F.col("is_bad")).alias("good"), F.lit(False).alias("named"),
                         (~F.col("is_bad") & F.col("meta.next_page_link").isNull()).alias("ends"), F.size("calls").alias("calls"))
    named = checked.where(~F.col("is_bad") & F.col("meta.next_page_link").isNotNull()).select(
        F.col("meta.next_page_link").alias("link"), F.lit(False).alias("good"), F.lit(True).alias("named"), F.lit(False).alias("ends"), F.lit(None).cast("int").alias("calls"))
    links = own.unionByName(named).groupBy("link").agg(
        F.count_if(~F.col("named")).alias("landed"), F.count_if("good").alias("good"), F.count_if("named").alias("named"), F.count_if("ends").alias("ends"),
        F.sum(F.when(F.col("good"), F.col("calls"))).alias("calls"))
    known = F.col("link").isNotNull()
    counts = links.agg(
        F.coalesce(F.sum("landed"), F.lit(0)).alias("n_pages"),
        F.coalesce(F.sum(F.col("landed") - F.col("good")), F.lit(0)).alias("n_bad"),
        F.coalesce(F.sum("calls"), F.lit(0)).alias("n_calls"),
        F.coalesce(F.sum(F.when(known, F.greatest(F.col("good") - 1, F.lit(0)))), F.lit(0)).alias("n_repeated"),
        F.count_if(known & (F.col("named") > 0) & (F.col("good") == 0)).alias("n_missing"),
        F.count_if(known & (F.col("good") > 0) & (F.col("named") == 0)).alias("n_starts"),
        F.coalesce(F.sum("ends"), F.lit(0)).alias("n_ends"))
    whole = (F.col("n_bad") == 0) & (F.col("n_repeated") == 0) & (F.col("n_missing") == 0) & (F.col("n_starts") == 1) & (F.col("n_ends") == 1)
    return counts.withColumn("is_whole", whole)


def chain_positions(checked: DataFrame) -> DataFrame:
    """``page_link, to_end, reaches_end``: how many links each readable page is from the null one.

    Pointer doubling: in every round each page jumps as far as the page it
    has reached has jumped, so a chain of n pages takes log2(n) joins of two
    lean columns. A page that has not arrived then runs in a circle or ends
    at a missing page.
    """
    good = checked.where(~F.col("is_bad") & F.col("page_link").isNotNull())
    state = good.groupBy("page_link").agg(F.max("meta.next_page_link").alias("jump"))
    state = materialize(state.withColumn("to_end", F.when(F.col("jump").isNull(), 0).otherwise(1).cast("long")), "page-chain")
    rounds = max(1, state.count().bit_length())
    for _ in range(rounds):
        ahead = state.select(F.col("page_link").alias("_at"), F.col("jump").alias("_jump"), F.col("to_end").alias("_more"))
        moved = state.join(ahead, state["jump"] == ahead["_at"], "left")
        arrived = F.col("_at").isNotNull()
        state = materialize(moved.select("page_link", F.when(arrived, F.col("_jump")).otherwise(F.col("jump")).alias("jump"),
                                         (F.col("to_end") + F.when(arrived, F.col("_more")).otherwise(0)).alias("to_end")), "page-chain")
    return state.select("page_link", "to_end", F.col("jump").isNull().alias("reaches_end"))


# ----------------------------------------------------------------- streams
def read_pages_stream(spark: SparkSession, path: str, multiline: bool = True,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """The same scan as a file stream: each new landed page is read once.
    ``LANDED_PAGE`` with ``is_bad``, so a page that cannot be read is kept."""
    reader = spark.readStream.schema(LANDED_PAGE).option("multiLine", multiline).options(**_PERMISSIVE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _checked(reader.json(path).withColumn("source", F.col("_metadata.file_path")))
