"""Mixing sources to target weights, with DataFrame functions only.

Tokens are counted per source; the sources' targets share the budget by
weight, none above ``cap`` times its own tokens (water level over the
sources sorted by cap per weight). A document of a source with repetition
rate r = target / tokens is emitted floor(r) times, and once more if its
hash-seeded coin falls below the fraction of r. The coin is the first 32
bits of md5(doc_id) turned by one of ``SEEDS`` seeds; each source uses the
seed whose total comes nearest its target, so reruns agree and a source with
few or uneven documents still lands close.

Null text or no words: size 0. Null source: a source of its own, last. A
null ``doc_id`` has the coin of the empty string. Repeated rows are
documents of their own with equal coins. A source without words has target
0 and takes nothing. Other columns pass through :func:`mix`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
SEEDS = 32
SALTS = 16
_TURN = 2654435769
_FULL = 1 << 32


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")), F.lit(0)).cast("long")


def _coin(doc_id: Column) -> Column:
    key = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def _below(coin: Column, seed: Column, fraction: Column) -> Column:
    return F.pmod(coin + seed * F.lit(_TURN), F.lit(_FULL)).cast("double") < fraction * F.lit(float(_FULL))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP, share: float = 1.0) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source, source_size, target, rate."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))  # one row per source from here on
    rank = F.row_number().over(everything.orderBy(F.asc_nulls_last("source")))
    weighed = by_source.withColumn("_rank", rank).withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1))
    weighed = weighed.withColumn("_cap", F.col("source_size") * F.lit(float(cap))).withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    up = everything.orderBy(F.col("_cap") / F.col("_weight"), "_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = weighed.withColumn("_caps_before", F.sum("_cap").over(up) - F.col("_cap")).withColumn("_weight_left", F.sum("_weight").over(everything) - F.sum("_weight").over(up) + F.col("_weight"))
    capped = level.withColumn("_capped", F.col("_cap") * F.col("_weight_left") <= F.col("_weight") * (F.col("_budget") - F.col("_caps_before")))
    free = F.when(~F.col("_capped"), F.col("_weight"))
    rest = (F.col("_budget") - F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_cap"))).over(everything), F.lit(0.0))) / F.sum(free).over(everything)
    target = F.when(F.col("_capped"), F.col("_cap")).otherwise(F.col("_weight") * rest)
    out = capped.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(F.lit(0.0))
    return out.withColumn("rate", rate).select("source", "source_size", "target", "rate")


def _salted(rows: DataFrame, sources: DataFrame, source: str, salt: Column) -> DataFrame:
    """Join each row with its source; a hot source is dealt over ``SALTS`` keys."""
    copies = sources.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("source", "_source")
    dealt = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    return dealt.join(copies, (dealt["_salt"] == copies["_salt"]) & F.col(source).eqNullSafe(F.col("_source"))).drop("_salt", "_source")


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP, share: float = 1.0, seeds: int = SEEDS) -> tuple[DataFrame, DataFrame]:
    """(documents as doc_id, source, size, coin; sources as source, source_size, target, rate, seed), both written out."""
    sized = materialize(docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), _coin(F.col("doc_id")).alias("coin")), "mix-sizes")
    sources = source_targets(sized.select("source", "size"), weights, cap, share)
    fraction = F.col("rate") - F.floor("rate")
    tried = _salted(sized, sources, "source", F.col("coin")).groupBy("source", "source_size", "target", "rate").agg(
        *[F.sum(F.when(_below(F.col("coin"), F.lit(s), fraction), F.col("size")).otherwise(0)).alias(f"_extra{s}") for s in range(seeds)])
    base = F.col("source_size") * F.floor("rate")
    misses = F.array(*[F.struct(F.abs(base + F.col(f"_extra{s}") - F.col("target")).alias("miss"), F.lit(s).cast("long").alias("seed")) for s in range(seeds)])
    seeded = tried.select("source", "source_size", "target", "rate", F.array_min(misses)["seed"].alias("seed"))
    return sized, materialize(seeded, "mix-sources")


def copies(rate: Column, coin: Column, seed: Column) -> Column:
    """How often a document is emitted."""
    return (F.floor(rate) + _below(coin, seed, rate - F.floor(rate)).cast("long")).cast("long")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, source, copies."""
    sized, sources = plan(docs, **options)
    joined = _salted(sized, sources, "source", F.col("coin"))
    return joined.withColumn("copies", copies(F.col("rate"), F.col("coin"), F.col("seed"))).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row repeated as the mix takes it, columns unchanged."""
    _, sources = plan(docs, **options)
    names = {c: f"_mix_{c}" for c in ("source_size", "target", "rate", "seed")}
    sources = sources.withColumnsRenamed(names)
    coin = _coin(F.col("doc_id"))
    joined = _salted(docs, sources, "source", coin)
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.greatest(copies(F.col("_mix_rate"), coin, F.col("_mix_seed")), F.lit(1).cast("long"))))).where(
        copies(F.col("_mix_rate"), coin, F.col("_mix_seed")) > 0).select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS coin
  FROM documents),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank, 3.0::DOUBLE * source_size AS cap,
         CAST(sum(source_size) OVER () AS DOUBLE) AS budget
  FROM by_source),
level AS (
  SELECT *, sum(cap) OVER up - cap AS caps_before, sum(weight) OVER () - sum(weight) OVER up + weight AS weight_left
  FROM weighed WINDOW up AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
capped AS (SELECT *, cap * weight_left <= weight * (budget - caps_before) AS is_capped FROM level),
targets AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN cap ELSE weight * (budget - coalesce(sum(CASE WHEN is_capped THEN cap END) OVER (), 0.0)) / sum(CASE WHEN NOT is_capped THEN weight END) OVER () END AS target
  FROM capped),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0.0 END AS rate FROM targets),
tries AS (
  SELECT r.source, s.seed, abs(r.source_size * floor(r.rate) + sum(CASE WHEN (d.coin + s.seed * 2654435769) % 4294967296 < (r.rate - floor(r.rate)) * 4294967296.0::DOUBLE THEN d.size ELSE 0 END) - r.target) AS miss
  FROM rates r JOIN sized d ON r.source IS NOT DISTINCT FROM d.source, (SELECT unnest(range(32)) AS seed) s
  GROUP BY r.source, s.seed, r.source_size, r.rate, r.target),
seeds AS (SELECT source, arg_min(seed, (miss, seed)) AS seed FROM tries GROUP BY source)
SELECT d.doc_id, d.size, r.source_size, r.target,
       CAST(d.size * c.copies AS BIGINT) AS taken, d.source, c.copies
FROM sized d JOIN rates r ON r.source IS NOT DISTINCT FROM d.source JOIN seeds s ON s.source IS NOT DISTINCT FROM d.source,
LATERAL (SELECT CAST(floor(r.rate) AS BIGINT) + CASE WHEN (d.coin + s.seed * 2654435769) % 4294967296 < (r.rate - floor(r.rate)) * 4294967296.0::DOUBLE THEN 1 ELSE 0 END AS copies) c
"""
