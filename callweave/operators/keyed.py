"""One row per key, chosen alike on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, key: str, *prefer: Column) -> DataFrame:
    """One row per ``key``: the largest by ``prefer``, then by all columns.

    Rows without a key are no duplicates of one another unless they are equal
    in every column. A partial aggregate: a hot key costs one row per task.
    """
    rest = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(F.col(key).alias("_key"), F.when(F.col(key).isNull(), rest).alias("_row_without_key")).agg(
        F.max(F.struct(*[p.alias(f"_p{i}") for i, p in enumerate(prefer)], rest.alias("_row"))).alias("_best"))
    return best.select(*[F.col("_best._row")[c].alias(c) for c in df.columns])


def unique_key(df: DataFrame, key: str, on_duplicate: str = "fail") -> DataFrame:
    """``df`` with at most one row per ``key``, checked inside the plan (D8).

    A dimension that holds a key twice would multiply the rows joined to it.
    ``fail`` stops the job with the key's name, ``first`` keeps the smallest
    row, ``keep`` leaves the table as it is. Rows without a key match nothing
    in a join and are left out, except with ``keep``.
    """
    if on_duplicate == "keep":
        return df
    if on_duplicate not in ("fail", "first"):
        raise ValueError("on_duplicate must be one of fail, first, keep")
    row = F.struct(*[F.col(c) for c in df.columns])
    one = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(row).alias("_row"), F.count(F.lit(1)).alias("_n"))
    held = F.col("_row")
    if on_duplicate == "fail":
        name = F.concat(F.lit(f"more than one row with {key} "), F.col("_key").cast("string"))
        held = F.when(F.col("_n") > 1, F.raise_error(name).cast(df.schema)).otherwise(held)
    return one.select(held.alias("_row")).select(*[F.col("_row")[c].alias(c) for c in df.columns])
