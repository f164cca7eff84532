"""Plain table and folder writes beside the versioned stores.

The tables of the end-to-end runs (SNK-1..7) are versioned stores, see
``callweave.stores``. Here:

* an append to a catalog table;
* a keyed text folder partitioned by ``kind`` and ``run_date`` with dynamic
  partition overwrite, for consumers that read such folders: a run replaces
  its own partitions and keeps earlier dates, but not in one commit;
* a bucketed catalog table, for joins that then move one side only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def append_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append rows; creates the table on first use."""
    df.write.format(fmt).mode("append").saveAsTable(table)


def write_keyed_texts(df: DataFrame, path: str, fmt: str = "parquet",
                      partition_by: Sequence[str] = ("kind", "run_date")) -> None:
    """Keyed text store with dynamic partition overwrite.

    ``df`` holds ``(key columns..., kind, run_date, text)``. Only the
    ``(kind, run_date)`` partitions present in ``df`` are replaced.
    """
    (df.write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).save(path))


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int,
                  fmt: str = "parquet") -> None:
    """Store a large keyed table (e.g. transcripts by ``call_id``) bucketed
    and sorted on its key, so later joins on that key shuffle only the
    other side."""
    (df.write.format(fmt).mode("overwrite")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
