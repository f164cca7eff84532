"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.session import ensure_checkpoint_dir, materialize

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers that see this checkout import it; a cluster ships the package with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/callweave/{name}-{uuid.uuid4().hex}"


_held: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What this worker process keeps for one operator between tasks. Python workers outlive a
    stage, so what another operator kept is dropped first."""
    if owner not in _held:
        _held.clear()
        _held[owner] = {}
    return _held[owner]


def give_back() -> None:
    """Hand the memory that this worker process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no glibc
        pass


def lean(work: Callable) -> Callable:
    """``work`` for mapInArrow in a process that keeps nothing: what another operator cached is
    dropped before a task, and what the task freed goes back to the system, as idle workers
    stay beside the executor while later stages need its memory."""

    def run(batches):
        worker_cache("lean")
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def filesystem(path: str):
    """(file system, path there) of a URI or an absolute path, for use in tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


TEXT_ROWS = 1024


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs here sends Python tasks at most ``TEXT_ROWS`` rows at once: a batch of texts is held by
    the executor's JVM, beside its heap, and by the worker, several times over in each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(TEXT_ROWS, int(before)) if int(before) > 0 else TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def once_written(df: DataFrame, name: str) -> DataFrame:
    """:func:`materialize` for a plan that is run this once, in small batches: Spark removes its shuffle files when the table is written."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        with small_batches(df.sparkSession):
            return materialize(df, name)
    finally:
        conf.set(key, before)


SAMPLES = 16
MAX_SHARDS = 50_000


def _place(key_cuts: np.ndarray, tie_cuts: np.ndarray, n_null: int, is_null: np.ndarray, key: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """How many cuts lie before each (key, tie); the first ``n_null`` cuts have a null key."""
    out = n_null + np.searchsorted(key_cuts[n_null:], key, side="left")
    end = n_null + np.searchsorted(key_cuts[n_null:], key, side="right")
    for k in np.unique(key[(end > out) & ~is_null]):  # keys that are cut by their ties
        at = np.flatnonzero((key == k) & ~is_null)
        out[at] += np.searchsorted(tie_cuts[out[at[0]]:end[at[0]]], tie[at], side="left")
    out[is_null] = np.searchsorted(tie_cuts[:n_null], tie[is_null], side="left")
    return out


def range_shards(df: DataFrame, key: str, weight: Column, target: int, tie: Column | None = None) -> tuple[DataFrame, int]:
    """``df`` with ``shard`` (int), and the number of shards: ascending ranges of (integer ``key``, ``tie``) of about ``target`` weight.

    The cuts are weighted quantiles of a sample by a hash of key and tie,
    some ``SAMPLES`` per shard, so the same rows always get the same shards,
    whatever the spread of the keys; a key that many rows share is cut by
    its ties (a hash of the row). Null keys come first. There are at most
    ``MAX_SHARDS`` shards, beyond which they grow: that bounds the cuts that
    every task holds, 16 bytes each.
    """
    tie = F.lit(0).cast("long") if tie is None else tie.cast("long")
    rows = df.withColumn("_tie", tie)
    n, total = rows.agg(F.count(F.lit(1)), F.sum(weight.cast("long"))).first()
    shards = min(MAX_SHARDS, int(total or 0) // target + 1)
    if shards == 1:
        return rows.withColumn("shard", F.lit(0)).drop("_tie"), 1
    rate = max(1, n // (SAMPLES * shards))
    some = rows.where(F.pmod(F.xxhash64(F.col(key), "_tie"), F.lit(rate)) == 0)
    points = some.groupBy(F.col(key).cast("long").alias("k"), F.col("_tie").alias("t")).agg(F.sum(weight.cast("long")).alias("w")).orderBy(F.asc_nulls_first("k"), "t").collect()
    before = np.cumsum([p["w"] for p in points])
    step = before[-1] / shards if len(points) else 1
    last = np.flatnonzero(np.diff(before // step)) if len(points) else np.zeros(0, np.int64)
    cuts = [points[i] for i in last.tolist()]
    n_null = sum(c["k"] is None for c in cuts)
    key_cuts, tie_cuts = np.array([c["k"] or 0 for c in cuts], np.int64), np.array([c["t"] for c in cuts], np.int64)

    @F.pandas_udf("int")
    def shard(is_null: pd.Series, k: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series(_place(key_cuts, tie_cuts, n_null, is_null.to_numpy(bool), k.to_numpy(np.int64), t.to_numpy(np.int64)))

    own = F.col(key).cast("long")
    return rows.withColumn("shard", shard(own.isNull(), F.coalesce(own, F.lit(0)), F.col("_tie"))).drop("_tie"), len(cuts) + 1


def commit_file(fs, temp: str, final: str) -> None:
    """Give a complete file its name. A second attempt of the task wrote the same bytes, so where
    the name is taken the file stays, and readers never find it missing."""
    if fs.get_file_info(final).type.name == "NotFound":
        fs.move(temp, final)
    else:
        fs.delete_file(temp)
