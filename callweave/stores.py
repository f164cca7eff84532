"""Versioned stores: staged writes, one atomic commit, and a pointer that readers follow.

A store is a folder. A write stages parquet under ``version=<n>`` and is
seen only once the snapshot ``_snapshots/<n>.json`` exists, which is created
in one step and never overwritten: of two writers that start from the same
snapshot one commits and the other gets :class:`WriteConflict`. Readers
take the newest whole snapshot, so a writer that dies between stage and
commit leaves them on the one before. A snapshot names, per bucket, the
version that holds it (``base``), and the versions laid over it (``deltas``).

* :meth:`Store.replace` -- a derived table is written anew (SNK-1, SNK-3).
* :meth:`KeyedStore.merge` -- a run reads and rewrites only the buckets that
  its rows fall in (SNK-2); the other buckets keep their files, so what a
  run writes follows its own rows and not the history.
* :meth:`KeyedStore.append` -- a run writes its own rows as a delta and the
  last write of a key wins (SNK-4 to SNK-7); :meth:`KeyedStore.compact`
  folds the deltas into the buckets they touch.
* :meth:`Store.expire` -- older snapshots, the folders that no kept snapshot
  names and what dead writers left behind are deleted.

What reaches the driver is the list of the buckets a run touches and the
snapshot, a few numbers per bucket and delta. All data work is Spark's.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.session import ensure_checkpoint_dir, materialize

WHOLE = ""  # the one bucket of a table without buckets
BUCKET = "bucket"


class WriteConflict(RuntimeError):
    """Another writer has committed since this one read the store."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    schema: str                                         # JSON of the rows' schema
    base: dict[str, int] = field(default_factory=dict)  # bucket -> version that holds it
    deltas: tuple[int, ...] = ()                        # versions laid over it, oldest first

    def versions(self) -> set[int]:
        return {*self.base.values(), *self.deltas}


class Store:
    """A table in a folder, replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        root = self._hadoop(self.path)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ snapshots
    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, folder: str) -> list[str]:
        at = self._hadoop(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def _committed(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(f"{self.path}/_snapshots") if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """The newest whole snapshot, or the one of ``version``."""
        for v in reversed(self._committed()):
            if version is not None and v != version:
                continue
            text = self._read(f"{self.path}/_snapshots/{v:012d}.json")
            try:
                held = json.loads(text)
            except ValueError:
                continue  # its writer died while writing it
            return Snapshot(held["version"], held["schema"], held["base"], tuple(held["deltas"]))
        return None

    def _read(self, path: str) -> str:
        stream = self._fs.open(self._hadoop(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def exists(self) -> bool:
        return self.snapshot() is not None

    def folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def _next(self) -> int:
        staged = [int(n.split("=")[1]) for n in self._names(self.path) if n.startswith("version=")]
        return 1 + max([0, *staged, *self._committed()])

    def commit(self, new: Snapshot, after: Snapshot | None) -> Snapshot:
        """Make ``new`` the current snapshot, if ``after`` still is."""
        now = self.snapshot()
        if (now.version if now else None) != (after.version if after else None):
            raise WriteConflict(f"{self.path}: version {now.version if now else None} was committed meanwhile")
        text = json.dumps({"version": new.version, "schema": new.schema, "base": new.base, "deltas": list(new.deltas)})
        try:
            stream = self._fs.create(self._hadoop(f"{self.path}/_snapshots/{new.version:012d}.json"), False)
        except Exception as e:
            raise WriteConflict(f"{self.path}: version {new.version} is taken") from e
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return new

    # ----------------------------------------------------------------- rows
    def _scan(self, snapshot: Snapshot, paths: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(snapshot.schema))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _base(self, snapshot: Snapshot, buckets: Sequence[str] | None = None) -> DataFrame:
        held = {b: v for b, v in snapshot.base.items() if buckets is None or b in buckets}
        return self._scan(snapshot, [self.folder(v) if b == WHOLE else f"{self.folder(v)}/{BUCKET}={b}" for b, v in sorted(held.items())])

    def _stage(self, rows: DataFrame, version: int, by_bucket: bool = False) -> None:
        writer = rows.write.mode("errorifexists")
        (writer.partitionBy(BUCKET) if by_bucket else writer).parquet(self.folder(version))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the current snapshot, or of ``version``; the plan holds on to that snapshot."""
        at = self.snapshot(version)
        if at is None:
            raise FileNotFoundError(f"{self.path}: no snapshot" + (f" {version}" if version is not None else ""))
        return self._base(at)

    def replace(self, rows: DataFrame) -> Snapshot:
        before, n = self.snapshot(), self._next()
        self._stage(rows, n)
        return self.commit(Snapshot(n, rows.schema.json(), {WHOLE: n}), before)

    # --------------------------------------------------------------- expiry
    def expire(self, keep: int = 2) -> list[str]:
        """Keep the newest ``keep`` snapshots; the deleted paths."""
        committed = self._committed()
        kept = [s for s in (self.snapshot(v) for v in committed[-keep:]) if s]
        if not kept:
            return []
        gone = [f"{self.path}/_snapshots/{v:012d}.json" for v in committed[:-keep]]
        newest = kept[-1].version
        for name in self._names(self.path):
            if not name.startswith("version="):
                continue
            v = int(name.split("=")[1])
            if v > newest:
                continue  # a writer may be at work on it
            used = {b for s in kept for b, held in s.base.items() if held == v}
            if WHOLE in used or any(v in s.deltas for s in kept):
                continue
            if not used:
                gone.append(f"{self.path}/{name}")
                continue
            gone += [f"{self.path}/{name}/{b}" for b in self._names(f"{self.path}/{name}") if b.startswith(f"{BUCKET}=") and b.split("=")[1] not in used]
        for path in gone:
            self._fs.delete(self._hadoop(path), True)
        return gone


class KeyedStore(Store):
    """Rows told apart by ``key`` columns, in buckets.

    ``bucket``: a whole-number column expression over the key, NULL where a
    row has no key. Rows of one key are always in one bucket.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], bucket: Column):
        super().__init__(spark, path)
        self.key, self.bucket = list(key), F.coalesce(bucket.cast("long"), F.lit(-1).cast("long"))

    def merge(self, rows: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> Snapshot:
        """Replace the touched buckets' rows by ``combine(their rows, rows)``.

        ``combine`` sees every row of a key on both sides and must leave rows
        in their buckets. Deltas are folded in first.
        """
        before = self.snapshot()
        rows = materialize(rows, "store-rows")  # the touched buckets and the merge must see the same rows
        if before is None:
            before_rows, base = self.spark.createDataFrame([], rows.schema), {}
        else:
            if before.deltas:
                before = self.compact()
            base = before.base
        touched = {str(r[0]) for r in rows.select(self.bucket).distinct().collect()}  # one number per bucket
        if before is not None:
            if not touched:
                return before
            before_rows = self._base(before, touched)
        n = self._next()
        merged = combine(before_rows, rows)
        self._stage(self._spread(merged), n, by_bucket=True)
        return self.commit(Snapshot(n, merged.schema.json(), {**base, **dict.fromkeys(touched, n)}), before)

    def _spread(self, rows: DataFrame) -> DataFrame:
        """Rows of a bucket side by side, in as many tasks as the bucket is large."""
        return rows.withColumn(BUCKET, self.bucket).hint("rebalance", BUCKET)

    def append(self, rows: DataFrame) -> Snapshot:
        """Lay ``rows`` over the store; of rows with the same key the last write wins. One row per key at most."""
        before, n = self.snapshot(), self._next()
        self._stage(rows, n)
        return self.commit(Snapshot(n, rows.schema.json(), before.base if before else {}, (*(before.deltas if before else ()), n)), before)

    def _deltas(self, snapshot: Snapshot) -> DataFrame:
        """The last row of each key among the deltas."""
        rows = self._scan(snapshot, [self.folder(v) for v in snapshot.deltas])
        if len(snapshot.deltas) < 2:
            return rows
        columns = rows.columns
        version = F.regexp_extract(F.col("_metadata.file_path"), r"/version=(\d+)/", 1).cast("long")
        last = rows.withColumn("_version", version).groupBy(*self.key).agg(F.max_by(F.struct(*columns), "_version").alias("_row"))
        return last.select(*[F.col("_row")[c].alias(c) for c in columns])

    def read(self, version: int | None = None) -> DataFrame:
        at = self.snapshot(version)
        if at is None:
            return super().read(version)
        if not at.deltas:
            return self._base(at)
        return self._over(self._base(at), self._deltas(at)) if at.base else self._deltas(at)

    def _over(self, old: DataFrame, new: DataFrame) -> DataFrame:
        keys = new.select(*[F.col(k).alias(f"_{k}") for k in self.key])
        same = [old[k].eqNullSafe(keys[f"_{k}"]) for k in self.key]
        return old.join(keys, same, "left_anti").unionByName(new)

    def compact(self) -> Snapshot:
        """Fold the deltas into the buckets they touch; what is read stays the same."""
        before = self.snapshot()
        if before is None or not before.deltas:
            return before
        new = materialize(self._deltas(before), "store-deltas")
        touched = {str(r[0]) for r in new.select(self.bucket).distinct().collect()}
        n = self._next()
        old = self._base(before, touched)
        self._stage(self._spread(self._over(old, new) if before.base else new), n, by_bucket=True)
        return self.commit(Snapshot(n, before.schema, {**before.base, **dict.fromkeys(touched, n)}), before)


def table_path(spark: SparkSession, name: str) -> str:
    """Where the store of a named table lies: in the warehouse folder, which driver and executors share."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name.replace('.', '/')}.store"


def publish(store: Store, name: str) -> DataFrame:
    """Let ``name`` read the store's current snapshot in this session."""
    rows = store.read()
    rows.createOrReplaceTempView(name.split(".")[-1])
    return rows


def replace_table(rows: DataFrame, name: str) -> DataFrame:
    """Replace a named table at once (SNK-1, SNK-3); readers of the old snapshot go on undisturbed."""
    store = Store(rows.sparkSession, table_path(rows.sparkSession, name))
    store.replace(rows)
    return publish(store, name)


def expire_materialized(spark: SparkSession, older_than_seconds: float) -> list[str]:
    """Delete intermediate tables below the checkpoint folder that were last written before that age."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/callweave"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    limit = jvm.java.lang.System.currentTimeMillis() - int(older_than_seconds * 1000)
    old = [s.getPath() for s in fs.listStatus(at) if s.isDirectory() and s.getModificationTime() <= limit]
    for p in old:
        fs.delete(p, True)
    return [p.toString() for p in old]
