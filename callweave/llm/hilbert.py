"""Approximate nearest neighbours by shifted Hilbert curves.

Distinct vectors (nodes, named by their smallest id) are normalised and
projected ``CURVES`` times on ``DIMS`` random orthonormal directions, shifted
at random inside the unit cube and numbered along a Hilbert curve; Spark
range-partitions and sorts every curve, which gives each node a rank on it.
A query meets the nodes whose rank on a curve lies within ``window`` of its
own; the curve is cut into chunks of ``CHUNK`` ranks, so no task holds more,
and the windows of all curves merge into one exact rerank.

``window`` is fitted: for ``SAMPLE`` queries (a documented bound of the fit
alone) the true neighbours are found against all nodes, and the window is
the smallest that reaches ``RECALL`` of them on some curve. Every vector is
indexed. Clustered vectors need narrow windows; for vectors without any
structure the window grows with their number.

Cosine is computed in double precision on the vectors as given. A vector
that is null, zero, holds a null or a non-finite component, has another
length than the longest one, or has no id takes no part. Equal vectors are
one node of which the ``k + 1`` smallest ids are kept, which is all that a
list of k nearest can need; repeated rows count once. Tables with few nodes
are searched exactly. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.session import materialize

from .common import workers_import

CURVES = 8
DIMS = 8
BITS = 7
CHUNK = 4096
SAMPLE = 256
RECALL = 0.97
LEAST_WINDOW = 64


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of integer points (n x dims, each below 2 ** bits).

    From the highest bit down, the cube's quadrant is read off and the
    remaining bits are reflected and swapped into the quadrant's own frame;
    the interleaved Gray code of the result is the place.
    """
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(len(x)):
            upper = (x[i] >> level & 1).astype(bool)
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ (swap if i else 0)
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where(x[-1] >> level & 1, flip ^ ((1 << level) - 1), flip)
    key = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | ((v ^ flip) >> level & 1)
    return key


def directions(length: int, curves: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Projections (curves x length x dims) and shifts (curves x dims), from a fixed seed."""
    rng = np.random.default_rng(20240101)
    spans = [np.linalg.qr(rng.normal(size=(length, max(1, min(dims, length)))))[0] for _ in range(curves)]
    return np.stack(spans), rng.random((curves, spans[0].shape[1]))


def _vectors(length: int):
    def clean(batches):
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for i, v in zip(ids, batch.column(1), strict=True):
                if i is None or not v.is_valid or len(v.values) != length or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all() and x.any() and np.isfinite(x @ x) and x @ x > 0:
                    out.append((i, (x + 0.0).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["vec_id", "v"])

    return clean


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    data = np.frombuffer(b"".join(x.as_py() for x in column), np.float64) if len(column) else np.zeros(0)
    return data.reshape(-1, length)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt((m * m).sum(1))[:, None]


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines of all rows of ``q`` with all rows of ``v``, summed component by component so that a pair's value never depends on its batch."""
    dot = np.zeros((len(q), len(v)))
    qq, vv = np.zeros(len(q)), np.zeros(len(v))
    for k in range(q.shape[1] if len(q) else 0):
        dot += np.multiply.outer(q[:, k], v[:, k])
        qq += q[:, k] * q[:, k]
        vv += v[:, k] * v[:, k]
    return dot / np.multiply.outer(np.sqrt(qq), np.sqrt(vv))


def _best(q_ids: np.ndarray, q: np.ndarray, v_ids: np.ndarray, v: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of ``v`` for each row of ``q``, ties to the smaller id."""
    out = []
    for at in range(0, len(q), 256):
        s = cosines(q[at:at + 256], v)
        m = min(k, s.shape[1])
        for row in range(len(s)):
            edge = np.partition(s[row], len(v) - m)[len(v) - m] if m else 0
            near = np.flatnonzero(s[row] >= edge)
            near = near[np.lexsort((v_ids[near], -s[row][near]))][:m]
            out.append(pd.DataFrame({"query": q_ids[at + row], "node": v_ids[near], "score": s[row][near]}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"query": pd.Series(dtype="int64"), "node": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})


def top(rows: DataFrame, by: str, k: int, tie: str = "node") -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), tie)
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


class Index:
    """Nodes of ``vectors`` (vec_id, embedding) with their ranks on every curve, as written tables."""

    def __init__(self, vectors: DataFrame, k: int = 5, curves: int = CURVES, dims: int = DIMS):
        spark = vectors.sparkSession
        workers_import(spark)
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"))
        self.spark, self.k, self.curves = spark, k, curves
        self.length = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
        self.length = max(0, self.length)
        self.rows = materialize(rows.mapInArrow(_vectors(self.length), "vec_id long, v binary"), "vectors")
        same = Window.partitionBy("v").orderBy("vec_id")
        kept = self.rows.distinct().withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
        kept = materialize(kept.withColumn("node", F.min("vec_id").over(Window.partitionBy("v"))), "members")
        self.members = kept.select("node", "vec_id")
        self.nodes = kept.where("n = 1").select("node", "v")
        self.n = self.nodes.count()
        self.ranks = self._rank(*directions(self.length, curves, dims)) if self.n else None

    def _rank(self, spans: np.ndarray, shifts: np.ndarray) -> DataFrame:
        length, curves, dims = self.length, len(spans), spans.shape[2]

        def sums(batches):
            for batch in batches:
                y = np.einsum("nl,cld->ncd", _unit(_matrix(batch.column(0), length)), spans)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(curves * dims)), pa.array(np.full(curves * dims, len(y))), pa.array(y.sum(0).ravel()), pa.array((y * y).sum(0).ravel())], names=["at", "n", "s", "ss"])

        moments = self.nodes.select("v").mapInArrow(sums, "at long, n long, s double, ss double").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).orderBy("at").toPandas()
        mean = (moments["s"] / moments["n"]).to_numpy().reshape(curves, dims)
        spread = np.sqrt(np.maximum(moments["ss"] / moments["n"] - (moments["s"] / moments["n"]) ** 2, 1e-18)).to_numpy().reshape(curves, dims)

        def keys(batches):
            for batch in batches:
                y = np.einsum("nl,cld->ncd", _unit(_matrix(batch.column(1), length)), spans)
                z = np.clip(((y - mean) / (7 * spread) + 0.5), 0, 1 - 1e-9) / 2 + shifts / 2
                cells = np.minimum((z * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
                for c in range(curves):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), c, np.int32)), pa.array(hilbert_key(cells[:, c])), batch.column(0)], names=["curve", "key", "node"])

        parts = max(1, self.n * curves // 200_000 + 1)
        dealt = self.nodes.select("node", "v").mapInArrow(keys, "curve int, key long, node long").repartitionByRange(parts, "curve", "key", "node").sortWithinPartitions("curve", "key", "node")
        placed = materialize(dealt.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "curves")
        runs = placed.groupBy("curve", "part").agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_n"))  # one row per partition and curve
        before = F.sum("_n").over(Window.partitionBy("curve").orderBy("part")) - F.col("_n")
        runs = runs.select("curve", "part", "_first", before.alias("_before"))
        return materialize(placed.join(F.broadcast(runs), ["curve", "part"]).select("curve", "node", (F.col("at") - F.col("_first") + F.col("_before")).alias("rank")), "ranks")

    def exact(self, queries: DataFrame, k: int) -> DataFrame:
        """The k best nodes for the few ``queries`` (node, v), against all nodes."""
        held, length = queries.toPandas(), self.length
        ids = held["node"].to_numpy(np.int64)
        q = np.frombuffer(b"".join(bytes(x) for x in held["v"]), np.float64).reshape(-1, length)

        def score(batches):
            for batch in batches:
                found = _best(ids, q, batch.column(0).to_numpy(), _matrix(batch.column(1), length), k)
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)

        return top(self.nodes.select("node", "v").mapInArrow(score, "query long, node long, score double"), "query", k)

    def window(self, queries: DataFrame, sample: int = SAMPLE, recall: float = RECALL) -> int:
        """The rank distance within which ``recall`` of the true neighbours of a sample lie on some curve."""
        some = queries.select("node", "v").orderBy(F.xxhash64("node"), "node").limit(sample)
        true = self.exact(some, self.k + 1).where("query <> node")
        a = self.ranks.select("curve", F.col("node").alias("query"), F.col("rank").alias("_q"))
        near = true.join(a, "query").join(self.ranks, ["curve", "node"]).groupBy("query", "node").agg(F.min(F.abs(F.col("rank") - F.col("_q"))).alias("d"))
        found = near.agg(F.percentile("d", recall)).first()[0]  # at most sample x k rows
        return max(LEAST_WINDOW, int(np.ceil(found)) if found is not None else 0)

    def search(self, queries: DataFrame, window: int) -> DataFrame:
        """(query, node, score) of the k + 1 best nodes found for each of ``queries`` (node, v), itself included."""
        length, k = self.length, self.k + 1
        placed = self.ranks.withColumn("chunk", F.floor(F.col("rank") / CHUNK)).join(self.nodes, "node").select(F.col("curve").alias("on"), F.col("chunk").alias("slot"), F.col("node").alias("node"), F.col("v").alias("v"))
        chunks = F.sequence(F.floor(F.greatest(F.col("rank") - window, F.lit(0)) / CHUNK), F.floor(F.least(F.col("rank") + window, F.lit(self.n - 1)) / CHUNK))
        asked = queries.select("node", "v").join(self.ranks, "node").select("curve", F.explode(chunks).alias("chunk"), "node", "v")

        def meet(_, q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
            if not len(q) or not len(v):
                return _best(np.zeros(0, np.int64), np.zeros((0, length)), np.zeros(0, np.int64), np.zeros((0, length)), k)
            as_matrix = lambda x: np.frombuffer(b"".join(bytes(b) for b in x["v"]), np.float64).reshape(-1, length)
            return _best(q["node"].to_numpy(np.int64), as_matrix(q), v["node"].to_numpy(np.int64), as_matrix(v), k)

        found = asked.groupBy("curve", "chunk").cogroup(placed.groupBy("on", "slot")).applyInPandas(meet, "query long, node long, score double")
        return top(found.distinct(), "query", k)


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, window: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found, for queries whose id is divisible by ``every``."""
    schema = "query_id long, rank int, vec_id long, score double"
    index = Index(vectors, k)
    if not index.n:
        return index.spark.createDataFrame([], schema)
    asked = index.rows.where(F.col("vec_id") % every == 0).distinct().withColumnRenamed("vec_id", "query_id")
    named = materialize(asked.join(index.nodes, "v").select("query_id", "node", "v"), "queries")
    points = named.select("node", "v").distinct()
    found = materialize(index.search(points, window or index.window(points)), "found")
    pairs = named.select("query_id", F.col("node").alias("query")).join(found, "query").join(index.members, "node").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
