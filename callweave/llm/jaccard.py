"""N-gram Jaccard join in the metric space of shingle sets.

A document's set holds 64-bit hashes of its distinct five-word shingles
(fewer words: the whole sequence as one). Two documents link when their
Jaccard distance is at most ``1 - T``. Equal sets are one point; a point is
named by a 64-bit hash of its set together with the set's size.

1. *Cells.* The first pivots are all single shingles: a point x lies at
   distance 1 - 1/|x| from each shingle it holds and at 1 from all others,
   so its Voronoi cell is decided among its own shingles by a global order.
   Two linked points miss at most a quarter of each other's shingles, so the
   first shingle they share is among the first floor(|x| / 4) + 1 of either,
   and among the first floor(|x| / 7) + 1 of the smaller: a point is copied
   to the cells of that window and no further. Frequent shingles come last
   in the order. Which shingles count as frequent is a statistic of all
   documents (:func:`frequent`); any order gives the same links, and the
   list, at most ``FREQUENT`` hashes, is the only thing sent to every task.
   Shingles that the same points hold have equal cells, which are one region:
   near copies share many of them.
2. *Regions.* In a cell the smallest points become pivots in rounds of 1, 2,
   4, ... First of all each point is held against the smallest first pivot of
   its cells, which joins large groups at one comparison a point. Every other point of the cell that may link to a pivot is held
   against it exactly. Points already known to be connected are not held
   against each other again, so thousands of near copies cost one comparison
   each; points whose distances to the cell's first pivot differ by more
   than the link distance are ruled out by the triangle inequality. A cell is
   joined again until its points are one component or all have been pivots.
   Every point carries ``BITS`` bits, the parities of its set's hashes: two
   sets differ in at least as many shingles as their bits do, so pairs whose
   bits differ too much to link are never formed.
3. *Components* of the links by large-star/small-star rounds.

Every round works on written tables, so a lost executor repeats one step.
Nulls: a null or wordless text has an empty set, links with nothing and is
its own component; a null ``doc_id`` takes part, and counts as smallest only
if its component has no other id. Repeated rows give one row each. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lean, small_batches
from .common import once_written as materialize
from .common import workers_import
from .words import mix, texts

SHINGLE = 5
#: A set's window: n - ceil(3 n / 4) + 1 shingles, and n - ceil(6 n / 7) + 1 for the smaller of two.
T = 0.75
FREQUENT = 1 << 18
FREQUENT_FROM = 8
WINDOW_SHINGLES = 4 << 20
FILTER_BITS = 1 << 26
BITS = 512
FEW_ENDS = 1 << 17  # names of sets that are sent to every task, at most: some 10 MB
SLICE = 1 << 18  # bytes of texts that a task splits into words at once, about
ROWS = 1 << 16  # rows of a batch that a task sends on, about
_STEP = [pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(SHINGLE)]


def _combine(parts: list[np.ndarray]) -> np.ndarray:
    total = np.full(len(parts[0]), len(parts), dtype=np.uint64)
    for k, p in enumerate(parts):
        total = total + p * np.uint64(_STEP[k])
    return mix(total)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending distinct shingle hashes) of each text."""
    for row, count, h in texts(column, lower=True, size=SLICE):
        ends = np.cumsum(count)
        full = _combine([h[k:len(h) - SHINGLE + 1 + k] for k in range(SHINGLE)]) if len(h) >= SHINGLE else h[:0]
        for k, (n, end) in enumerate(zip(count.tolist(), ends.tolist(), strict=True)):
            if n >= SHINGLE:
                s = np.sort(full[end - n:end - SHINGLE + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield row + k, s[keep]
            elif n:
                yield row + k, _combine([h[end - n + j:end - n + j + 1] for j in range(n)])
            else:
                yield row + k, h[:0]


def point(s: np.ndarray) -> int:
    """64-bit name of a set, from the sum of its hashes mixed twice and their exclusive or."""
    if not len(s):
        return 0
    total = mix(s ^ np.uint64(_STEP[1])).sum(dtype=np.uint64)
    both = mix(np.array([np.bitwise_xor.reduce(s), total]))
    return int(both[0]) ^ (int(both[1]) * _STEP[0] & (1 << 64) - 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _points(batches):
    for batch in batches:
        docs, out = batch.column(0), []
        for _, s in shingle_sets(batch.column(1)):
            out.append((len(s), _signed(point(s)) if len(s) else None))
        yield pa.RecordBatch.from_arrays([docs, pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), batch.column(2)], names=["doc_id", "n", "point", "key"])


def _repeated(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values met more than once, ascending, and how often; ``values`` is sorted in place."""
    values.sort()
    same = np.zeros(len(values) + 1, bool)  # value i equals the one before it
    np.equal(values[1:], values[:-1], out=same[1:-1])
    first, last = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(same[:-1] & ~same[1:])
    return values[first], last - first + 1


def _frequent(batches):
    held, size, seen = [], 0, set()

    def flush():
        nonlocal held, size, seen
        values = np.empty(size, np.uint64)
        at = 0
        while held:
            s = held.pop()
            values[at:at + len(s)] = s
            at += len(s)
        size, seen = 0, set()
        values, n = _repeated(values)
        for at in range(0, len(values), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(values[at:at + ROWS].view(np.int64)), pa.array(n[at:at + ROWS])], names=["h", "n"])

    for batch in batches:
        for _, s in shingle_sets(batch.column(0)):
            name = point(s)
            if len(s) and name not in seen:
                seen.add(name)
                held.append(s)
                size += len(s)
                if size >= WINDOW_SHINGLES:
                    yield from flush()
    if held:
        yield from flush()


def frequent(docs: DataFrame, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that occur again and again, and how often they were seen, by hash.

    Each task counts the shingles of all its documents, window after window,
    and reports those met twice in one; the sums order the cells.
    """
    counts = docs.select(F.col("text").cast("string")).mapInArrow(lean(_frequent), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    with small_batches(docs.sparkSession):
        rows = counts.where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "h").limit(limit).toPandas()
    h = rows["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], rows["n"].to_numpy(np.int64)[order]


def _cells(hot: np.ndarray, hot_n: np.ndarray):
    def cells(batches):
        seen = set()
        for batch in batches:
            hs, names, sizes, held = [], [], [], 0
            for _, s in shingle_sets(batch.column(0)):
                n = len(s)
                name = point(s) if n else 0
                if not n or (name, n) in seen:
                    continue
                seen.add((name, n))
                window, least = n - -(-3 * n // 4) + 1, n - -(-6 * n // 7) + 1
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    is_hot = hot[at] == s
                    rare = s[~is_hot]
                    if len(rare) < window:
                        often = s[is_hot]
                        often = often[np.argsort(hot_n[at[is_hot]], kind="stable")]
                        rare = np.concatenate([rare, often])
                else:
                    rare = s
                rare = rare[:window]
                hs.append(rare)
                names.append(np.full(window, _signed(name), np.int64))
                sizes.append(2 * n + (np.arange(window) < least))
                held += window
                if held >= ROWS:
                    yield _cell_rows(hs, names, sizes)
                    hs, names, sizes, held = [], [], [], 0
            if hs:
                yield _cell_rows(hs, names, sizes)

    return cells


def _cell_rows(hs: list[np.ndarray], names: list[np.ndarray], sizes: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(names)), pa.array(np.concatenate(sizes).astype(np.int64))], names=["h", "point", "size"])


def _slots(ids: np.ndarray) -> np.ndarray:
    """The places of ids in the filter, one row each."""
    return np.stack([mix(ids ^ np.uint64(_STEP[k])) & np.uint64(FILTER_BITS - 1) for k in range(3)], axis=1)


def _marks(batches):
    for batch in batches:
        slots = _slots(batch.column(0).to_numpy().view(np.uint64)).ravel().view(np.int64)
        words, at = np.unique(slots >> 6, return_inverse=True)
        bits = np.zeros(len(words), np.int64)
        np.bitwise_or.at(bits, at, np.int64(1) << (slots & 63))
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits)], names=["word", "bits"])


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of ``FILTER_BITS`` bits, whatever the number of ids: it can only let too much pass."""
    rows = ids.mapInArrow(lean(_marks), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out


def in_filter(marks: np.ndarray, name: str) -> Column:
    """Whether the filter takes a row's long column ``name``; nothing else of the row is sent to Python."""

    @F.pandas_udf("boolean")
    def inside(ids: pd.Series) -> pd.Series:
        slots = _slots(ids.to_numpy(np.int64).view(np.uint64)).view(np.int64)
        return pd.Series((marks[slots >> 6] >> (slots & 63) & 1).all(1))

    return inside(F.col(name))


BIT_COLUMNS = [f"bits{k}" for k in range(BITS // 64)]


def parities(s: np.ndarray) -> np.ndarray:
    """``BITS`` bits of a set, as signed longs: bit i says whether an odd number of its hashes fall on i.

    A shingle that only one of two sets holds flips one bit, so two sets
    differ in at least as many shingles as their bits differ.
    """
    odd = np.bincount((s & np.uint64(BITS - 1)).view(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _may_link(na: str, nb: str, a: str, b: str) -> Column:
    """Sets of these sizes link if they differ in at most a seventh of na + nb shingles."""
    differ = sum((F.bit_count(F.col(a + c).bitwiseXOR(F.col(b + c))) for c in BIT_COLUMNS), F.lit(0))
    return 7 * differ <= F.col(na) + F.col(nb)


def _sets(marks: np.ndarray):
    def sets(batches):
        seen = set()
        for batch in batches:
            slots = _slots(batch.column(0).to_numpy().view(np.uint64)).view(np.int64)
            wanted = (marks[slots >> 6] >> (slots & 63) & 1).all(1)
            if not wanted.any():
                continue
            names, found = [], []
            for _, s in shingle_sets(batch.column(1).filter(pa.array(wanted))):
                name = point(s)
                if len(s) and (name, len(s)) not in seen:
                    seen.add((name, len(s)))
                    names.append(_signed(name))
                    found.append(s.view(np.int64))
                if len(found) >= 256:
                    yield _set_rows(names, found)
                    names, found = [], []
            if found:
                yield _set_rows(names, found)

    return sets


def _set_rows(names: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
    sizes = [len(s) for s in found]
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(np.concatenate(found)))
    bits = np.stack([parities(s.view(np.uint64)) for s in found])
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), lists, *[pa.array(bits[:, k]) for k in range(len(BIT_COLUMNS))]], names=["point", "n", "s", *BIT_COLUMNS])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the graph with edges (u, v): root is the smallest node that is reached."""

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "small-star")
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def merged_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after more links (a, b): only the components that these join are looked at."""
    of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
    of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
    between = links.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("_ra", "a").alias("u"), F.coalesce("_rb", "b").alias("v"))
    joined = components(between)
    moved = joined.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    old = roots.join(moved, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
    return materialize(old.unionByName(joined), "roots")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with the overlap of their sets; only the sets of these pairs move."""
    pairs = materialize(pairs, "pairs")
    ends = materialize(pairs.select(F.col("a").alias("point"), F.col("na").alias("n")).unionByName(pairs.select(F.col("b").alias("point"), F.col("nb").alias("n"))).distinct(), "ends")
    some = sets.join(F.broadcast(ends) if ends.count() <= FEW_ENDS else ends, ["point", "n"], "left_semi")
    one = some.select(F.col("point").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    two = some.select(F.col("point").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    rows = pairs.join(one, ["a", "na"]).join(two, ["b", "nb"]).select("a", "na", "b", "nb", "sa", "sb")
    return rows.select("a", "na", "b", "nb", F.size(F.array_intersect("sa", "sb")).cast("long").alias("both"))


def row_key(docs: DataFrame) -> Column:
    """64 bits of hash of a row's id and text."""
    doc_id = F.col("doc_id").cast("long")
    return F.xxhash64(doc_id.isNull(), doc_id, F.col("text").isNull(), F.col("text").cast("string"))


def similar(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents as doc_id, n, point, key, node), (links a, b between nodes), (node, root of its component).

    A node is a point's name and size in one long key, ``node = xxhash64(point, n)``.
    """
    workers_import(docs.sparkSession)
    texts_only = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    points = materialize(texts_only.withColumn("key", row_key(texts_only)).mapInArrow(lean(_points), "doc_id long, n long, point long, key long"), "points")
    hot, hot_n = frequent(texts_only)
    rows = texts_only.select("text").mapInArrow(lean(_cells(hot, hot_n)), "h long, point long, size long")
    # in a cell by size: a small point may link to the next larger one, any point to the largest small one before it
    by_size = Window.partitionBy("h").orderBy(F.floor(F.col("size") / 2), "point")
    n, small = F.floor(F.col("size") / 2), F.col("size") % 2 == 1
    after = F.lead(n).over(by_size)
    before = F.max(F.when(small, n)).over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    shared = rows.withColumn("_after", after).withColumn("_before", before).where((small & (3 * F.col("_after") <= 4 * n)) | (4 * F.col("_before") >= 3 * n))
    members = shared.select("h", "point", n.cast("long").alias("n"), small.alias("small")).distinct()
    cell = Window.partitionBy("h")
    members = members.withColumn("_lo", F.min("point").over(cell)).withColumn("_hi", F.max("point").over(cell))
    # cells of the same points are one region, named by two sums of their points; a point is small in it if it is in any
    members = members.withColumn("_x", F.bit_xor(F.xxhash64("point", "n")).over(cell)).withColumn("_y", F.bit_xor(F.xxhash64("n", "point")).over(cell))
    members = members.where("_lo <> _hi").groupBy(F.xxhash64("_x", "_y").alias("h"), "point", "n").agg(F.max("small").alias("small"))
    # the first pivot of a cell never changes, so ranks are fixed
    first = Window.partitionBy("h").orderBy(F.desc("small"), "n", "point")
    node = F.xxhash64("point", "n")
    ranked = materialize(members.withColumn("node", node).withColumn("rank", F.row_number().over(first)).withColumn("p0", F.first("node").over(first)), "cells")
    # of equal sets one document's is fetched, by the smallest id; ids that are null share a mark
    some = ranked.select("point", "n").distinct()
    no_id = F.lit(-(1 << 63)).cast("long")
    owners = materialize(points.where("n > 0").join(some, ["point", "n"]).groupBy("point", "n").agg(F.coalesce(F.min("doc_id"), no_id).alias("owner")), "candidates")
    sets = texts_only.select(F.coalesce("doc_id", no_id).alias("owner"), "text").mapInArrow(lean(_sets(id_filter(owners.select("owner")))), "point long, n long, s array<bigint>, " + ", ".join(f"{c} long" for c in BIT_COLUMNS))
    sets = materialize(sets.join(owners, ["point", "n"], "left_semi").dropDuplicates(["point", "n"]), "sets")
    spark = docs.sparkSession
    roots = spark.createDataFrame([], "node long, root long")
    links = spark.createDataFrame([], "a long, b long")
    tested = spark.createDataFrame([], "a long, na long, b long, nb long, both long")
    low, width, first_pairs = 0, 1, True
    while True:
        state = ranked.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        alive = state.groupBy("h").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.max(F.when(F.col("small"), F.col("rank"))).alias("_last")).where((F.col("_lo") != F.col("_hi")) & (F.col("_last") > low)).select("h")
        if not first_pairs:
            away = tested.select(F.xxhash64("a", "na").alias("p0"), F.xxhash64("b", "nb").alias("node"), (1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("d"))
            state = state.join(away, ["p0", "node"], "left")
        else:
            state = state.withColumn("d", F.lit(None).cast("double"))
        state = state.join(alive, "h", "left_semi")
        if first_pairs:
            state = state.join(sets.drop("s"), ["point", "n"])
        state = materialize(state.select("h", "point", "n", "small", "node", "rank", "p0", "root", "d", *BIT_COLUMNS), "regions")
        if state.isEmpty():
            break
        # components only merge and ranks only grow: a cell that is done stays done, so rounds read ever less
        ranked = state.drop("root", "d")
        p = state.where(F.col("small") & (F.col("rank") > low) & (F.col("rank") <= low + width)).select("h", F.col("point").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"), F.col("d").alias("da"), *[F.col(c).alias("a" + c) for c in BIT_COLUMNS])
        m = state.select("h", F.col("point").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"), F.col("d").alias("db"), *[F.col(c).alias("b" + c) for c in BIT_COLUMNS])
        near = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
        window = F.coalesce(F.abs(F.col("da") - F.col("db")) <= 1 - T + 1e-9, F.lit(True))
        pairs = p.join(m, "h").where(near & (F.col("ra") != F.col("rb")) & (4 * F.col("na") >= 3 * F.col("nb")) & window & _may_link("na", "nb", "a", "b")).select("a", "na", "b", "nb").distinct()
        if first_pairs:  # each point against the smallest pivot of all its cells: a large group is one component before its cells are gone through
            pairs = pairs.groupBy("b", "nb").agg(F.min(F.struct("na", "a")).alias("_p")).select(F.col("_p.a").alias("a"), F.col("_p.na").alias("na"), "b", "nb")
        else:
            pairs = pairs.join(tested, ["a", "na", "b", "nb"], "left_anti")
        found = materialize(_verified(pairs, sets), "overlaps")
        new = found.where(100 * F.col("both") >= 75 * (F.col("na") + F.col("nb") - F.col("both"))).select(F.xxhash64("a", "na").alias("a"), F.xxhash64("b", "nb").alias("b"))
        tested, links = (found, new) if first_pairs else (tested.unionByName(found), links.unionByName(new))
        if first_pairs:
            first_pairs = False
        else:
            low, width = low + width, 2 * width
        if not new.isEmpty():
            roots = merged_roots(roots, new)
    return points.withColumn("node", node), links, roots


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id reached by links, itself included)."""
    points, _, roots = similar(docs)
    full = points.where("n > 0").join(roots, "node", "left").select("doc_id", "n", F.coalesce("root", "node").alias("root"))
    least = full.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    joined = full.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return joined.unionByName(points.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component; columns unchanged.

    The row with the smallest ``doc_id`` stays (null comes last), among rows
    of that id the one with the smallest hash of id and text, and among rows
    equal in both the one with the smallest hash of all columns. Rows without
    words stay. What goes is decided per row, by id and text, so a row whose
    id repeats elsewhere with another text is judged by its own. Texts that
    stay are not shuffled: the keys to drop are found in a filter of fixed
    size, and the keys it takes by mistake, as a rule none, are joined back.
    """
    points, _, roots = similar(docs)
    rows = points.where("n > 0").join(roots, "node", "left").select("doc_id", "key", F.coalesce("root", "node").alias("root"))
    rows = materialize(rows, "rows")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    stays = rows.groupBy("root").agg(F.min(order).getField("key").alias("stays"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    judged = materialize(rows.join(stays, "root"), "judged")
    gone = materialize(judged.where("key <> stays").select("key").distinct(), "dropped-rows")
    marks, name = id_filter(gone), "_key" + "_" * max((len(c) for c in docs.columns), default=0)
    stay = rows.join(gone, "key", "left_anti").select("key").unionByName(points.where("n = 0").select("key"))
    mistaken = materialize(stay.where(in_filter(marks, "key")).distinct(), "mistaken-rows")
    repeated = materialize(judged.where("key = stays").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "repeated-rows")
    keyed = docs.withColumn(name, row_key(docs))
    inside, outside = keyed.where(in_filter(marks, name)), keyed.where(~in_filter(marks, name))

    def pick(of: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return of.join(keys, of[name] == keys["key"], how)

    kept = outside.unionByName(pick(inside, mistaken, "left_semi"))
    whole = F.struct(*[F.col(c) for c in docs.columns])
    one = pick(kept, repeated, "left_semi").groupBy(name).agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias("_row"))
    return pick(kept, repeated, "left_anti").select(*docs.columns).unionByName(one.select(*[F.col("_row")[c].alias(c) for c in docs.columns]))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT rid, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM w),
points AS (SELECT s, min(doc_id) AS id, len(s) AS n, row_number() OVER () AS p FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT p, n, unnest(s) AS g FROM points),
overlap AS (SELECT a.p AS a, b.p AS b, a.n AS na, b.n AS nb, count(*) AS i FROM shingles a JOIN shingles b ON a.g = b.g AND a.p < b.p GROUP BY ALL),
links AS (SELECT a, b FROM overlap WHERE 100 * i >= 75 * (na + nb - i)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links UNION ALL SELECT p, p FROM points),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT r.a AS p, min(q.id) AS component_id FROM reach r JOIN points q ON q.p = r.b GROUP BY r.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE l.component_id END AS component_id
FROM sets s LEFT JOIN points q ON q.s = s.s LEFT JOIN least l ON l.p = q.p
"""
