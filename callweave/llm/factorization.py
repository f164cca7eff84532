"""Quality classifier: a factorisation machine over words, structure and metadata.

A text is a sparse vector x of: its lower-cased words (ASCII letters) hashed
into ``BUCKETS``, valued ``log(1 + count)`` and scaled to length one; one
indicator per structure statistic (shares of capitals, digits, symbols,
marks, non-ASCII bytes, line breaks, distinct words, distinct word pairs,
the commonest word, mean word length, number of words), binned at fixed
cuts; and one indicator of metadata, the binary order of ``n_chars`` (its
own bin where null or where the table has no such column). The model is

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

with vectors v_i of ``RANK`` factors. The pairwise sum is never formed: per
factor it is half of (sum_i v_i x_i)^2 - sum_i v_i^2 x_i^2, linear in the
number of features. The score is its logistic function, fitted by log loss,
so it estimates the probability of label 1.

Fit: at most about ``FIT_ROWS`` labelled rows, chosen by a hash of the id (a
documented bound of the fit alone; every row is scored whole). The rows are
dealt to ``FIT_PARTS`` groups; in each of ``ROUNDS`` rounds every group takes
``EPOCHS`` passes of AdaGrad from the shared parameters, and the driver
averages the groups' parameters, whose size is fixed.

Null text counts as empty; an empty text has structure and metadata only.
Null ids and null labels are not learned from; an id with several labels
counts once for each, an id with several texts by the largest. Without a
labelled row every score is 0.5. Repeated rows get equal scores; further
columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.session import materialize

from .common import workers_import
from .words import buffers, mix, words

BUCKETS = 1 << 15
RANK = 8
FIT_ROWS = 20_000
FIT_PARTS = 4
ROUNDS = 5
EPOCHS = 2
BATCH = 64
RATE = 0.1
DECAY = 1e-4
THRESHOLD = 0.3
SLICE = 4 << 20

SHARES = [0.0, 0.001, 0.003, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9]
#: statistic: upper cuts of its bins; the last bin is open
CUTS = {
    "capitals": SHARES, "digits": SHARES, "symbols": SHARES, "marks": SHARES, "non_ascii": SHARES, "breaks": SHARES,
    "distinct_words": [0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9], "distinct_pairs": [0.1, 0.2, 0.4, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99],
    "commonest": [0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.5, 0.8], "word_length": [2, 3, 4, 4.5, 5, 5.5, 6, 7, 8, 10, 14, 20],
    "n_words": [2.0 ** k for k in range(0, 18)], "n_chars": [2.0 ** k for k in range(0, 24)],
}
_FIRST = dict(zip(CUTS, (BUCKETS + np.cumsum([0] + [len(c) + 2 for c in CUTS.values()])).tolist(), strict=False))
SIZE = BUCKETS + sum(len(c) + 2 for c in CUTS.values())  # the last bin of each is for null

_KINDS = ("capitals", "digits", "symbols", "marks", "non_ascii", "breaks")
_KIND = np.full(256, len(_KINDS), np.uint8)
_KIND[65:91] = 0
_KIND[48:58] = 1
_KIND[[ord(c) for c in "#*$%&|<>"]] = 2
_KIND[[ord(c) for c in "!\"'()+,-./:;=?@[\\]^_`{}~"]] = 3
_KIND[128:] = 4
_KIND[10] = 5


@dataclass
class Sparse:
    """Rows of features: row k has ``index[at[k]:at[k + 1]]`` with the values beside them."""

    at: np.ndarray
    index: np.ndarray
    value: np.ndarray


def _kinds(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each kind per text, and bytes per text."""
    data, at = buffers(column)
    n = len(at) - 1
    out = np.zeros((n, len(_KINDS) + 1), np.int64)
    for begin in range(0, len(data), SLICE):
        part = _KIND[data[begin:begin + SLICE]]
        row = np.repeat(np.arange(n), np.diff(np.clip(at, begin, begin + len(part))))
        out += np.bincount(row * out.shape[1] + part, minlength=out.size).reshape(out.shape)
    return out[:, :-1], np.diff(at)


def _bins(name: str, values: np.ndarray) -> np.ndarray:
    bins = np.searchsorted(CUTS[name], values, side="left")
    return _FIRST[name] + np.where(np.isnan(values), len(CUTS[name]) + 1, bins)


def _distinct(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    all_keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    if counts is None:
        return np.unique(all_keys, return_counts=True)
    found, back = np.unique(all_keys, return_inverse=True)
    return found, np.bincount(back, np.concatenate(counts) if counts else None, minlength=len(found)).astype(np.int64)


def features(column: pa.Array, n_chars: np.ndarray) -> Sparse:
    """Features of every text of ``column`` (null: empty); ``n_chars`` holds NaN for null."""
    n = len(column)
    shift = np.uint64(32)
    seen, seen_n, pairs, n_words, letters = [], [], [], np.zeros(n, np.int64), np.zeros(n, np.int64)
    before: tuple[int, np.uint64] | None = None
    for w in words(column, lower=True):
        row = np.repeat(np.arange(w.row, w.row + len(w.count)), w.count)
        n_words += np.bincount(row, minlength=n)
        letters += np.bincount(row, w.length, minlength=n).astype(np.int64)
        if not len(row):
            continue
        # row and 32 bits of the word's hash in one number
        key = (row.astype(np.uint64) << shift) | (w.hash >> shift)
        found, times = np.unique(key, return_counts=True)
        seen.append(found)
        seen_n.append(times)
        last, hashes = row, w.hash
        if before is not None and before[0] == row[0]:  # a long text goes on
            last, hashes = np.append(before[0], row), np.append(before[1], w.hash)
        pair = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
        same = last[:-1] == last[1:]
        pairs.append(np.unique((last[:-1][same].astype(np.uint64) << shift) | (pair[same] >> shift)))
        before = int(row[-1]), w.hash[-1]
    key, times = _distinct(seen, seen_n)
    row = (key >> shift).astype(np.int64)
    n_distinct = np.bincount(row, minlength=n)
    commonest = np.zeros(n, np.int64)
    np.maximum.at(commonest, row, times)
    n_pairs = np.bincount((_distinct(pairs)[0] >> shift).astype(np.int64), minlength=n)
    # words to buckets
    bucket = (key >> np.uint64(8)) & np.uint64(BUCKETS - 1)
    cell, value = _distinct([(row.astype(np.uint64) << shift) | bucket], [times])
    row = (cell >> shift).astype(np.int64)
    value = np.log1p(value)
    length = np.sqrt(np.bincount(row, value * value, minlength=n))
    value /= np.maximum(length, 1e-12)[row]
    # statistics
    kinds, size = _kinds(column)
    some, many = np.maximum(size, 1), np.maximum(n_words, 1)
    stats = {k: kinds[:, j] / some for j, k in enumerate(_KINDS)}
    stats |= {"distinct_words": n_distinct / many, "distinct_pairs": n_pairs / np.maximum(n_words - 1, 1), "commonest": commonest / many,
              "word_length": letters / many, "n_words": n_words.astype(float), "n_chars": n_chars}
    dense = np.stack([_bins(k, stats[k]) for k in CUTS], 1)
    rows = np.concatenate([row, np.repeat(np.arange(n), len(CUTS))])
    index = np.concatenate([(cell & np.uint64(0xFFFFFFFF)).astype(np.int64), dense.ravel()])
    values = np.concatenate([value, np.ones(dense.size)])
    order = np.argsort(rows, kind="stable")
    return Sparse(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]), index[order].astype(np.int32), values[order].astype(np.float32))


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # SIZE
    factors: np.ndarray  # SIZE x RANK

    def logits(self, x: Sparse) -> np.ndarray:
        """Every row has a feature, so no part of the sums is empty."""
        if len(x.at) == 1:
            return np.zeros(0)
        begin, v = x.at[:-1], self.factors[x.index] * x.value[:, None]
        total = np.add.reduceat(v, begin, axis=0)
        return self.bias + np.add.reduceat(self.linear[x.index] * x.value, begin) + 0.5 * (total * total - np.add.reduceat(v * v, begin, axis=0)).sum(1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def start(share: float, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    return Model(float(np.log(share / (1 - share))), np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, RANK)))


def train(model: Model, x: Sparse, y: np.ndarray, epochs: int, seed: int) -> Model:
    """AdaGrad over mini-batches of ``BATCH`` rows, ``epochs`` passes from ``model`` on."""
    rng = np.random.default_rng(seed)
    bias, w, v = model.bias, model.linear.copy(), model.factors.copy()
    sums = np.full((SIZE, RANK + 1), 1.0)
    bias_sum = 1.0
    for _ in range(epochs):
        deal = rng.permutation(len(y))
        for k in range(0, len(deal), BATCH):
            rows = deal[k:k + BATCH]
            n = np.diff(x.at)[rows]
            take = np.repeat(x.at[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            index, value, begin = x.index[take], x.value[take].astype(np.float64), np.cumsum(n) - n
            vx = v[index] * value[:, None]
            total = np.add.reduceat(vx, begin, axis=0)
            logit = bias + np.add.reduceat(w[index] * value, begin) + 0.5 * (total * total - np.add.reduceat(vx * vx, begin, axis=0)).sum(1)
            error = sigmoid(logit) - y[rows]
            each = np.repeat(error, n) * value
            used, back = np.unique(index, return_inverse=True)
            grad = np.empty((len(used), RANK + 1))
            grad[:, 0] = np.bincount(back, each, minlength=len(used))
            inner = each[:, None] * (np.repeat(total, n, axis=0) - vx)
            for f in range(RANK):
                grad[:, f + 1] = np.bincount(back, inner[:, f], minlength=len(used))
            grad[:, 0] += DECAY * w[used]
            grad[:, 1:] += DECAY * v[used]
            sums[used] += grad * grad
            step = RATE * grad / np.sqrt(sums[used])
            w[used] -= step[:, 0]
            v[used] -= step[:, 1:]
            bias_sum += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(bias_sum)
    return Model(float(bias), w, v)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _length(docs: DataFrame) -> Column:
    return F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")


def _lengths(column: pa.Array) -> np.ndarray:
    return column.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(float)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(batch.column(0), _lengths(batch.column(1)))
        at = pa.array(x.at.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), batch.column(3), pa.ListArray.from_arrays(at, pa.array(x.index)), pa.ListArray.from_arrays(at, pa.array(x.value))], names=["part", "y", "index", "value"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS, parts: int = FIT_PARTS, rounds: int = ROUNDS) -> Model | None:
    """Fit on the labelled rows of ``docs``; the caller leaves out what must not be learned from."""
    workers_import(docs.sparkSession)
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select(
        F.col("doc_id").cast("long").alias("_id"), (F.col(label) > 0).cast("double").alias("_y")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"), _length(docs).alias("_n"))
    n = marks.count()
    if not n:
        return None
    # the labels decide the sample, less than twice ``fit_rows`` pairs of id and label, so that the documents stay where they are
    few = marks.where(F.pmod(F.xxhash64("_id", "_y"), F.lit(max(1, n // fit_rows))) == 0)
    mine = F.pmod(F.xxhash64("_id", "_y", F.octet_length(F.coalesce("_text", F.lit("")))), F.lit(parts)).cast("int")
    one = rows.join(F.broadcast(few), "_id").groupBy("_id", "_y").agg(F.max(F.struct("_text", "_n")).alias("_d")).select("_id", "_y", "_d._text", "_d._n")
    given = one.select("_text", "_n", mine.alias("_part"), "_y")
    table = materialize(given.mapInArrow(_rows, "part int, y double, index array<int>, value array<float>"), "fm-features")
    share = table.agg(F.count("y"), F.sum("y")).first()
    if not share[0]:
        return None
    model = start((share[1] + 1) / (share[0] + 2))
    for r in range(rounds):
        held = model

        def step(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            order = sorted(range(len(rows)), key=lambda i: (len(rows["index"].iloc[i]), rows["index"].iloc[i].tobytes(), rows["value"].iloc[i].tobytes(), rows["y"].iloc[i]))  # noqa: B023
            index, value = [rows["index"].iloc[i] for i in order], [rows["value"].iloc[i] for i in order]
            x = Sparse(np.concatenate([[0], np.cumsum([len(i) for i in index])]), np.concatenate(index), np.concatenate(value))
            new = train(held, x, rows["y"].to_numpy()[order], EPOCHS, 100 * r + int(key[0]))  # noqa: B023
            return pd.DataFrame({"n": [len(rows)], "model": [np.concatenate([[new.bias], new.linear, new.factors.ravel()]).tobytes()]})

        got = table.groupBy("part").applyInPandas(step, "n long, model binary").collect()  # one row of fixed size per part
        got.sort(key=lambda g: g["model"])
        flat = sum(g["n"] * np.frombuffer(g["model"], np.float64) for g in got) / sum(g["n"] for g in got)
        model = Model(float(flat[0]), flat[1:SIZE + 1], flat[SIZE + 1:].reshape(SIZE, RANK))
    return Model(model.bias, model.linear.astype(np.float32), model.factors.astype(np.float32))


def score(docs: DataFrame, model: Model | None, score_as: str = "score") -> DataFrame:
    """``docs`` with one column more, the probability of label 1."""
    workers_import(docs.sparkSession)
    fields, names = docs.schema.fields, [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                found = np.full(batch.num_rows, 0.5)
            else:
                found = sigmoid(model.logits(features(batch.column(at).cast(pa.string()), _lengths(batch.column(batch.num_columns - 1)))).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())], names=[*names, "score"])

    given = docs.select(*[F.col(c) for c in docs.columns], _length(docs)).toDF(*names, "n_chars")
    plain = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(names, fields, strict=True)] + [T.StructField("score", T.DoubleType())])
    return given.mapInArrow(judge, plain).toDF(*docs.columns, score_as)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fit on the rows that are not held out and score all: doc_id, held_out, score, predicted."""
    lean = docs.select("doc_id", F.col("text").cast("string").alias("text"), _length(docs).alias("n_chars"))
    model = fit(lean.where(~held_out(F.col("doc_id"))), labels.where(~held_out(F.col("doc_id"))))
    found = score(lean, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
