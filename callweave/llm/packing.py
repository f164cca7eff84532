"""Packing: vector bin packing by the dot-product heuristic.

A sequence has room for a number of tokens, of segments (pieces) and of
loss-bearing tokens at once. Pieces are dealt at random into groups of about
``group_rows``; a group is packed by itself, so the work splits over tasks
at any size and a group wastes at most its last, unfilled sequence. Inside a
group one sequence is open at a time: of the pieces that still fit in every
dimension the one with the largest demand-weighted dot product with the
room left goes in, until none fits. Equal vectors are interchangeable and
are held as one vector with a count; among equal scores the larger vector
wins, and equal vectors are taken in order of ``order``.

A piece larger than a limit in any dimension raises an error. Rows may
repeat; null counts count as 0; ids pass through as they are, null or large.
An empty table gives no rows.

Documents are packed under three limits that all bind: ``SEQUENCE`` tokens,
``SEGMENTS`` pieces (short documents reach it), and ``LOSS_TOKENS``
loss-bearing tokens, all but the first of a document (sequences of a few
long pieces reach it, and pieces are cut to it). The last costs a sequence
8 tokens of 4096 at most.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.session import materialize

from .common import small_batches, workers_import
from .tokens import END_ID, encode, vocabulary

SEQUENCE = 4096
SEGMENTS = 64
LOSS_TOKENS = 4088
GROUP_ROWS = 16384
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, segments long, loss_tokens long, salt long"


def fill(vectors: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Sequences as lists of row numbers of ``vectors``."""
    if not len(vectors):
        return []
    if (vectors > limits).any():
        raise ValueError("a piece is larger than a sequence")
    kinds, kind = np.unique(vectors, axis=0, return_inverse=True)
    kind = kind.ravel()
    rows = np.argsort(kind, kind="stable")
    count = np.bincount(kind, minlength=len(kinds))
    nexts = np.cumsum(count) - count
    share = kinds / limits
    weight = vectors.sum(0) / limits
    weight = weight / weight.sum() if weight.sum() else np.ones(len(limits))
    alive = np.arange(len(kinds))[::-1]
    out = []
    while len(alive):
        room, used = limits.copy(), []
        v, s = kinds[alive], share[alive] * weight
        left = count[alive].copy()
        while True:
            fits = (v <= room).all(1) & (left > 0)
            if not fits.any():
                break
            k = int(np.argmax(np.where(fits, s @ (room / limits), -1.0)))
            kind_of = alive[k]
            used.append(int(rows[nexts[kind_of]]))
            nexts[kind_of] += 1
            left[k] -= 1
            room = room - v[k]
        count[alive] = left
        alive = alive[left > 0]
        out.append(used)
    return out


def pack(pieces: DataFrame, limits: dict[str, int], order: Sequence[str], salt: str | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (in the first dimension of ``limits``, without gaps).

    ``limits``: column to room in a sequence. ``order``: columns that order
    equal pieces. ``salt``: a column that parts repeated rows. ``pieces`` is
    read twice, so pass a table.
    """
    workers_import(pieces.sparkSession)
    groups = max(1, -(-pieces.count() // group_rows))
    dims, room = list(limits), np.array(list(limits.values()), dtype=np.float64)
    by = [*order, *([salt] if salt else [])]

    def place(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in by], null_placement="at_start"))
        v = np.stack([rows[c].fill_null(0).to_numpy() for c in dims], 1).astype(np.float64)
        seq, off = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
        for n, used in enumerate(fill(v, room)):
            seq[used] = (key[0].as_py() << 32) + n
            off[used] = np.cumsum(v[used, 0]) - v[used, 0]
        return rows.drop_columns("_group").append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off))

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    group = F.pmod(F.xxhash64(*by), F.lit(groups)).cast("long")
    return pieces.withColumn("_group", group).groupBy("_group").applyInArrow(place, schema)


def _cut(vocabulary_path: str, end_id: int | None, length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = 0
        for batch in batches:
            docs, out = batch.column(0).to_pylist(), []
            for k, ids in encode(batch.column(1), vocabulary_path, end_id):
                data = ids.astype("<u4").tobytes()
                for at in range(0, len(ids), length):
                    n = min(length, len(ids) - at)
                    out.append((docs[k], at, n, zlib.crc32(data[4 * at:4 * (at + n)]), len(ids), 1, n - (at == 0), salt))
                    salt += 1
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(len(names))], names=names)

    return cut


def cut_documents(docs: DataFrame, vocabulary_path: str | None = None, end_id: int | None = END_ID, length: int = SEQUENCE) -> DataFrame:
    """Pieces of at most ``length`` ids of each document (null text: the end id alone), ``PIECES``.

    The first id of a document bears no loss; every other id does.
    """
    workers_import(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_cut(vocabulary_path or vocabulary(), end_id, length), PIECES)


def pack_documents(docs: DataFrame, vocabulary_path: str | None = None, length: int = SEQUENCE, segments: int = SEGMENTS, loss_tokens: int = LOSS_TOKENS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Cut ``docs`` and pack the pieces; one row per piece with its sequence and offset."""
    with small_batches(docs.sparkSession):
        pieces = materialize(cut_documents(docs, vocabulary_path, length=min(length, loss_tokens)), "pieces")
    packed = pack(pieces, {"length": length, "segments": segments, "loss_tokens": loss_tokens}, ("doc_id", "start"), "salt", group_rows)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")
