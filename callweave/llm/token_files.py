"""Token-ID files: patched frame-of-reference blocks.

A file holds the ids of consecutive documents in blocks of ``BLOCK`` ids.
A block stores its minimum, the remaining offsets in ``width`` bits, and the
offsets that need more bits as an exception list; ``width`` is the bit
length of the percentile among ``PERCENTILES`` that gives the smallest
block. The footer lists where blocks start and each document's id and
length, so one document can be read without the rest.

Documents are dealt to shards by ranges of ``doc_id`` and a hash of the text
(:func:`range_shards`), sorted inside, and written by one task per shard
under a temporary name that is renamed when complete; the manifest (a table
in the shared folder) names the files that count. A task that is run again
writes the same bytes, so a file that is complete stays, and readers never
see a part of one.

Nulls: a null text has no ids but the end id; a null ``doc_id`` sorts first
and is read back as null. Rows with equal ``doc_id`` follow one another,
ordered by a hash of the text. An empty table gives no files and no rows. Other columns
are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.session import materialize

from .common import commit_file, filesystem, range_shards, shared_folder, workers_import
from .tokens import END_ID, encode, vocabulary

MAGIC = b"PFR1"
BLOCK = 2048
PERCENTILES = (90, 95, 98, 100)
SHARD_BYTES = 8 << 20
FILE_IDS = 1 << 24
MANIFEST = "shard int, part int, path string, n_docs long, n_ids long, n_bytes long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _bits(values: np.ndarray, width: int) -> bytes:
    if not width:
        return b""
    planes = (values[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def _unbits(data: bytes, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    out = np.zeros(n, np.uint32)
    for b in range(width):
        out |= planes[:, b].astype(np.uint32) << np.uint32(b)
    return out


def pack_block(ids: np.ndarray) -> bytes:
    """One block: minimum, width, count, exceptions (header), packed offsets, exception places and offsets."""
    low = int(ids.min())
    rest = (ids.astype(np.int64) - low).astype(np.uint32)
    order = np.sort(rest)
    best = None
    for p in PERCENTILES:
        width = int(order[min(len(order) - 1, -(-len(order) * p // 100) - 1)]).bit_length()
        over = len(order) - int(np.searchsorted(order, 1 << width)) if width < 32 else 0
        size = -(-len(ids) * width // 8) + 6 * over
        if best is None or size < best[0]:
            best = (size, width)
    width = best[1]
    where = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    kept = rest.copy()
    kept[where] = 0
    return struct.pack("<IBHH", low, width, len(ids), len(where)) + _bits(kept, width) + where.astype("<u2").tobytes() + rest[where].astype("<u4").tobytes()


def unpack_block(data: bytes) -> np.ndarray:
    low, width, n, over = struct.unpack_from("<IBHH", data)
    at = 9 + -(-n * width // 8)
    rest = _unbits(data[9:at], n, width)
    where = np.frombuffer(data, "<u2", over, at)
    rest[where] = np.frombuffer(data, "<u4", over, at + 2 * over)
    return rest + np.uint32(low)


class TokenFile:
    """Writes one file; ``close`` commits it by rename."""

    def __init__(self, folder: str, name: str):
        self.fs, base = filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{folder}/{name}"
        self.final, self.temp = f"{base}/{name}", f"{base}/_{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temp)
        self.out.write(MAGIC)
        self.at, self.starts, self.docs, self.lengths, self.held, self.n_held, self.n_ids = 4, [], [], [], [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= 64 * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.int32)
        end = len(ids) if last else len(ids) // BLOCK * BLOCK
        for k in range(0, end, BLOCK):
            block = pack_block(ids[k:min(k + BLOCK, end)])
            self.starts.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.held, self.n_held = [ids[end:]], len(ids) - end

    def close(self) -> tuple[str, int, int, int]:
        self._flush(True)
        null = np.array([d is None for d in self.docs], np.uint8)
        foot = np.array([*self.starts, self.at], "<u8").tobytes() + null.tobytes() + np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array(self.lengths, "<u8").tobytes()
        self.out.write(foot + struct.pack("<QQQ", len(self.starts), len(self.docs), self.at) + MAGIC)
        self.out.close()
        commit_file(self.fs, self.temp, self.final)
        return self.path, len(self.docs), self.n_ids, self.at + len(foot) + 28


def read_file(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of each document of a file, block after block."""
    fs, at = filesystem(path)
    with fs.open_input_file(at) as src:
        size = src.size()
        src.seek(size - 28)
        n_blocks, n_docs, foot = struct.unpack("<QQQ", src.read(28)[:24])
        src.seek(foot)
        data = src.read(size - 28 - foot)
        starts = np.frombuffer(data, "<u8", n_blocks + 1)
        null = np.frombuffer(data, np.uint8, n_docs, 8 * (n_blocks + 1))
        docs = np.frombuffer(data, "<i8", n_docs, 8 * (n_blocks + 1) + n_docs)
        lengths = np.frombuffer(data, "<u8", n_docs, 8 * (n_blocks + 1) + 9 * n_docs)
        src.seek(4)
        held, block = np.zeros(0, np.uint32), 0
        for k in range(n_docs):
            need, parts, have = int(lengths[k]), [held], len(held)
            while have < need:
                parts.append(unpack_block(src.read(int(starts[block + 1] - starts[block]))))
                have += len(parts[-1])
                block += 1
            ids = np.concatenate(parts) if len(parts) > 1 else held
            held = ids[need:]
            yield (None if null[k] else int(docs[k])), ids[:need]


def _writer(folder: str, vocabulary_path: str, end_id: int | None, file_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
        file, shard, part, rows = None, None, 0, []

        def close() -> None:
            nonlocal file
            if file is not None:
                rows.append((shard, part, *file.close()))
            file = None

        for batch in batches:
            shards, docs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, ids in encode(batch.column(2), vocabulary_path, end_id):
                if shards[k] != shard:
                    close()
                    shard, part = shards[k], 0
                elif file is not None and file.n_ids >= file_ids:
                    close()
                    part += 1
                if file is None:
                    file = TokenFile(folder, f"{shard:08d}-{part:04d}.pfr")
                file.add(docs[k], ids)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.types[i]) for i in range(len(schema))], schema=schema)

    return write


def write_token_files(docs: DataFrame, folder: str | None = None, vocabulary_path: str | None = None, end_id: int | None = END_ID, shard_bytes: int = SHARD_BYTES, file_ids: int = FILE_IDS) -> DataFrame:
    """Write ``docs`` (doc_id, text) and return the committed manifest: one row per file, ``MANIFEST``."""
    spark = docs.sparkSession
    workers_import(spark)
    folder = folder or shared_folder(spark, "token-files")
    tie = F.xxhash64("text")
    rows, shards = range_shards(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)) + 16, shard_bytes, tie)
    dealt = rows.select("shard", "doc_id", "text").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), tie, F.asc_nulls_first("text"))
    return materialize(dealt.mapInArrow(_writer(folder, vocabulary_path or vocabulary(), end_id, file_ids), MANIFEST), "token-manifest")


def _reader(batches):
    for batch in batches:
        out = []
        for path, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            at = begin
            for doc_id, ids in read_file(path):
                out.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                at += len(ids)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document of the manifest's files: doc_id, start (ids before it), n_tokens, ids_crc32."""
    workers_import(spark)
    order = Window.orderBy("shard", "part")  # one row per file
    files = manifest.select("path", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("start"))
    return files.repartition(max(1, manifest.count()), "path").mapInArrow(_reader, READ)
