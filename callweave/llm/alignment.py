"""Cross-tokenizer alignment by inverted pair bitmaps.

A text is encoded by two vocabularies, A and B, whose tokens cover the same
bytes. Offsets where a token of each ends cut both into groups; an A token
and a B token are linked where their byte ranges overlap. The links of a
corpus are kept inverted: for a pair of ids, a compressed bitmap of the
documents that link it, and planes with the bits of how often beyond once.
Documents have a place in a block of at most ``BLOCK_DOCS``, so a bitmap is
a sorted list of 16-bit places, or 8 kB of bits where that is shorter.
Within a block the bitmaps of its parts are OR-merged; blocks hold different
documents, so the popcounts of a pair's bitmaps add up to its document count
and, weighted by plane, to its link count. Counts then return through the
postings: each block reads its bitmaps once and adds every pair's count to
its documents.

Texts are cut before a space or line feed that follows a character other
than white space. Neither vocabulary joins bytes across such a place (A's
pre-tokenizer begins a new part there; B has no piece with a space or line
feed behind another character, which is checked), so a segment's tokens,
groups and links are those it has in the whole text, and a worker aligns
each distinct segment once (a cache bounded by bytes).

Null and empty texts, and texts whose tokens' bytes differ from space+text,
have no tokens: zeros, and '' for the groups. Repeated rows and null ids are
documents of their own; further columns are left out; an empty table gives
no rows. A long text is worked through in slices; one document's groups line
is built by parts under a running hash.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.session import materialize

from .common import worker_cache, workers_import

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_DOCS = 1 << 16
BLOCK_LINKS = 1_500_000  # links taken into a block's index at once
BLOCK_ENTRIES = 3_000_000  # a block closes beyond so many (pair, document) entries
KEEP_BYTES = 128 << 20  # of a worker's cache of segments
LONG_SEGMENT = 4096  # longer ones are not kept
CHUNK_CHARS = 1 << 16  # characters of new segments encoded as one text
FRONT = " a"  # a segment in front of them that both vocabularies cover
GROUP_CHARS = 2 << 20  # characters of documents whose segments are looked up together
SLICE = 100_000  # segments of a long text at once
BITS = BLOCK_DOCS // 8
_CUT = re.compile(r"(?<=\S)(?=[ \n]\s*\S)")
_UNEVEN = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z|\x00")

DOC = "block long, slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
POSTING = "a int, b int, plane int, n long, bits binary"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_level() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}


class _Table:
    """Bytes of every token id."""

    def __init__(self, tokens: dict[int, bytes]):
        self.length = np.zeros(max(tokens, default=0) + 1, np.int64)
        for k, t in tokens.items():
            self.length[k] = len(t)
        self.token = tokens

    def join(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


class Aligner:
    """Aligns segments and keeps what it has aligned, by number, up to about ``KEEP_BYTES``."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        chars = _byte_level()
        self.table_a = _Table({k: bytes(chars[c] for c in t) if all(c in chars for c in t) else t.encode() for t, k in self.a.get_vocab(with_added_tokens=True).items()})
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError(f"{path_b}: a piece with white space behind another character")
        self.table_b = _Table({k: bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)})
        if not self._encode([])[2]:
            raise ValueError(f"{path_a}, {path_b}: {FRONT!r} is not covered")
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links
        self.bad = np.zeros(0, bool)
        self.pairs = np.zeros(0, np.int64)
        self.at = np.zeros(1, np.int64)
        self.bytes = 0

    def _encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, bool]:
        """A ids and B ids of some segments behind ``FRONT``, as one text, and whether the bytes of both are its bytes."""
        text = FRONT + "".join(segments)
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode(text[1:])  # B puts a space in front itself
        raw = text.encode()
        same = self.table_a.join(a) == raw and self.table_b.join(b) == raw
        return np.array(a, np.int64), np.array(b, np.int64), same

    def align(self, segments: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each segment: groups line, sizes, whether its bytes differ; and all links as ``a << 32 | b``."""
        found, at, size = [], 0, 0
        for k, s in enumerate(segments):  # a text's last segment may end in white space: nothing may follow it
            size += len(s)
            if size >= CHUNK_CHARS or s[-1].isspace() or k == len(segments) - 1:
                found += self._chunk(segments[at:k + 1])
                at, size = k + 1, 0
        lines, sizes, bad, link = zip(*found, strict=True)
        return [x for part in lines for x in part], np.concatenate(sizes), np.concatenate(bad), np.concatenate(link)

    def _chunk(self, segments: list[str]) -> list[tuple]:
        a, b, same = self._encode(segments)
        if not same:
            if len(segments) == 1:
                return [([""], np.zeros((1, 4), np.int64), np.ones(1, bool), np.zeros(0, np.int64))]
            half = len(segments) // 2
            return [*self._chunk(segments[:half]), *self._chunk(segments[half:])]
        end_a, end_b = np.cumsum(self.table_a.length[a]), np.cumsum(self.table_b.length[b])
        stop = len(FRONT) + np.cumsum([len(s) if s.isascii() else len(s.encode()) for s in segments])
        # tokens of FRONT end at its end in both, and so do those of every segment
        a, b = a[end_a > len(FRONT)], b[end_b > len(FRONT)]
        end_a, end_b = end_a[end_a > len(FRONT)], end_b[end_b > len(FRONT)]
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        ends = np.union1d(end_a, end_b)
        link = (a[np.searchsorted(end_a, ends)] << 32) | b[np.searchsorted(end_b, ends)]
        sizes = np.stack([np.diff(np.searchsorted(x, stop, side="right"), prepend=0) for x in (end_a, end_b, both, ends)], 1)
        cut_a, cut_b = (np.searchsorted(x, both, side="right").tolist() for x in (end_a, end_b))
        names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        text, i, j = [], 0, 0
        for x, y in zip(cut_a, cut_b, strict=True):
            if x - i == 1 == y - j:
                text.append(f"{names_a[i]}|{names_b[j]}")
            else:
                text.append(",".join(names_a[i:x]) + "|" + ",".join(names_b[j:y]))
            i, j = x, y
        lines, at = [], 0
        for n in sizes[:, 2].tolist():
            lines.append(text[at] if n == 1 else ";".join(text[at:at + n]))
            at += n
        return [(lines, sizes, np.zeros(len(segments), bool), link)]

    def numbers(self, segments: list[str]) -> np.ndarray:
        """Numbers of the segments, new ones aligned."""
        known = self.number
        distinct = set(segments)
        new = sorted(s for s in distinct if s not in known)
        if new and self.bytes > KEEP_BYTES:
            self.clear()
            known, new = self.number, sorted(distinct)
        if new:
            lines, sizes, bad, link = self.align(new)
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self.groups += lines
            self.sizes = np.concatenate([self.sizes, sizes])
            self.bad = np.append(self.bad, bad)
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes[:, 3])])
            self.pairs = np.append(self.pairs, link)
            self.bytes += sum(map(len, new)) + sum(map(len, lines)) + 8 * len(link) + 300 * len(new)
        return np.fromiter(map(known.__getitem__, segments), np.int64, len(segments))

    def links(self, numbers: np.ndarray) -> np.ndarray:
        n = self.sizes[numbers, 3]
        return self.pairs[np.repeat(self.at[numbers] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def segments(text: str) -> list[str]:
    if _UNEVEN.search(text):
        return _CUT.split(" " + text)
    return (" " + text).replace(" ", "\x00 ").replace("\n", "\x00\n").split("\x00")[1:]  # the same, faster


class _Block:
    """Links of some documents, inverted: sorted keys of pair and place, and how often."""

    def __init__(self, block: int):
        self.block, self.docs = block, 0
        self.key, self.times = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, pairs: np.ndarray, slot: int) -> None:
        """``pairs`` as ``a << 32 | b``; a key holds A's id, 24 bits of B's and 16 of the place."""
        for at in range(0, len(pairs), BLOCK_LINKS):
            part = pairs[at:at + BLOCK_LINKS]
            self.waiting.append(((part >> 32) << 40) | ((part & 0xFFFFFF) << 16) | slot)
            self.n_waiting += len(part)
            if self.n_waiting >= BLOCK_LINKS:
                self.merge()

    def merge(self) -> None:
        """OR the waiting links in; places met again add up."""
        if not self.waiting:
            return
        key, times = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.waiting, self.n_waiting = [], 0
        if not len(self.key):
            self.key, self.times = key, times.astype(np.int32)
            return
        at = np.searchsorted(self.key, key)
        again = self.key[np.minimum(at, len(self.key) - 1)] == key
        self.times[at[again]] += times[again].astype(np.int32)
        self.key = np.insert(self.key, at[~again], key[~again])
        self.times = np.insert(self.times, at[~again], times[~again].astype(np.int32))

    def postings(self) -> pa.RecordBatch:
        """One row per pair and plane; plane 0 marks the documents, plane j those with bit j-1 of the times beyond once."""
        self.merge()
        more, parts = self.times - 1, []
        planes = [(0, np.arange(len(self.key)))] + [(j + 1, np.flatnonzero(more >> j & 1)) for j in range(int(more.max(initial=0)).bit_length())]
        for plane, rows in planes:
            if not len(rows):
                continue
            pair, slot = self.key[rows] >> 16, (self.key[rows] & 0xFFFF).astype("<u2")
            first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            n = np.diff(np.append(first, len(pair)))
            dense = np.flatnonzero(2 * n >= BITS)
            if len(dense):
                bits = [slot[s:s + c].tobytes() if 2 * c < BITS else _bits(slot[s:s + c]) for s, c in zip(first.tolist(), n.tolist(), strict=True)]
                held = pa.array(bits, pa.binary())
            else:
                ends = np.concatenate([[0], np.cumsum(2 * n)]).astype(np.int32)
                held = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(slot.tobytes())])
            key = pair[first]
            parts.append(pa.RecordBatch.from_arrays([pa.array((key >> 24).astype(np.int32)), pa.array((key & 0xFFFFFF).astype(np.int32)), pa.array(np.full(len(n), plane, np.int32)), pa.array(n), held],
                                                    names=["a", "b", "plane", "n", "bits"]))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if parts else None


def _bits(slots: np.ndarray) -> bytes:
    marks = np.zeros(BLOCK_DOCS, np.uint8)
    marks[slots] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def slots(bits: bytes) -> np.ndarray:
    """The places of a bitmap."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")) if len(bits) == BITS else np.frombuffer(bits, "<u2").astype(np.int64)


_DOC_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string()]
_POSTING_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
_NAMES = ["kind", *[c.split()[0] for c in f"{DOC}, {POSTING}".split(", ")]]


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    held = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _DOC_TYPES, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(["doc"] * len(rows)), *held, *[pa.nulls(len(rows), t) for t in _POSTING_TYPES]], names=_NAMES)


def _postings(block: _Block) -> Iterator[pa.RecordBatch]:
    found = block.postings()
    if found is not None:
        n = found.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(["posting"] * n), pa.array(np.full(n, block.block)), *[pa.nulls(n, t) for t in _DOC_TYPES[1:]], *found.columns], names=_NAMES)


def _index(path_a: str, path_b: str):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        kept = worker_cache("alignment")
        if (path_a, path_b) not in kept:
            kept[path_a, path_b] = Aligner(path_a, path_b)
        aligner = kept[path_a, path_b]
        block = _Block((context.partitionId() if context else 0) << 32)
        for batch in batches:
            for ids, texts in _groups(batch):
                rows = []
                for doc_id, (sizes, digest, links) in zip(ids, _aligned(aligner, texts), strict=True):
                    rows.append((block.block, block.docs, doc_id, *sizes, digest))
                    for part in links:
                        block.add(part, block.docs)
                    block.docs += 1
                    if block.docs == BLOCK_DOCS or len(block.key) + block.n_waiting // 2 > BLOCK_ENTRIES:
                        yield from _postings(block)
                        block = _Block(block.block + 1)
                yield _documents(rows)
        yield from _postings(block)

    return index


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Ids and texts of some rows at a time; a text over ``GROUP_CHARS`` comes alone."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        text = text.as_py() or ""
        if texts and size + len(text) > GROUP_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(doc_id)
        texts.append(text)
        size += len(text)
    if texts:
        yield ids, texts


def _aligned(aligner: Aligner, texts: list[str]) -> Iterator[tuple[list[int], str, list[np.ndarray]]]:
    """Sizes, hash of the groups line and links of each text."""
    if len(texts) == 1 and len(texts[0]) > GROUP_CHARS:
        yield _one(aligner, _slices(texts[0]))
        return
    parts = [segments(t) if t else [] for t in texts]
    plain = [k for k, p in enumerate(parts) if p and max(map(len, p)) <= LONG_SEGMENT]
    flat = [s for k in plain for s in parts[k]]
    numbers = aligner.numbers(flat) if flat else np.zeros(0, np.int64)
    held, at = {}, 0
    for k in plain:
        held[k] = numbers[at:at + len(parts[k])]
        at += len(parts[k])
    for k, p in enumerate(parts):
        yield _one(aligner, iter([p] if p else []), held.get(k))


def _slices(text: str) -> Iterator[list[str]]:
    """The segments of a long text, some at a time."""
    text, at, held = " " + text, 0, []
    for cut in _CUT.finditer(text):
        held.append(text[at:cut.start()])
        at = cut.start()
        if len(held) == SLICE:
            yield held
            held = []
    yield [*held, text[at:]]


def _one(aligner: Aligner, slices: Iterator[list[str]], known: np.ndarray | None = None) -> tuple[list[int], str, list[np.ndarray]]:
    """``known``: the numbers of the only slice's segments."""
    total, digest, links, some = np.zeros(4, np.int64), hashlib.sha256(), [], False
    for few in slices:
        if known is None and max(map(len, few)) > LONG_SEGMENT:  # not kept
            lines, sizes, bad, link = aligner.align(few)
        else:
            numbers = aligner.numbers(few) if known is None else known
            lines, sizes, bad = map(aligner.groups.__getitem__, numbers.tolist()), aligner.sizes[numbers], aligner.bad[numbers]
            link = aligner.links(numbers)
        if bad.any():
            return [0] * 4, "", []
        digest.update((";" if some else "").encode() + ";".join(lines).encode())
        some, total = True, total + sizes.sum(0)
        links.append(link)
    return total.tolist(), digest.hexdigest() if some else "", links


def build(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The inverted index, written once below the shared folder: rows of ``kind`` doc (``DOC``) and posting (``block`` + ``POSTING``)."""
    workers_import(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_index(path_a or vocabulary(BYTE_BPE), path_b or vocabulary(PIECE_BPE)), f"kind string, {DOC}, {POSTING}")
    return materialize(found, "pair-bitmaps")


def pair_counts(index: DataFrame) -> DataFrame:
    """a, b, n_docs, n_links over all blocks, and ``best``: whether no pair of the same B id has more links."""
    weight = F.when(F.col("plane") == 0, F.lit(1).cast("long")).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    counts = index.where("kind = 'posting'").groupBy("a", "b").agg(F.sum(F.when(F.col("plane") == 0, F.col("n"))).alias("n_docs"), F.sum(F.col("n") * weight).alias("n_links"))
    counts = materialize(counts, "pair-counts")
    most = counts.groupBy("b").agg(F.max("n_links").alias("_most"))  # at most one row per id of the vocabulary
    return counts.join(F.broadcast(most), "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("_most")).alias("best"))


def _places(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places of all bitmaps one after another, and how many each has."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    size = np.diff(at)
    if not (size == BITS).any():
        held = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
        return np.frombuffer(held.tobytes(), "<u2").astype(np.int64), size // 2
    each = [slots(b) for b in column.to_pylist()]
    return np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))


def _sum_by(slot: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of non-negative integers by place (floats hold each half of the value exactly)."""
    low = np.bincount(slot, (value & 0xFFFFFF).astype(np.float64), minlength=n)
    return (np.bincount(slot, (value >> 24).astype(np.float64), minlength=n).astype(np.int64) << 24) + low.astype(np.int64)


def _score(index: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block with the sums of what their pairs return."""
    kind = index["kind"].combine_chunks()
    docs, postings = index.filter(pc.equal(kind, "doc")), index.filter(pc.equal(kind, "posting"))
    slot = docs["slot"].to_numpy()
    n = int(slot.max(initial=0)) + 1
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    pair = (counts["of_a"].to_numpy().astype(np.int64) << 32) | counts["of_b"].to_numpy()
    order = np.argsort(pair)
    pair, links, is_best = pair[order], counts["n_links"].to_numpy()[order], counts["best"].to_numpy()[order].astype(np.int64)
    for batch in postings.to_batches():
        if not batch.num_rows:
            continue
        at = np.searchsorted(pair, (batch.column("a").to_numpy().astype(np.int64) << 32) | batch.column("b").to_numpy())
        weight = np.left_shift(1, np.maximum(batch.column("plane").to_numpy() - 1, 0).astype(np.int64))
        place, count = _places(batch.column("bits"))
        total += _sum_by(place, np.repeat(links[at] * weight, count), n)
        best += _sum_by(place, np.repeat(is_best[at] * weight, count), n)
    return pa.table({
        **{c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
        "n_best": best[slot], "count_sum": total[slot], "groups_sha256": docs["groups_sha256"]})


def return_scores(index: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document the links whose count is their B id's highest, and the sum of the counts of its links.

    The counts travel to the blocks as lean rows (a pair is once in a block at most); the bitmaps move once.
    """
    pairs = index.where("kind = 'posting' and plane = 0").select("block", "a", "b")
    known = pairs.join(counts.select("a", "b", "n_links", "best"), ["a", "b"]).select(
        F.col("block").alias("of"), F.col("a").alias("of_a"), F.col("b").alias("of_b"), "n_links", "best")
    rows = index.select("kind", "block", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "plane", "bits")
    return rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        _score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: sizes, scores against the corpus' pair counts, and the hash of its groups."""
    index = build(docs, path_a, path_b)
    return return_scores(index, pair_counts(index))
