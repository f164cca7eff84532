"""Periodic runs of words by online dyadic square catching.

A run is a stretch of consecutive words with smallest period q, at least
``max(least, 2 * q)`` words long, that no neighbouring word extends. It is a
merge of squares ``uu`` with ``|u| = q`` that begin at consecutive words.

Words are appended to a growing sequence. Every completed block of 2^k
words at a multiple of 2^k is a catcher: it answers for the squares with
``2^(k+1) - 1 <= q <= 2^(k+2) - 2``, because the left half of such a square
holds a whole block of that size, and so does every stretch of words that
equal the word q later. Each appended word completes one suffix per block
size; a suffix that equals a catcher at a distance the catcher answers for
starts a comparison, which is carried to the left at once and to the right
with every further word. A comparison over q words or more is a square, and
its squares merge into one run (start, end, q). Periods up to ``SHORT`` have
catchers of one word: each word is compared with the word q before it.
Appending is vectorised over the appended words, so a slice costs a few
sorts and searches per block size, and only suffixes that equal some block
of half the size are looked at for the next size. A suffix that lies with
its catcher in a run of period at most the block size is passed over: it can
only repeat that run with a multiple of its period.

Blocks are compared by prefix hashes modulo two primes; every run is checked
word by word in the end, and another base is taken should one differ.

Texts: a null text has no words and no run. Texts that repeat, null or
repeated ids and further columns pass through; an empty table gives no rows.
Memory follows the longest text (some 60 bytes a word). In ``report`` a null
``doc_id`` has no decimal form, so its words stay as they are.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import workers_import

LEAST = 12
SHORT = 14  # periods with catchers of one word; larger ones begin with blocks of 8
FIRST = 3
SLICE = 400_000  # words appended at once
PAIRS = 4_000_000  # suffixes compared at once
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = ((1_234_567_891, 987_654_323), (1_500_450_271, 1_111_111_147), (1_073_676_287, 1_999_999_973))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Catchers:
    """Runs of a growing sequence of word numbers (``append``, then ``runs``).

    Several texts may share a sequence: a number that occurs once only
    (``wall``) between them belongs to no run.
    """

    def __init__(self, least: int = LEAST, seed: int = 0):
        self.least, self.seed, self.n = least, seed, 0
        self.words = np.zeros(1024, np.int64)
        self.text = np.zeros(1024, np.uint64)
        self.power = [np.ones(1, np.uint64) for _ in PRIMES]
        self.prefix = [np.zeros(1025, np.uint64) for _ in PRIMES]
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # start, end, period
        self.open = (np.zeros(0, np.int64), np.zeros(0, np.int64))  # start, period of comparisons that reach the last word

    def append(self, words: np.ndarray, texts: np.ndarray | None = None) -> None:
        """``texts``: a number per word; blocks are compared only where it is the same."""
        before = self.n
        self._store(words, texts)
        self._advance(before)
        for q in range(1, min(SHORT, self.n - 1) + 1):
            self._short(q, before)
        self._blocks(before)
        self.found = [self._merged()]

    def runs(self) -> np.ndarray:
        """Rows (start, end, period) by start, then period; ends are exclusive."""
        s, e, q = self._merged()
        order = np.lexsort((q, e, s))
        s, e, q = s[order], e[order], q[order]
        smallest = np.ones(len(s), bool)
        smallest[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
        out = np.stack([s, e, q], 1)[smallest]
        w = self.words[:self.n]
        for a, b, p in out.tolist():
            if not np.array_equal(w[a:b - p], w[a + p:b]) or (a and w[a - 1] == w[a - 1 + p]) or (b < self.n and w[b] == w[b - p]):
                again = Catchers(self.least, self.seed + 1)  # two unequal blocks shared a hash
                again.append(w, self.text[:self.n])
                return again.runs()
        return out[np.lexsort((out[:, 2], out[:, 0]))]

    def _store(self, words: np.ndarray, texts: np.ndarray | None) -> None:
        n = self.n + len(words)
        if n > len(self.words):
            room = max(n, 2 * len(self.words))
            self.words = np.concatenate([self.words[:self.n], np.zeros(room - self.n, np.int64)])
            self.text = np.concatenate([self.text[:self.n], np.zeros(room - self.n, np.uint64)])
            self.prefix = [np.concatenate([h[:self.n + 1], np.zeros(room - self.n, np.uint64)]) for h in self.prefix]
        self.words[self.n:n] = words
        self.text[self.n:n] = 0 if texts is None else texts
        value = _scramble(words.astype(np.uint64) + np.uint64(1))
        for j, p in enumerate(PRIMES):
            p64 = np.uint64(p)
            while len(self.power[j]) <= n:
                step = self.power[j][-1] * np.uint64(BASES[self.seed][j]) % p64
                self.power[j] = np.concatenate([self.power[j], self.power[j] * step % p64])
            terms = (value % p64) * self.power[j][self.n:n] % p64
            self.prefix[j][self.n + 1:n + 1] = (self.prefix[j][self.n] + np.cumsum(terms)) % p64
        self.n = n

    def _key(self, at: np.ndarray, size: int) -> np.ndarray:
        """62 bits of hash of the blocks of ``size`` words at ``at``, and of their texts."""
        key = np.zeros(len(at), np.uint64)
        for j, p in enumerate(PRIMES):
            p64, h = np.uint64(p), self.prefix[j]
            key = (key << np.uint64(31)) | ((h[at + size] + p64 - h[at]) % p64 * self.power[j][self.n - at] % p64)
        return key ^ (_scramble(self.text[at]) >> np.uint64(2))

    def _equal(self, at: np.ndarray, q: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the blocks at ``at`` and ``at + q`` are equal."""
        same = np.ones(len(at), bool)
        for j, p in enumerate(PRIMES):
            p64, h = np.uint64(p), self.prefix[j]
            here = (h[at + size] + p64 - h[at]) % p64 * self.power[j][q] % p64
            same &= here == (h[at + q + size] + p64 - h[at + q]) % p64
        return same

    def _carry(self, at: np.ndarray, q: np.ndarray, left: bool) -> np.ndarray:
        """How many words in a row from ``at`` on (before ``at``) equal the word ``q`` later."""
        limit = at if left else self.n - q - at
        out = np.zeros(len(at), np.int64)
        step = 1 << max(0, int(limit.max(initial=0)).bit_length() - 1)
        while step:
            far = np.flatnonzero(out + step <= limit)
            if len(far):
                begin = at[far] - out[far] - step if left else at[far] + out[far]
                good = far[self._equal(begin, q[far], np.full(len(far), step))]
                out[good] += step
            step >>= 1
        return out

    def _report(self, start: np.ndarray, stop: np.ndarray, q: np.ndarray) -> None:
        """Comparisons over the words ``start`` to ``stop``; those over q words are runs."""
        square = (stop - start >= q) & (stop - start + q >= self.least)
        self.found.append((start[square], stop[square] + q[square], q[square]))

    def _advance(self, before: int) -> None:
        start, q = self.open
        if len(start):
            stop = before - q + self._carry(before - q, q, False)
            self._report(start, stop, q)
            still = stop + q == self.n
            self.open = start[still], q[still]

    def _short(self, q: int, before: int) -> None:
        need = max(self.least - q, q)
        low = max(0, before - q - need)
        hit = np.flatnonzero(self.words[low:self.n - q] == self.words[low + q:self.n])
        if len(hit) < need:
            return
        first = np.flatnonzero(np.concatenate(([True], np.diff(hit) != 1)))
        last = np.append(first[1:], len(hit)) - 1
        long = hit[last] - hit[first] + 1 >= need
        start, stop = hit[first[long]] + low, hit[last[long]] + low + 1
        if len(start):
            period = np.full(len(start), q)
            if low and start[0] == low:
                start[:1] -= self._carry(start[:1], period[:1], True)
            self._report(start, stop, period)

    def _merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs found so far, each with its largest end."""
        if not self.found:
            none = np.zeros(0, np.int64)
            return none, none, none
        s, e, q = (np.concatenate(c) for c in zip(*self.found, strict=True))
        order = np.lexsort((-e, q, s))
        s, e, q = s[order], e[order], q[order]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != s[:-1]) | (q[1:] != q[:-1])
        return s[keep], e[keep], q[keep]

    def _blocks(self, before: int) -> None:
        size = 1 << FIRST
        suffix = np.arange(max(0, before - size + 1), max(0, self.n - size + 1))
        catcher = np.arange(0, max(0, self.n - size + 1), size)
        while 2 * size - 1 <= self.n and len(suffix) and len(catcher):
            low, high = 2 * size - 1, 4 * size - 2
            key = self._key(catcher, size)
            order = np.lexsort((catcher, key))
            catcher, key = catcher[order], key[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            names = key[first]
            mine = self._key(suffix, size)
            name = np.minimum(np.searchsorted(names, mine), len(names) - 1)
            known = (names[name] == mine) & (catcher[first[name]] < suffix)
            suffix, name = suffix[known], name[known]
            if not len(suffix) and not before:
                break
            span = self.n + 1
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(catcher))))
            place = of * span + catcher
            lo = np.searchsorted(place, name * span + np.maximum(suffix - high, 0))
            end = np.minimum(suffix - low, self._covered(suffix + size, size) - 1)
            hi = np.searchsorted(place, name * span + np.maximum(end, -1), side="right")
            self._compare(suffix, catcher, lo, np.maximum(hi, lo), size)
            # the next size: blocks whose first half was met again, suffixes whose first half met a block
            if not before:
                again = np.zeros(len(first), bool)
                again[name] = True
                catcher = np.sort(catcher[again[of]])
            size *= 2
            catcher = np.sort(catcher[(catcher % size == 0) & (catcher + size <= self.n)])
            suffix = suffix[suffix + size <= self.n]
            if before:  # suffixes whose first half ended before this append
                older = np.arange(max(0, before - size + 1), max(0, before - size // 2 + 1))
                suffix = np.union1d(older[older + size <= self.n], suffix)

    def _covered(self, stop: np.ndarray, size: int) -> np.ndarray:
        """The first start of the runs of period at most ``size`` that reach ``stop``."""
        s, e, q = self._merged()
        s, e = s[q <= size], e[q <= size]
        order = np.argsort(e)
        s, e = s[order], e[order]
        least = np.append(np.minimum.accumulate(s[::-1])[::-1], self.n + 1)
        return least[np.searchsorted(e, stop)]

    def _compare(self, suffix: np.ndarray, catcher: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: int) -> None:
        some = np.flatnonzero(hi > lo)
        suffix, lo, count = suffix[some], lo[some], (hi - lo)[some]
        at = 0
        total = np.cumsum(count)
        while at < len(suffix):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
            n = count[at:to]
            nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            b = catcher[np.repeat(lo[at:to], n) + nth]
            q = np.repeat(suffix[at:to], n) - b
            at = to
            order = np.lexsort((b, q))  # catchers side by side that met the same distance are one comparison
            b, q = b[order], q[order]
            new = np.flatnonzero(np.concatenate(([True], (q[1:] != q[:-1]) | (b[1:] - b[:-1] != size))))
            last = np.append(new[1:], len(b)) - 1
            q, begin, end = q[new], b[new], b[last] + size
            start = begin - self._carry(begin, q, True)
            stop = end + self._carry(end, q, False)
            self._report(start, stop, q)
            reach = stop + q == self.n
            if reach.any():
                both = np.unique(np.stack([np.append(self.open[0], start[reach]), np.append(self.open[1], q[reach])]), axis=1)
                self.open = both[0], both[1]


def word_runs(words: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one list of words."""
    number: dict = {}
    c = Catchers(least)
    c.append(np.array([number.setdefault(w, len(number)) for w in words], np.int64))
    return [(s, e - s, q) for s, e, q in c.runs().tolist()]


def _words(data: bytes) -> Iterator[list[bytes]]:
    if len(data) <= 1 << 23:
        yield data.split()  # bytes.split() parts at \x20 and \x09-\x0D
    else:
        yield from (list(map(re.Match.group, part)) for part in batched(_WORD.finditer(data), SLICE))


def plant(doc_id: int | None, words: np.ndarray) -> np.ndarray:
    """``words`` with a periodic end, for about one document in ten by the checksum of its id."""
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return words[np.where(i >= a, a + (i - a) % p, i)]


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words a run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    return np.cumsum(edge[:n]) > 0


def _texts(batches: Iterator[pa.RecordBatch], least: int, planted: bool):
    """(batch, row, numbers of its words, words by number, rows (start, end, period)) of every row in order."""
    for batch in batches:
        column = batch.column(1).cast(pa.binary())
        held, vocabulary, size, first = [], {}, 0, 0
        for k in range(batch.num_rows):
            data = column[k].as_py() or b""
            ids = [np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in part), np.int64, len(part)) for part in _words(data)]
            ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            held.append(plant(batch.column(0)[k].as_py(), ids) if planted else ids)
            size += len(ids)
            if size >= SLICE or k == batch.num_rows - 1:
                words = list(vocabulary)
                for j, (ids, runs) in enumerate(zip(held, _runs(held, len(words), least), strict=True)):
                    yield batch, first + j, ids, words, runs
                held, vocabulary, size, first = [], {}, 0, k + 1


def _runs(texts: list[np.ndarray], walls: int, least: int) -> Iterator[np.ndarray]:
    """Runs of each text; numbers from ``walls`` on part the texts in one sequence."""
    parts = [x for k, t in enumerate(texts) for x in (t, np.array([walls + k]))]
    sequence = np.concatenate(parts)
    size = np.array([len(t) + 1 for t in texts])
    of = np.repeat(np.arange(len(texts), dtype=np.uint64), size)
    c = Catchers(least)
    step = len(sequence) if len(sequence) <= 2 * SLICE else SLICE
    for at in range(0, len(sequence), step):
        c.append(sequence[at:at + step], of[at:at + step])
    runs = c.runs()
    begin = np.cumsum(size) - size
    at = np.searchsorted(runs[:, 0], np.append(begin, len(sequence)))
    for k, b in enumerate(begin.tolist()):
        yield runs[at[k]:at[k + 1]] - np.array([b, b, 0])


def _join(ids: np.ndarray, words: list[bytes]) -> Iterator[bytes]:
    for at in range(0, len(ids), SLICE):
        yield (b" " if at else b"") + b" ".join([words[i] for i in ids[at:at + SLICE].tolist()])


def _column(docs: DataFrame, text: str) -> DataFrame:
    workers_import(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def find_runs(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per run: doc_id, start, length, period (word numbers from 0)."""

    def find(batches):
        for batch, k, _, _, runs in _texts(batches, least, False):
            if len(runs):
                ids = pa.array([batch.column(0)[k].as_py()] * len(runs), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(runs[:, 0]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], names=["doc_id", "start", "length", "period"])

    return _column(docs, text).mapInArrow(find, "doc_id long, start long, length long, period long")


def collapse(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with each run cut to its first period and the kept words joined by one space (null stays null)."""
    workers_import(docs.sparkSession)
    fields = docs.schema.fields
    at = [f.name for f in fields].index(text)
    names = [f"c{i}" for i in range(len(fields))]

    def cut(batches):
        for batch in batches:
            column = batch.column(at)
            pair = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), column], names=["doc_id", "text"])
            out = [None if not column[k].is_valid else b"".join(_join(ids[~dropped(len(ids), runs)], words)).decode() for _, k, ids, words, runs in _texts(iter([pair]), least, False)]
            yield pa.RecordBatch.from_arrays([c if i != at else pa.array(out, pa.string()) for i, c in enumerate(batch.columns)], names=names)

    plain = T.StructType([T.StructField(n, T.StringType() if i == at else f.dataType, True) for i, (n, f) in enumerate(zip(names, fields, strict=True))])
    return docs.toDF(*names).mapInArrow(cut, plain).toDF(*[f.name for f in fields])


REPORT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def report(docs: DataFrame, text: str = "text", least: int = LEAST, planted: bool = True) -> DataFrame:
    """Per row of ``docs``: ``REPORT``, of its words with :func:`plant` applied."""

    def digest(batches):
        rows, columns = [], [c.split() for c in REPORT.split(", ")]
        names, types = [c[0] for c in columns], [pa.int64() if c[1] == "long" else pa.string() for c in columns]

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch, k, ids, words, runs in _texts(batches, least, planted):
            text_hash = hashlib.sha256()
            for part in _join(ids[~dropped(len(ids), runs)] if len(runs) else ids, words):
                text_hash.update(part)
            lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs.tolist())
            longest = [None] * 4
            if len(runs):
                length = runs[:, 1] - runs[:, 0]
                i = int(np.argmax(length))  # rows are by start, then period: the first is the tie's winner
                longest = [int(runs[i, 0]), int(length[i]), int(runs[i, 2]), int(1000 * length[i] // runs[i, 2])]
            rows.append([batch.column(0)[k].as_py(), len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), text_hash.hexdigest()])
            if len(rows) == 5000:
                yield out()
                rows = []
        if rows:
            yield out()

    return _column(docs, text).mapInArrow(digest, REPORT)
