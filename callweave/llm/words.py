"""Vectorised word splitting over Arrow string columns.

Words are the maximal runs of bytes other than space and ``\\x09-\\x0D``.
Work runs over slices of at most ``SLICE`` bytes, cut only between words (or
pieces), so memory does not follow the length of a text or of an Arrow
batch. A single word longer than that is hashed in slices too and comes by
itself; its bytes are a view of the text's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[33:127] = True
_MARK &= ~_ALNUM
_MARK_CUT = _MARK.copy()
_MARK_CUT[39] = False  # an apostrophe may begin a contraction


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_powers = np.ones(1, dtype=np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 4096), _BASE, dtype=np.uint64)
        more[0] = 1
        _powers = np.multiply.accumulate(more)
    return _powers


@dataclass
class Words:
    """Words of some texts: ``hash[i]`` is a 64-bit hash of ``data[start[i]:start[i]+length[i]]``;
    text ``row + k`` owns the next ``count[k]`` words. A long text may come in several parts."""

    row: int
    count: np.ndarray
    hash: np.ndarray
    data: np.ndarray
    start: np.ndarray
    length: np.ndarray

    def word(self, i: int) -> bytes:
        s = self.start[i]
        return self.data[s:s + self.length[i]].tobytes()


def _marks(data: np.ndarray) -> np.ndarray:
    """Where byte i begins a piece: ASCII letter, digit or Latin-1 letter before an ASCII mark, or a
    mark other than an apostrophe before an ASCII letter or digit."""
    alnum, cut = _ALNUM[data], np.zeros(len(data), dtype=bool)
    mark = _MARK[data]
    if len(data) > 1:
        cut[1:] = (alnum[:-1] & mark[1:]) | (_MARK_CUT[data[:-1]] & alnum[1:])
    if len(data) > 2:
        latin = (data[:-2] == 0xC3) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
        cut[2:] |= latin & mark[2:]
    return cut


def _split(row: int, data: np.ndarray, offsets: np.ndarray, pieces: bool = False) -> Words:
    inside = ~_SPACE[data]
    if not inside.any():
        none = np.zeros(0, dtype=np.int64)
        return Words(row, np.zeros(len(offsets) - 1, dtype=np.int64), none.astype(np.uint64), data, none, none)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    if pieces:
        edge[:-1] |= _marks(data)
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    length = np.flatnonzero(inside & (~after | edge[1:])) + 1 - start
    packed = np.cumsum(length) - length
    place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(packed, length)
    terms = _BYTE[data[inside]] * _power(int(length.max()))[place]
    hashed = mix(np.add.reduceat(terms, packed) ^ (length.astype(np.uint64) << np.uint64(48)))
    return Words(row, np.diff(np.searchsorted(start, offsets)), hashed, data, start, length)


def _hash(data: np.ndarray) -> np.uint64:
    """The hash of one word, slice by slice."""
    total = 0
    for at in range(0, len(data), SLICE):
        part = data[at:at + SLICE]
        total += pow(_BASE, at, 1 << 64) * int((_BYTE[part] * _power(len(part))[:len(part)]).sum())
    return mix(np.array([(total ^ (len(data) << 48)) & ((1 << 64) - 1)], np.uint64))[0]


def _next_cut(data: np.ndarray, at: int, pieces: bool) -> int:
    """Where the word (or piece) ends that fills the slice before ``at``."""
    while at < len(data):
        part = data[max(0, at - 2):at + SLICE]
        ends = _SPACE[part]
        if pieces:
            ends = ends | _marks(part)
        found = np.flatnonzero(ends[min(at, 2):])
        if len(found):
            return at + int(found[0])
        at += SLICE
    return len(data)


def _long(row: int, data: np.ndarray, pieces: bool) -> Iterator[Words]:
    """One text over SLICE bytes, cut where words or pieces end."""
    at = 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        if end < len(data):
            part = data[at:end]
            gaps = np.flatnonzero(_SPACE[part])
            if not len(gaps) and pieces:
                gaps = np.flatnonzero(_marks(part)) - 1  # the cut is before the byte that begins a piece
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                end = _next_cut(data, end, pieces)
                word = data[at:end]
                yield Words(row, np.ones(1, np.int64), np.array([_hash(word)], np.uint64), word, np.zeros(1, np.int64), np.array([len(word)]))
                at = end
                continue
        yield _split(row, data[at:end], np.array([0, end - at]), pieces)
        at = end


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is an empty text."""
    if pa.types.is_large_string(column.type) or not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def words(column: pa.Array, lower: bool = False, pieces: bool = False, size: int = SLICE) -> Iterator[Words]:
    """Words of every text of ``column`` in order. ``lower`` maps A-Z to a-z first; ``pieces`` also
    cuts between letters or digits and ASCII marks. Texts go together up to about ``size`` bytes."""
    data, at = buffers(column)
    if lower and len(data):
        data = _LOWER[data]
    row, n = 0, len(at) - 1
    while row < n:
        if at[row + 1] - at[row] > SLICE:
            yield from _long(row, data[at[row]:at[row + 1]], pieces)
            row += 1
            continue
        end = int(np.searchsorted(at, at[row] + size, side="right")) - 1
        end = max(row + 1, min(end, n))
        part = data[at[row]:at[end]]
        if len(part):
            yield _split(row, part, at[row:end + 1] - at[row], pieces)
        else:
            none = np.zeros(0, dtype=np.int64)
            yield Words(row, np.zeros(end - row, dtype=np.int64), none.astype(np.uint64), part, none, none)
        row = end


def texts(column: pa.Array, lower: bool = False, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, words per text, word hashes) with the parts of a long text joined."""
    row, held = -1, []
    for w in words(column, lower, size=size):
        if held and (len(w.count) != 1 or w.row != row):
            h = np.concatenate(held)
            yield row, np.array([len(h)]), h
            held = []
        if len(w.count) == 1:
            row = w.row
            held.append(w.hash)
        else:
            yield w.row, w.count, w.hash
    if held:
        h = np.concatenate(held)
        yield row, np.array([len(h)]), h
