"""Token ids of whole texts by a public vocabulary file, with each distinct piece encoded once.

The vocabulary lower-cases, and its pre-tokenizer never joins characters
across ASCII white space nor a letter or digit with an ASCII mark (a
contraction begins at its apostrophe), so the ids of a text are the ids of
its pieces, one after another. The vocabulary's added tokens
(``<|endoftext|>``) are found in the raw text before that, case included; a
text is cut at them first, and each stands for its own id. A worker
keeps the ids of the pieces it has met (up to ``KEEP_BYTES``, then it starts
afresh), and numpy gathers them; ``tests/llm`` holds this against encoding
the whole text. Pieces over ``LONG_PIECE`` bytes are not kept. Text without
ASCII white space or marks is one piece; such a piece is encoded in parts of
about ``PART_CHARS``, cut behind a letter or digit and before a digit, mark
or symbol, where the pre-tokenizer ends a word too. A run of letters alone
is one word of the vocabulary and is encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import worker_cache
from .words import Words, words

KEEP_BYTES = 64 << 20
LONG_PIECE = 512
PART_CHARS = 1 << 16
END_ID = 2
WORD_BPE = "word_bpe_49k.json"


def vocabulary(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError(f"{path}: an added token that is not matched as plain text")
        self.added = {t.content: k for k, t in added.items()}
        # at one place the longest wins
        self.added_at = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def _long_piece(self, text: str) -> np.ndarray:
        """Ids of a piece that is not kept."""
        import regex

        parts, at = [], 0
        while len(text) - at > PART_CHARS:
            cut = regex.compile(r"(?<=[\p{L}\p{N}])(?=[\p{N}\p{P}\p{S}])").search(text, at + PART_CHARS)
            if cut is None:
                break
            parts.append(text[at:cut.start()])
            at = cut.start()
        parts.append(text[at:])
        return np.concatenate([np.array(self.tokenizer.encode_batch_fast([p], add_special_tokens=False)[0].ids, np.int32) for p in parts])

    def _learn(self, w: Words, keys: np.ndarray, where: np.ndarray) -> None:
        found = self.tokenizer.encode_batch_fast([w.word(i).decode("utf-8", "replace") for i in where], add_special_tokens=False)
        got = [e.ids for e in found]
        n = np.fromiter(map(len, got), np.int64, len(got))
        total = int(n.sum())
        if self.used + total > len(self.ids):
            grown = np.zeros(2 * (self.used + total), np.int32)
            grown[:self.used] = self.ids[:self.used]
            self.ids = grown
        self.ids[self.used:self.used + total] = np.fromiter((x for g in got for x in g), np.int32, total)
        at = self.used + np.cumsum(n) - n
        self.used += total
        put = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.n = (np.insert(a, put, b) for a, b in ((self.keys, keys), (self.at, at), (self.n, n)))

    def parts(self, column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """``column`` cut at the added tokens: the texts between them, their rows, and the id of the
        added token before each (-1: the row begins there)."""
        held = np.zeros(len(column), bool)
        for content in self.added:
            held |= pc.fill_null(pc.match_substring(column, content), False).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(held)
        if not len(at):
            return column, np.arange(len(column)), np.full(len(column), -1, np.int32)
        out, rows, before, last = [], [], [], 0
        for k in [*at.tolist(), len(column)]:
            out.append(column.slice(last, k - last))
            rows.append(np.arange(last, k))
            before.append(np.full(k - last, -1, np.int32))
            if k < len(column):
                cut = self.added_at.split(column[k].as_py())
                out.append(pa.array(cut[::2], column.type))
                rows.append(np.full(len(cut[::2]), k))
                before.append(np.array([-1, *(self.added[x] for x in cut[1::2])], np.int32))
            last = k + 1
        return pa.concat_arrays(out), np.concatenate(rows), np.concatenate(before)

    def encode(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and the number of ids of each text (part) of ``w``."""
        if not len(w.hash):
            return np.zeros(0, np.int32), np.zeros(len(w.count), np.int64)
        keys, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
        long = w.length[first] > LONG_PIECE
        if 20 * (len(self.keys) + len(keys)) + 4 * self.used > KEEP_BYTES:
            self.clear()
        n, begin = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        pool = self.ids
        short = np.flatnonzero(~long)
        if len(short):
            at = np.searchsorted(self.keys, keys[short])
            new = np.ones(len(short), bool)
            if len(self.keys):
                new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys[short]
            if new.any():
                self._learn(w, keys[short][new], first[short][new])
                at = np.searchsorted(self.keys, keys[short])
            n[short], begin[short], pool = self.n[at], self.at[at], self.ids
        if long.any():
            parts = [self._long_piece(w.word(i).decode("utf-8", "replace")) for i in first[long]]
            size = np.array([len(p) for p in parts])
            n[long], begin[long] = size, self.used + np.cumsum(size) - size
            pool = np.concatenate([self.ids[:self.used], *parts])
        n, begin = n[back], begin[back]
        end = np.cumsum(n)
        ids = pool[np.arange(int(end[-1])) + np.repeat(begin - (end - n), n)]
        ends = np.concatenate(([0], end))[np.concatenate(([0], np.cumsum(w.count)))]
        return ids, np.diff(ends)


def encoder(path: str) -> Encoder:
    mine = worker_cache("tokens")
    if path not in mine:
        mine[path] = Encoder(path)
    return mine[path]


def encode(column: pa.Array, path: str, end_id: int | None = END_ID) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of every text of ``column``, null as empty, ``end_id`` appended."""
    enc = encoder(path)
    tail = np.array([] if end_id is None else [end_id], np.int32)
    parts, rows, before = enc.parts(column)
    row, part, held = -1, -1, []
    for w in words(parts, lower=True, pieces=True):
        ids, n = enc.encode(w)
        at = 0
        for k, m in enumerate(n.tolist(), w.row):
            if rows[k] != row:
                if held:
                    yield row, np.concatenate([*held, tail])
                row, held = int(rows[k]), []
            if k != part and before[k] >= 0:
                held.append(before[k:k + 1])
            part = k
            held.append(ids[at:at + m])
            at += m
    if held:
        yield row, np.concatenate([*held, tail])
