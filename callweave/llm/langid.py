"""Language ID by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary file; a language gives
each piece a probability. The score of a word is the sum, over all ways to
cut it into pieces, of the product of their probabilities (forward
algorithm); a text is the product over its words, and the prediction is the
posterior under equal priors. Words are the runs of letters, lower-cased,
each behind the vocabulary's word mark; a letter that no piece holds counts
``UNKNOWN``.

The probabilities are fitted by expectation-maximisation from a uniform
start, over word counts of at most about ``FIT_DOCS`` labelled documents per
language, chosen by a hash of ``doc_id`` (a documented bound of the fit
alone; prediction reads every text whole). The expected counts of each round
come from a forward-backward pass over the word table in Spark; what reaches
the driver is one number per piece and language.

Prediction: null texts, texts without letters and models without a language
give ``und`` with score 0; ties go to the smaller language name. Null
``lang`` is never learned from; a null ``doc_id`` counts as the empty string
in its hash. Repeated rows and further columns pass through unchanged.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.session import materialize

from .common import give_back, small_batches, worker_cache, workers_import
from .jaccard import id_filter, in_filter
from .words import words

VOCABULARY = "piece_bpe_32k.model"
FIT_DOCS = 2000
ROUNDS = 3
UNKNOWN = 1e-9
SMOOTH = 0.05
KEEP = 300_000
LONG_RUN = 4096
LONG_TOGETHER = 64
TOGETHER = 4096
UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_MARK = "▁"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(path: str) -> dict[str, int]:
    """Lower-case pieces of letters (with or without the word mark) and their numbers."""
    kept = worker_cache("langid")
    if ("pieces", path) not in kept:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = sorted({p for p in map(model.id_to_piece, range(model.get_piece_size())) if (x := p.removeprefix(_MARK)).isalpha() and x == x.lower()} | {_MARK})
        kept["pieces", path] = {p: k for k, p in enumerate(names)}
    return kept["pieces", path]


def letter_runs(text: str) -> list[str]:
    runs = (x if x.isalpha() else "".join(c for c in x if c.isalpha()) for x in _LETTERS.findall(text))
    return [x.lower() for x in runs if x]


def beginnings(known: dict[str, int], path: str | None = None) -> tuple[frozenset[str], int]:
    """All beginnings of the pieces, and the length of the longest; kept by ``path``."""
    kept = worker_cache("langid") if path is not None else {}
    if ("starts", path) not in kept:
        kept["starts", path] = frozenset(p[:i] for p in known for i in range(1, len(p) + 1)), max(map(len, known), default=1)
    return kept["starts", path]


def _hits(marked: str, known: dict[str, int], begins: frozenset[str]) -> list[list[tuple[int, int]]]:
    """For each end in the marked word: start and number of the pieces that end there (-1: unknown letter)."""
    n = len(marked)
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for start in range(n):
        k = known.get(marked[start])
        out[start].append((start, -1 if k is None else k))
        end = start + 1
        while end <= n and (x := marked[start:end]) in begins:
            if end > start + 1 and (k := known.get(x)) is not None:
                out[end - 1].append((start, k))
            end += 1
    return out


def forward(word: str, known: dict[str, int], prob: list[list[float]], path: str | None = None) -> list[float]:
    """Log of the sum over all segmentations, per language. ``prob``: a row per piece, a column per language, last row for unknown letters."""
    begins, longest = beginnings(known, path)
    if len(word) > LONG_RUN:
        return _forward_ahead(word, known, prob, begins, longest)
    each = range(len(prob[-1]))
    alpha, shift = [[1.0] * len(each)], [0.0] * len(each)
    for hits in _hits(_MARK + word, known, begins):
        a = [0.0] * len(each)
        for start, k in hits:
            row, before = prob[k], alpha[start]
            for j in each:
                a[j] += before[j] * row[j]
        alpha.append(a)
        if min(a, default=1.0) < 1e-150:  # keep the values that are still needed in range
            for j in each:
                scale = max(a[j], 1e-300)
                shift[j] += math.log(scale)
                for x in alpha[-longest - 1:]:
                    x[j] /= scale
    return [math.log(max(x, 1e-300)) + y for x, y in zip(alpha[-1], shift, strict=True)]


def _forward_ahead(word: str, known: dict[str, int], prob: list[list[float]], begins: frozenset[str], longest: int) -> list[float]:
    """The same with only the sums that pieces can still reach held, for runs of any length."""
    marked, each = _MARK + word, range(len(prob[-1]))
    ahead = deque([[1.0] * len(each)] + [[0.0] * len(each) for _ in range(longest)])
    shift, n = [0.0] * len(each), len(_MARK) + len(word)
    for start in range(n):
        now = ahead.popleft()
        ahead.append([0.0] * len(each))
        low = min(now, default=1.0)
        if low < 1e-150:
            for j in each:
                scale = max(now[j], 1e-300)
                shift[j] += math.log(scale)
                now[j] /= scale
                for x in ahead:
                    x[j] /= scale
        k, end = known.get(marked[start]), start + 1
        row, into = prob[-1 if k is None else k], ahead[0]
        for j in each:
            into[j] += now[j] * row[j]
        while end <= n and (x := marked[start:end]) in begins:
            if end > start + 1 and (k := known.get(x)) is not None:
                row, into = prob[k], ahead[end - start - 1]
                for j in each:
                    into[j] += now[j] * row[j]
            end += 1
    return [math.log(max(x, 1e-300)) + y for x, y in zip(ahead[0], shift, strict=True)]


class Trie:
    """The pieces letter by letter: what node a letter leads to from another, and the piece that ends there (-1: none)."""

    def __init__(self, known: dict[str, int]):
        nodes, piece, steps = {"": 0}, [-1], []
        letters = {c: i for i, c in enumerate(sorted({c for p in known for c in p}))}
        for p, k in known.items():
            for i in range(1, len(p) + 1):
                if p[:i] not in nodes:
                    steps.append((nodes[p[:i - 1]] * len(letters) + letters[p[i - 1]], len(piece)))
                    nodes[p[:i]] = len(piece)
                    piece.append(-1)
            piece[nodes[p]] = k
        steps.sort()
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        self.piece = np.array(piece, np.int64)
        self.step, self.to = np.array([x[0] for x in steps], np.int64), np.array([x[1] for x in steps], np.int64)

    def codes(self, letters: np.ndarray) -> np.ndarray:
        """Numbers of the letters, -1 where no piece holds one."""
        at = np.minimum(np.searchsorted(self.letters, letters), len(self.letters) - 1)
        return np.where(self.letters[at] == letters, at, -1)

    def follow(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The nodes that the letters lead to, -1 where there is none."""
        key = node * len(self.letters) + code
        at = np.minimum(np.searchsorted(self.step, key), len(self.step) - 1)
        return np.where((self.step[at] == key) & (code >= 0), self.to[at], -1)


def trie(known: dict[str, int], path: str | None = None) -> Trie:
    """Kept by ``path``."""
    kept = worker_cache("langid") if path is not None else {}
    if ("trie", path) not in kept:
        kept["trie", path] = Trie(known)
    return kept["trie", path]


def forward_many(runs: list[str], known: dict[str, int], prob: np.ndarray, path: str | None = None) -> np.ndarray:
    """:func:`forward` of each run, a row each: the same sums in the same order, over ``TOGETHER`` runs at
    a time. Long runs and those whose sums leave the range of a float go one by one."""
    out, tree, plain = np.zeros((len(runs), prob.shape[1])), trie(known, path), None
    size = np.array([len(x) for x in runs], np.int64)
    by_size = np.argsort(-size, kind="stable")
    alone = by_size[size[by_size] > LONG_TOGETHER].tolist()
    for low in range(len(alone), len(runs), TOGETHER):
        some = by_size[low:low + TOGETHER]  # longest first: the runs that go on are the first ones
        n = size[some] + len(_MARK)
        codes = np.full((len(some), int(n[0])), -1)
        codes[np.arange(codes.shape[1]) < n[:, None]] = tree.codes(np.frombuffer("".join([_MARK + runs[i] for i in some]).encode("utf-32-le"), np.uint32))
        alpha = np.zeros((codes.shape[1] + 1, *out[some].shape))
        alpha[0] = 1.0
        for start in range(codes.shape[1]):
            on = int(np.searchsorted(-n, -start, side="left"))  # runs longer than ``start``
            now = alpha[start, :on]
            node = tree.follow(np.zeros(on, np.int64), codes[:on, start])
            k = np.where(node >= 0, tree.piece[node], -1)
            alpha[start + 1, :on] += now * prob[k]
            at, end = np.flatnonzero((node >= 0) & (n[:on] > start + 1)), start + 1
            node = node[at]
            while len(at):
                node = tree.follow(node, codes[at, end])
                at, node, end = at[node >= 0], node[node >= 0], end + 1
                k = tree.piece[node]
                hit = k >= 0
                alpha[end, at[hit]] += now[at[hit]] * prob[k[hit]]
                goes_on = n[at] > end
                at, node = at[goes_on], node[goes_on]
        small = (alpha.min(axis=2) < 1e-150) & (np.arange(len(alpha))[:, None] <= n)
        alone += some[small.any(axis=0)].tolist()
        last = alpha[n, np.arange(len(some))]
        out[some] = np.array([math.log(max(x, 1e-300)) for x in last.ravel().tolist()]).reshape(last.shape)
    if alone:
        plain = prob.tolist()
    for i in alone:
        out[i] = forward(runs[i], known, plain, path)
    return out


def expected(word: str, known: dict[str, int], prob: list[float] | np.ndarray, path: str | None = None) -> dict[int, float]:
    """Expected number of each piece over all segmentations of ``word`` for one language."""
    ends = _hits(_MARK + word, known, beginnings(known, path)[0])
    alpha, beta = [1.0] + [0.0] * len(ends), [0.0] * len(ends) + [1.0]
    for end, hits in enumerate(ends, 1):
        alpha[end] = sum([alpha[s] * prob[k] for s, k in hits])
    if alpha[-1] < 1e-250:
        return _expected_in_logs(ends, prob)
    for end in range(len(ends), 0, -1):
        after = beta[end] / alpha[-1] if end == len(ends) else beta[end]
        for s, k in ends[end - 1]:
            beta[s] += prob[k] * after
    beta[-1] /= alpha[-1]
    out: dict[int, float] = {}
    for end, hits in enumerate(ends, 1):
        for s, k in hits:
            if k >= 0:
                out[k] = out.get(k, 0.0) + alpha[s] * prob[k] * beta[end]
    return out


def _expected_in_logs(ends: list[list[tuple[int, int]]], prob: list[float] | np.ndarray) -> dict[int, float]:
    """The same for words whose probability is too small for a float."""

    def add(x: float, y: float) -> float:
        top, low = max(x, y), min(x, y)
        return top if low == -math.inf else top + math.log1p(math.exp(low - top))

    logs = {k: math.log(prob[k]) if prob[k] > 0 else -math.inf for hits in ends for _, k in hits}
    alpha, beta = [0.0] + [-math.inf] * len(ends), [-math.inf] * len(ends) + [0.0]
    for end, hits in enumerate(ends, 1):
        for s, k in hits:
            alpha[end] = add(alpha[end], alpha[s] + logs[k])
    for end in range(len(ends), 0, -1):
        for s, k in ends[end - 1]:
            beta[s] = add(beta[s], logs[k] + beta[end])
    out: dict[int, float] = {}
    if alpha[-1] > -math.inf:
        for end, hits in enumerate(ends, 1):
            for s, k in hits:
                if k >= 0:
                    out[k] = out.get(k, 0.0) + math.exp(alpha[s] + logs[k] + beta[end] - alpha[-1])
    return out


@dataclass(frozen=True)
class Model:
    path: str
    languages: tuple[str, ...]
    prob: np.ndarray  # pieces + 1 x languages
    name: str


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _word_counts(batches):
    """(lang, word, n) of each batch."""
    for batch in batches:
        counts: dict[tuple[str, str], int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for w in letter_runs(text):
                counts[lang, w] = counts.get((lang, w), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["lang", "word", "n"])


def _expectation(path: str, prob: dict[str, np.ndarray] | None):
    def step(batches):
        known, sums = pieces(path), {}
        uniform = np.full(len(known) + 1, 1.0 / len(known))
        uniform[-1] = UNKNOWN
        start = uniform.tolist()
        plain = {lang: p.tolist() for lang, p in (prob or {}).items()}
        for batch in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                into = sums.setdefault(lang, np.zeros(len(known)))
                for k, x in expected(word, known, start if prob is None else plain[lang], path).items():
                    into[k] += n * x
        rows = [(lang, int(k), float(v[k])) for lang, v in sums.items() for k in np.flatnonzero(v)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.float64())], names=["lang", "piece", "n"])

    return step


def fit(docs: DataFrame, vocabulary_path: str | None = None, fit_docs: int = FIT_DOCS, rounds: int = ROUNDS) -> Model:
    """Fit on ``docs`` (doc_id, text, lang); the caller leaves out what must not be learned from."""
    workers_import(docs.sparkSession)
    path = vocabulary_path or vocabulary()
    known = pieces(path)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per class of the model
    if not sizes:
        return Model(path, (), np.zeros((len(known) + 1, 0)), "none")
    every = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(max(1, n // fit_docs)))])
    sample = rows.where(F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit("")), F.octet_length("text")), every[F.col("lang")]) == 0)
    counts = sample.select("lang", "text").mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "word-counts")
    tasks = max(1, -(-counts.count() // 5000))
    prob: dict[str, np.ndarray] | None = None
    for _ in range(rounds):
        n = counts.repartition(tasks, "lang", "word").mapInArrow(_expectation(path, prob), "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        prob = {lang: np.full(len(known) + 1, SMOOTH) for lang in sizes}
        for r in n.collect():  # at most pieces x languages rows
            prob[r["lang"]][r["piece"]] += r["n"]
        for p in prob.values():
            p[-1] = 0
            p /= p.sum()
            p[-1] = UNKNOWN
    languages = tuple(sorted(sizes))
    matrix = np.stack([prob[x] for x in languages], axis=1)
    return Model(path, languages, matrix, f"{path}:{hash((languages, matrix.tobytes()))}")


class Scorer:
    """Log-probabilities of the pieces of text a worker has met, at most ``KEEP``."""

    def __init__(self, model: Model):
        self.model, self.known = model, pieces(model.path)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.scores = np.zeros((0, len(self.model.languages) + 1))

    def _score(self, texts: list[str]) -> np.ndarray:
        """Per text: sum over the runs of letters, and their number."""
        runs = [letter_runs(x) for x in texts]
        number: dict[str, int] = {}
        which = np.array([number.setdefault(x, len(number)) for each in runs for x in each], np.int64)
        count = np.array([len(each) for each in runs])
        out = np.zeros((len(texts), len(self.model.languages) + 1))
        if number:
            np.add.at(out[:, :-1], np.repeat(np.arange(len(texts)), count), forward_many([*number], self.known, self.model.prob, self.model.path)[which])
        out[:, -1] = count
        return out

    def rows(self, column: pa.Array) -> np.ndarray:
        """Per text: log-probability under each language, and the number of runs."""
        total = np.zeros((len(column), len(self.model.languages) + 1))
        for w in words(column, lower=True, pieces=True):
            if not len(w.hash):
                continue
            keys, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
            if len(self.keys) + len(keys) > KEEP:
                self.clear()
            at = np.searchsorted(self.keys, keys)
            new = np.ones(len(keys), bool)
            if len(self.keys):
                new = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
            if new.any():
                got = self._score([w.word(i).decode("utf-8", "replace") for i in first[new]])
                self.keys, self.scores = np.insert(self.keys, at[new], keys[new]), np.insert(self.scores, at[new], got, axis=0)
                at = np.searchsorted(self.keys, keys)
            each = self.scores[at][back]
            texts = np.repeat(np.arange(w.row, w.row + len(w.count)), w.count)
            for j in range(each.shape[1]):
                total[:, j] += np.bincount(texts, weights=each[:, j], minlength=len(column))
        return total


def scorer(model: Model) -> Scorer:
    kept = worker_cache("langid")
    if kept.get("model") != model.name:
        kept["model"], kept["scorer"] = model.name, Scorer(model)
    return kept["scorer"]


def _predict(model: Model, text_at: int):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                langs, scores = [], []
                if model.languages:
                    for row in scorer(model).rows(batch.column(text_at)):
                        if row[-1] == 0:
                            langs.append(UNDETERMINED)
                            scores.append(0.0)
                            continue
                        best = int(np.argmax(row[:-1]))
                        langs.append(model.languages[best])
                        scores.append(1.0 / float(np.exp(np.clip(row[:-1] - row[best], -700, 0)).sum()))
                else:
                    langs, scores = [UNDETERMINED] * batch.num_rows, [0.0] * batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[f"c{i}" for i in range(batch.num_columns + 2)])
        finally:
            give_back()

    return predict


def predict(docs: DataFrame, model: Model, text: str = "text", lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """``docs`` with two columns more. Names may clash with none of the table's."""
    workers_import(docs.sparkSession)
    fields = docs.schema.fields
    names = [f.name for f in fields] + [lang_as, score_as]
    plain = T.StructType([T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(fields)] + [T.StructField(f"c{len(fields)}", T.StringType()), T.StructField(f"c{len(fields) + 1}", T.DoubleType())])
    return docs.toDF(*[f"c{i}" for i in range(len(fields))]).mapInArrow(_predict(model, [f.name for f in fields].index(text)), plain).toDF(*names)


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the rows that are not held out and predict all: doc_id, held_out, lang_pred, score."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    found = predict(docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` whose language is determined with a posterior of at least ``least``; columns unchanged.

    A verdict is of a text, so what goes is named by the texts' hashes; texts that a filter of
    fixed size takes for such are looked up. Texts are predicted in small batches, and those that
    stay are not sent to Python with their rows.
    """
    spark = docs.sparkSession
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    key = F.xxhash64(F.col("text").isNull(), F.col("text").cast("string"))
    found = predict(docs.select(key.alias("key"), F.col("text").cast("string").alias("text")), model)
    with small_batches(spark):
        gone = materialize(found.where((F.col("lang_pred") == UNDETERMINED) | ~(F.col("score") >= least)).select("key"), "unidentified").distinct()
        marks = id_filter(gone)
    own = "_own" + "_" * max((len(c) for c in docs.columns), default=0)
    keyed = docs.withColumn(own, key)
    looked_up = keyed.where(in_filter(marks, own))
    stay = looked_up.join(gone, looked_up[own] == gone["key"], "left_anti")
    return keyed.where(~in_filter(marks, own)).unionByName(stay).drop(own)
