"""Personal data: base patterns, and bootstrapped contextual extraction.

Seeds are the entities that four fixed patterns find (email, ip, card,
phone). The one and the two words before an entity, and the word after it,
are its lexical patterns. Candidates are strings of an identifier's shape
that the fixed patterns miss (numbers swallowed by a longer run, phone
numbers without a plus, written-out at signs, addresses with written-out or
bracketed dots, IPv6). Spark scores the graph of patterns and identifier values:

    confidence(p, kind) = sum of the scores of p's values of that kind / number of p's values
    score(v, kind)      = 1 - product over p of (1 - confidence(p, kind))

seeds keep score 1, values of another kind count against a pattern, and the
two lines alternate for ``ROUNDS`` rounds. A pattern takes part with at least
``SUPPORT`` distinct values that are seeds or were accepted in the round
before, so what one generation of patterns finds supports the next, and is
trusted if its confidence reaches ``CONFIDENCE``; a candidate is accepted if
its score does and a trusted pattern holds it. In the end a candidate becomes a span if
its value is a seed elsewhere, or if its score reaches ``CONFIDENCE`` and one
of its patterns is trusted. Base spans always stay; an added span never
overlaps one. Distinct (pattern, value) pairs are formed before anything is
counted, so copies of a text add nothing.

Null or empty text: no spans. Null ``doc_id`` is allowed. Repeated rows each
get the same spans. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.session import materialize

from .common import lean, small_batches, workers_import
from .jaccard import id_filter, in_filter

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 4
SUPPORT = 5
CONFIDENCE = 0.9

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[0-9][0-9./-]{5,30}[0-9](?![0-9A-Za-z])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_AT = re.compile(r"[A-Za-z0-9_%+-][A-Za-z0-9._%+-]{0,63} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}){1,4}")

_DOT = r"(?: ?[\[(]dot[\])] ?|\[\.\]|\(\.\))"
_WRITTEN_IP = re.compile(rf"(?<![0-9A-Za-z.])[0-9]{{1,3}}(?:{_DOT}|\.)[0-9]{{1,3}}(?:{_DOT}|\.)[0-9]{{1,3}}(?:{_DOT}|\.)[0-9]{{1,3}}(?![0-9A-Za-z])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")

_EDGE = "struct<kind:string,value:string,start:bigint,end:bigint,p1:string,p2:string,p3:string>"
EXTRACTED = f"doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, seeds array<{_EDGE}>, candidates array<{_EDGE}>"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(t: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their at signs so that long runs without one cost nothing."""
    out, last, at = [], 0, t.find("@")
    while at >= 0:
        begin = at
        while begin > last and t[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(t, at) if begin < at else None
        if m:
            out.append((begin, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)
        at = t.find("@", max(at + 1, last))
    return out


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """Spans of the four fixed patterns by start, then kind."""
    out = [("email", a, b) for a, b in emails(t)]
    for m in _IP.finditer(t):
        if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 10 <= len(_digits(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidate_spans(t: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Strings of an identifier's shape outside ``taken``."""
    found = []
    for m in _NUMBER.finditer(t):
        d, plain = _digits(m.group()), m.group()
        if 14 <= len(d) <= 19:
            if luhn(d):
                found.append(("card", m.start(), m.end()))
        elif 7 <= len(d) <= 13 and "/" not in plain and plain.count(".") < 3:
            found.append(("phone", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in _LOCAL_PHONE.finditer(t)]
    if "at" in t and ("[at]" in t or "(at)" in t):
        found += [("email", m.start(), m.end()) for m in _AT.finditer(t)]
    if "." in t or "dot" in t:
        found += [("ip", m.start(), m.end()) for m in _WRITTEN_IP.finditer(t) if all(int(x) <= 255 for x in re.findall("[0-9]+", m.group()))]
    if ":" in t:
        found += [("ip", m.start(), m.end()) for m in _IPV6.finditer(t)]
    out, end = [], -1
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= end and not any(x < b and a < y for _, x, y in taken):
            out.append((kind, a, b))
            end = b
    return out


def value(kind: str, s: str) -> str:
    """The identifier without its spelling."""
    if kind in ("card", "phone"):
        return _digits(s)
    if kind == "email":
        s = re.sub(r" ?[\[(]dot[\])] ?", ".", re.sub(r" ?[\[(]at[\])] ?", "@", s))
    if kind == "ip":
        s = re.sub(_DOT, ".", s)
    return s.lower()


def contexts(t: str, start: int, end: int) -> tuple[str | None, str | None, str | None]:
    """The word and the two words before a span and the word after it, lower-cased, if they hold a letter."""
    left, right = t[max(0, start - 64):start].split()[-2:], t[end:end + 64].split()[:1]
    one = left[-1].lower() if left and any(c.isalpha() for c in left[-1]) else None
    after = "r " + right[0].lower() if right and any(c.isalpha() for c in right[0]) else None
    return one and "1 " + one, "2 " + left[0].lower() + " " + one if one and len(left) == 2 else None, after


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _extract(batches):
    edge = pa.struct([("kind", pa.string()), ("value", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("p1", pa.string()), ("p2", pa.string()), ("p3", pa.string())])
    kinds = [pa.int64(), pa.int64(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.list_(edge), pa.list_(edge)]

    def edges(t: str, spans: list[tuple[str, int, int]]) -> list[dict]:
        out = []
        for k, a, b in spans:
            p1, p2, p3 = contexts(t, a, b)
            out.append({"kind": k, "value": value(k, t[a:b]), "start": a, "end": b, "p1": p1, "p2": p2, "p3": p3})
        return out

    for batch in batches:
        rows = []
        for t in batch.column(1).to_pylist():
            t = t or ""
            base = base_spans(t)
            text = joined(base)
            n = [sum(s[0] == k for s in base) for k in KINDS]
            rows.append((*n, text, hashlib.sha256(text.encode()).hexdigest(), edges(t, base), edges(t, candidate_spans(t, base))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *[pa.array([r[i] for r in rows], kinds[i + 2]) for i in range(8)]], names=[c.split()[0] for c in ("doc_id", "text_key", *(f"n_{k}" for k in KINDS), "base", "base_sha256", "seeds", "candidates")])


def extract(docs: DataFrame) -> DataFrame:
    """Base spans, seeds and candidates of each row, ``EXTRACTED``, as a written table without the texts."""
    workers_import(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_key("text"))
    with small_batches(docs.sparkSession):
        return materialize(rows.mapInArrow(lean(_extract), EXTRACTED), "identifiers")


def text_key(text: str):
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_key")


def _edges(found: DataFrame, column: str, seed: bool) -> DataFrame:
    each = found.select(F.explode(column).alias("e"))
    return each.select("e.kind", "e.value", F.explode(F.array("e.p1", "e.p2", "e.p3")).alias("pattern")).where("pattern is not null").select("pattern", "kind", "value", F.lit(seed).alias("seed"))


def bootstrap(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(trusted patterns as pattern, kind, confidence; candidate values as kind, value, score)."""
    edges = _edges(found, "seeds", True).unionByName(_edges(found, "candidates", False))
    edges = materialize(edges.groupBy("pattern", "kind", "value").agg(F.max("seed").alias("seed")), "edges")
    known = found.select(F.explode("seeds").alias("e")).select("e.kind", "e.value").distinct()
    edges = edges.join(known.withColumn("known", F.lit(True)), ["kind", "value"], "left").withColumn("seed", F.coalesce("known", F.lit(False))).drop("known")
    edges = materialize(edges, "seeded-edges")
    sizes = edges.groupBy("pattern").agg(F.count_distinct("value").alias("n_values"))
    scores = accepted = None
    for _ in range(rounds):
        scored = edges.withColumn("score", F.col("seed").cast("double")).withColumn("counts", F.col("seed"))
        if scores is not None:
            scored = edges.join(scores, ["kind", "value"], "left").join(accepted.withColumn("accepted", F.lit(True)), ["kind", "value"], "left")
            scored = scored.withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0)))).withColumn("counts", F.col("seed") | F.col("accepted").isNotNull())
        patterns = scored.groupBy("pattern", "kind").agg(F.sum("score").alias("total"), F.count_if("counts").alias("support")).join(sizes, "pattern")
        patterns = materialize(patterns.where(F.col("support") >= support).select("pattern", "kind", (F.col("total") / F.col("n_values")).alias("confidence")), "patterns")
        held = edges.where(~F.col("seed")).join(patterns, ["pattern", "kind"])
        scores = materialize(held.groupBy("kind", "value").agg(
            (1 - F.exp(F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(1 - 1e-12)))))).alias("score"), F.max("confidence").alias("best")), "scores")
        accepted = scores.where((F.col("score") >= confidence) & (F.col("best") >= confidence)).select("kind", "value")
        scores = scores.drop("best")
    good = known.withColumn("score", F.lit(1.0)).unionByName(scores.join(known, ["kind", "value"], "left_anti"))
    return patterns.where(F.col("confidence") >= confidence), good.where(F.col("score") >= confidence)


def added_spans(found: DataFrame, **options) -> DataFrame:
    """Spans that the method adds: doc_id, text_key, kind, start, end, one row each."""
    patterns, values = bootstrap(found, **options)
    each = found.select("doc_id", "text_key", F.explode("candidates").alias("e")).select("doc_id", "text_key", "e.*").distinct()
    known = found.select(F.explode("seeds").alias("e")).select("e.kind", "e.value").distinct()
    here = each.join(values, ["kind", "value"]).join(known.withColumn("known", F.lit(True)), ["kind", "value"], "left")
    sure = here.where("known")
    trusted = patterns.select("pattern", "kind")
    rest = here.where("known is null").withColumn("pattern", F.explode(F.array("p1", "p2", "p3"))).join(trusted, ["pattern", "kind"], "left_semi")
    columns = ["doc_id", "text_key", "kind", "start", "end"]
    return sure.select(columns).unionByName(rest.select(columns)).distinct()


def find(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), text_key."""
    found = extract(docs)
    added = added_spans(found, **options)
    more = added.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))  # at most a text's own candidates
    order = "array(" + ",".join(f"'{k}'" for k in KINDS) + ")"
    base = "transform(filter(split(base, ','), x -> x <> ''), x -> struct(cast(split(x, ':')[1] as bigint) as start, array_position(" + order + ", split(x, ':')[0]) as rank, cast(split(x, ':')[2] as bigint) as end))"
    extra = "transform(coalesce(more, array()), x -> struct(x.start as start, array_position(" + order + ", x.kind) as rank, x.end as end))"
    text = f"array_join(transform(array_sort(concat({base}, {extra})), x -> concat({order}[int(x.rank) - 1], ':', x.start, ':', x.end)), ',')"
    rows = found.select("doc_id", "text_key", "n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256")
    both = rows.join(more.withColumnsRenamed({"doc_id": "_doc", "text_key": "_key"}), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key")), "left")
    return both.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.expr(text).alias("spans"), "text_key")


def masked(t: str, spans: str) -> str:
    """``t`` with ``<kind>`` for every span; of overlapping spans the first one's mark stays."""
    parts, last = [], 0
    for s in spans.split(","):
        kind, a, b = s.split(":")
        if int(a) >= last:
            parts += [t[last:int(a)], f"<{kind}>"]
        last = max(last, int(b))
    return "".join([*parts, t[last:]])


def _masks(batches):
    for texts, spans in batches:
        yield pd.Series([masked(t, s) if t and s else t for t, s in zip(texts, spans, strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def mask(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    yield from lean(_masks)(batches)


def redact(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``<kind>`` and ``n_chars``, where there, counted anew.

    Only texts that have spans, and those that a filter of fixed size takes for such, are
    shuffled, and only texts that have spans are sent to Python.
    """
    names = docs.columns
    spans = find(docs, **options).where("spans <> ''").select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), F.col("spans").alias("_spans")).distinct()
    spans = materialize(spans, "spans")
    own = "_own" + "_" * max((len(c) for c in names), default=0)
    keyed = docs.withColumn(own, F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))))
    marks = id_filter(spans.select("_key"))
    some, rest = keyed.where(in_filter(marks, own)), keyed.where(~in_filter(marks, own)).select(*names)
    rows = some.join(spans, some["doc_id"].cast("long").eqNullSafe(F.col("_doc")) & (some[own] == F.col("_key")), "left").select(*[some[c] for c in names], "_spans")
    has = F.col("_spans").isNotNull()
    text = F.when(has, mask(F.when(has, F.col("text")), F.col("_spans"))).otherwise(F.col("text"))
    out = rows.withColumn("text", text).select(*names).unionByName(rest)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
