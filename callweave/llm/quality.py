"""Quality rules with risk-controlled thresholds, with DataFrame functions only.

Each rule is a number per document, larger is worse (``RULES``: expression
and cutoffs from loose to strict). Labelled documents are the holdout; no
rule or cutoff is fitted on them. Per stratum (``lang``; null is a stratum
of its own) and rule the cutoffs are tested in order: n good documents, k of
them above the cutoff, p = P(Binomial(n, alpha / rules) <= k). Testing stops
at the first cutoff with p > delta / (strata * rules), so the chain needs no
further correction (fixed sequence) and the chains share ``delta`` by
Bonferroni. With probability 1 - ``delta`` the kept cutoffs reject at most
``alpha`` of the good documents of every stratum. Of the certified cutoffs
that one is used whose share of rejected bad documents, less ``COST`` times
the share of rejected good ones, is largest and above 0 (ties: the looser);
a stratum with too few labels to certify any has no cutoff and keeps all
that the base rules keep.

Windows of five words are compared by a 64-bit hash inside one document.
Null or empty text: all counts 0, ``base_failed`` (fewer than 10 words). Null
``doc_id``: never labelled. Repeated rows of ``documents`` each get their
verdict and, where labelled, count once per ``doc_id`` in the holdout; a
``doc_id`` labelled twice counts as good only if every label says so. An
empty ``labels`` certifies nothing. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.session import materialize

ALPHA = 0.05
DELTA = 0.05
COST = 20.0
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: rule: (expression over the feature table, cutoffs from loose to strict)
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols_per_word": ("n_symbols / greatest(n_words, 1)", [2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05]),
    "upper_share": ("n_upper / greatest(word_chars, 1)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1]),
    "chars_per_word": ("word_chars / greatest(n_words, 1)", [30.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0]),
}
_WS = r"[\\x20\\x09-\\x0D]+"
_WHITE = "' \\t\\n\\u000b\\u000c\\r'"


def features(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, n_lines."""
    t = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(lang as string) stratum", "coalesce(cast(text as string), '') t")
    w = t.selectExpr(
        "doc_id", "stratum", f"array_remove(split(t, r'{_WS.replace(chr(92) * 2, chr(92))}'), '') w",
        "length(t) - length(translate(t, '#*$%&|<>', '')) n_symbols",
        "length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) n_upper",
        f"length(translate(t, {_WHITE}, '')) word_chars",
        f"filter(split(t, '\\n'), x -> translate(x, {_WHITE}, '') <> '') lines")
    h = w.selectExpr(
        "doc_id", "stratum", "size(w) n_words", "word_chars", "n_symbols", "n_upper", "size(lines) n_lines", "size(lines) - size(array_distinct(lines)) n_dup_lines",
        "if(size(w) < 6, cast(array() as array<bigint>), transform(sequence(0, size(w) - 5), i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2), get(w, i + 3), get(w, i + 4)))) h")
    # windows found twice or more, as sorted places; each covers its words up to the next such place
    p = h.selectExpr("*", """case when size(array_distinct(h)) = size(h) then cast(array() as array<int>) else array_sort(flatten(transform(
        array(array_sort(transform(h, (x, i) -> struct(x as x, i as i)))),
        s -> filter(transform(s, (e, j) -> if(e.x <=> get(s, j - 1).x or e.x <=> get(s, j + 1).x, e.i, cast(null as int))), q -> q is not null)))) end p""")
    return p.selectExpr(
        "doc_id", "stratum", "cast(n_words as bigint) n_words", "cast(word_chars as bigint) word_chars", "cast(n_symbols as bigint) n_symbols", "cast(n_dup_lines as bigint) n_dup_lines",
        "if(size(p) = 0, 0L, cast(aggregate(transform(p, (a, j) -> least(5, coalesce(get(p, j + 1) - a, 5))), 0, (u, v) -> u + v) as bigint)) n_repeat_words",
        "cast(n_upper as bigint) n_upper", "cast(n_lines as bigint) n_lines")


def binomial_tail(n: str, k: str, p: str) -> str:
    """SQL for P(Binomial(n, p) <= k), summed exactly term by term in logarithms; 1 from k >= n * p on, where no test passes."""
    return f"""case when {n} = 0 or {k} >= {n} * {p} then 1.0d else aggregate(
        sequence(0L, {k}), named_struct('log', 0.0d, 'sum', 0.0d),
        (a, i) -> named_struct('log', if(i = 0, {n} * ln(1 - {p}), a.log + ln(({n} - i + 1) / greatest(i, 1)) + ln({p} / (1 - {p}))),
                               'sum', a.sum + exp(if(i = 0, {n} * ln(1 - {p}), a.log + ln(({n} - i + 1) / greatest(i, 1)) + ln({p} / (1 - {p}))))),
        a -> a.sum) end"""


def thresholds(table: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, rules: dict[str, tuple[str, list[float]]] = RULES) -> DataFrame:
    """One row per stratum: ``stratum`` and a nullable cutoff per rule. ``table`` is the feature table."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("quality"))
    seen = table.join(marks, table["doc_id"] == marks["_id"]).groupBy("_id").agg(
        F.first("stratum").alias("stratum"), F.first("quality").alias("quality"), *[F.max(F.expr(e)).alias(r) for r, (e, _) in rules.items()])
    counts = seen.groupBy("stratum").agg(
        F.count_if(F.col("quality") == 1).alias("n_good"), F.count_if(F.col("quality") == 0).alias("n_bad"),
        *[F.count_if((F.col("quality") == q) & (F.col(r) > c)).alias(f"_{r}_{j}_{q}") for r, (_, cuts) in rules.items() for j, c in enumerate(cuts) for q in (0, 1)])
    strata = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))  # one row per stratum
    share = f"{alpha / len(rules)!r}d"
    long = counts.withColumn("_strata", strata).selectExpr("stratum", "n_good", "n_bad", "_strata", "inline(array(" + ", ".join(
        f"named_struct('rule', '{r}', 'step', {j}, 'cutoff', {c!r}d, 'bad', _{r}_{j}_0, 'good', _{r}_{j}_1)" for r, (_, cuts) in rules.items() for j, c in enumerate(cuts)) + "))")
    tested = long.withColumn("p_value", F.expr(binomial_tail("n_good", "good", share)))
    failed = F.max(F.when(F.col("p_value") <= F.lit(delta) / (F.col("_strata") * len(rules)), 0).otherwise(1)).over(Window.partitionBy("stratum", "rule").orderBy("step"))
    gain = F.col("bad") / F.greatest(F.col("n_bad"), F.lit(1)) - F.lit(COST) * F.col("good") / F.greatest(F.col("n_good"), F.lit(1))
    usable = tested.withColumn("_failed", failed).withColumn("_gain", gain).where("_failed = 0 and _gain > 0")
    best = usable.groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct(F.col("_gain"), -F.col("step"))).alias("cutoff"))
    return best.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in rules])


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, stratum."""
    table = materialize(features(docs), "quality-features")
    cuts = materialize(thresholds(table, labels, alpha, delta), "quality-cutoffs").withColumnRenamed("stratum", "_stratum")
    # a stratum may hold most rows: each row of the lean cutoff table stands for several keys
    salts = 16
    spread = cuts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = table.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(salts)).cast("int"))
    joined = rows.join(spread, (rows["_salt"] == spread["_salt"]) & F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    failed = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    over = F.lit(False)
    for r, (e, _) in RULES.items():
        over = over | F.coalesce(F.expr(e) > F.col(f"max_{r}"), F.lit(False))
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum")


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lang AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT rid, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + j) AS n FROM dup, range(5) r(j) GROUP BY rid),
f AS (
  SELECT doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov USING (rid)),
rule_values AS (
  SELECT *, [n_symbols / greatest(n_words, 1), n_upper / greatest(word_chars, 1), n_dup_lines / greatest(n_lines, 1), word_chars / greatest(n_words, 1)] AS v FROM f),
marks AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT doc_id, first(stratum) AS stratum, first(quality) AS quality, [max(v[1]), max(v[2]), max(v[3]), max(v[4])] AS v FROM rule_values JOIN marks USING (doc_id) GROUP BY doc_id),
grid AS (
  SELECT rule, unnest(cuts) AS cutoff, unnest(range(len(cuts))) AS step FROM (VALUES
    (1, [2.0::DOUBLE, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05]), (2, [0.9::DOUBLE, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]),
    (3, [0.9::DOUBLE, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1]), (4, [30.0::DOUBLE, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0])) g(rule, cuts)),
counted AS (
  SELECT stratum, rule, step, cutoff, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality = 0) AS n_bad,
         count(*) FILTER (quality = 1 AND v[rule] > cutoff) AS good, count(*) FILTER (quality = 0 AND v[rule] > cutoff) AS bad,
         (SELECT count(DISTINCT coalesce('s' || stratum, '')) FROM held) AS strata
  FROM held, grid GROUP BY stratum, rule, step, cutoff),
tested AS (
  SELECT *, CASE WHEN n_good = 0 OR good >= n_good * 0.0125 THEN 1.0 ELSE list_sum(list_transform(range(good + 1), lambda i:
    exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln(0.0125::DOUBLE) + (n_good - i) * ln(0.9875::DOUBLE)))) END AS p
  FROM counted),
chain AS (SELECT *, max(CASE WHEN p <= 0.05 / (strata * 4) THEN 0 ELSE 1 END) OVER (PARTITION BY stratum, rule ORDER BY step) AS failed,
                 bad / greatest(n_bad, 1) - 20.0 * good / greatest(n_good, 1) AS gain FROM tested),
best AS (SELECT stratum, rule, arg_max(cutoff, (gain, -step)) AS cutoff FROM chain WHERE failed = 0 AND gain > 0 GROUP BY stratum, rule),
judged AS (
  SELECT r.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         EXISTS (SELECT 1 FROM best b WHERE b.stratum IS NOT DISTINCT FROM r.stratum AND r.v[b.rule] > b.cutoff) AS is_over
  FROM rule_values r)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT is_over AS kept, stratum
FROM judged
"""
