"""The pipeline end to end, and the registered queries against their SQL."""

import random

import pytest

import corpus_pipeline
from callweave.llm.queries import ORACLE_SQL, QUERIES
from compare import diff, duck, duck_rows, spark_rows

from llm_helpers import SF_SMALL, docs_of  # noqa: F401


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    s_cols, s_rows = spark_rows(QUERIES[name](spark, SF_SMALL))
    d_cols, d_rows = duck_rows(duck(SF_SMALL), ORACLE_SQL[name])
    assert s_cols == d_cols and s_rows == d_rows, diff(s_rows, d_rows)


def test_names_and_stages():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mix", "pack"]


def test_stages_keep_their_columns_and_take_effect(spark, docs_of):
    rng = random.Random(1)
    words = ["the", "cat", "and", "dog", "were", "thinking", "of", "things", "that", "they", "like"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40)), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100, rows[0][1], "en", "s0"), (101, "123 456", "en", "s1"), (102, None, "en", None), (103, rows[1][1] + " 4111111111111111 mail a@b.example now", "en", "s2")]
    docs = given = docs_of(rows)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == given.columns
        kept[name] = [(r.doc_id, r.text, r.n_chars) for r in docs.collect()]
    assert {101, 102}.isdisjoint(d for d, _, _ in kept["language"]) and len(kept["language"]) == 62
    assert 100 not in {d for d, _, _ in kept["near_duplicates"]}
    for stage in ("personal_data", "mix"):
        assert all(n == len(t) and "@" not in t for _, t, n in kept[stage])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert len(packed) == len(kept["mix"])


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert rows and all(r.length <= 4096 for r in rows)
