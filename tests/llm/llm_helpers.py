"""Shared by the tests of the training-data operators."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """A documents table of (doc_id, text[, lang[, source]]) rows, with an extra column that clashes with internal names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), 7, "x") for r in rows]
        return spark.createDataFrame(full, DOCS + ", n long, score string")

    return make
