"""Every registered query against its DuckDB oracle at sf0.01 (the gate).
``ORACLE_SF_DIR=/root/testdata/sf0.1`` runs the same comparison at another scale."""

import os

import pytest

from compare import diff, duck, duck_rows, spark_rows
from conftest import SF_ORACLE

import __spark_entry__ as entry_mod
from callweave.plans.catalogue import QUERIES
from callweave.plans.oracle import ORACLE_SQL as ORACLE


SF = os.environ.get("ORACLE_SF_DIR", SF_ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duck(SF)
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    s_cols, s_rows = spark_rows(QUERIES[name](spark, SF))
    d_cols, d_rows = duck_rows(con, ORACLE[name])
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows), f"{len(s_rows)} vs {len(d_rows)}"
    assert s_rows == d_rows, diff(s_rows, d_rows)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["account_id", "part_no", "n_parts", "n_calls", "bundle", "ds_account"]
    assert df.count() > 0
