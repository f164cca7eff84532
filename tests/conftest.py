import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from callweave.session import build_session

    extra = {"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cw-wh-"),
             "spark.driver.memory": "4g"}
    s = build_session("local[4]", "callweave-tests", shuffle_partitions=8, extra=extra)
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def own_tables(request):
    """Tests share a session: each begins without the tables and views of others, and leaves none."""
    if "spark" not in request.fixturenames:
        yield
        return
    s = request.getfixturevalue("spark")
    left = [t.name for t in s.catalog.listTables()]
    assert not left, f"left by another test: {left}"
    yield
    for t in s.catalog.listTables():
        s.sql(f"DROP {'VIEW' if t.isTemporary else 'TABLE'} IF EXISTS {t.name}")
