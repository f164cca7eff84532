"""The command line lists and runs registered queries."""

import json

from callweave.__main__ import main
from callweave.plans.catalogue import QUERIES
from conftest import SF_SMALL


def test_cli_list_and_query(spark, capsys, tmp_path):
    main(["list"])
    names = capsys.readouterr().out.split()
    assert "account_bundle" in names and len(names) == len(QUERIES)
    out = str(tmp_path / "icp")
    main(["query", "icp_calls", "--sf-dir", SF_SMALL, "--out", out])
    info = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert info["query"] == "icp_calls"
    assert spark.read.parquet(out).count() > 0
