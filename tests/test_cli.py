import os

import pytest
from sql import DATA
from telarium.__main__ import COMMANDS, main
from telarium.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_commands_name_registered_queries():
    assert not {n for _, names in COMMANDS.values() for n in names} - set(QUERIES)


def test_query_and_levels(spark, capsys):
    assert main(["query", "Cuéntó", "--data", DATA, "--limit", "3"]) == 0
    assert capsys.readouterr().out.strip().endswith("3 shown")
    assert main(["query", "zzzz", "--data", DATA, "--level", "1_medio", "--subject", "mat", "--category", "actitud"]) == 0
    assert capsys.readouterr().out.strip() == "0 shown"
    assert main(["levels", "--data", DATA]) == 0 and "1_medio" in capsys.readouterr().out
    assert main(["list"]) == 0 and "totals" in capsys.readouterr().out


def test_commands_write(spark, tmp_path):
    assert main(["coverage", "--data", DATA, "--out", str(tmp_path), "--format", "json"]) == 0
    assert spark.read.json(str(tmp_path / "coverage_summary")).count() > 0
    assert main(["run", "nothing", "--data", DATA, "--out", str(tmp_path)]) == 2
