"""The entry module with and without the part that can be left out."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(set(e.oracle_sql()) - set(q)), any(n.startswith('op') for n in q))"


@pytest.mark.parametrize("hidden", ["forumlens.llm", "corpus_pipeline", "zstandard", "public_tokenizers"])
def test_the_rest_is_there_when_a_module_is_missing(hidden):
    code = f"import sys; sys.modules[{hidden!r}] = None; {COUNT}"
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=120, check=True)
    queries, loose, operators = run.stdout.split()
    assert int(queries) > 60 and loose == "0" and operators == "False"
    assert "left out" in run.stderr


def test_queries_and_sql_belong_together():
    from forumlens.plans.oracles import ORACLES
    from forumlens.plans.queries import QUERIES

    assert set(ORACLES) <= set(QUERIES)
