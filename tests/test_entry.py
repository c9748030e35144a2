"""The driver contract: entry() and the rows-only queries run and have rows."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

# the text operators' queries have tests of their own in tests/llm
ROWS_ONLY = sorted(n for n in set(entry.queries()) - set(entry.oracle_sql()) if n != "pipeline" and not n.startswith("op"))


def test_contract_keys():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 100
    assert "predicted_exam_score" in df.columns and "draw_id" in df.columns
    assert all(r["predicted_exam_score"] is not None or r["error"] for r in rows)


@pytest.mark.parametrize("name", [n for n in ROWS_ONLY if n not in ("cv_results",)])
def test_rows_only_queries(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() > 0


def test_entry_without_the_text_operators(tmp_out):
    """The rest imports and registers its queries where the optional parts are absent."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copy(entry.__file__, tmp_out)
    shutil.copytree(f"{root}/scorecast", f"{tmp_out}/scorecast", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op')], 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_out, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    number, names, pipeline = out.stdout.strip().split(" ", 1)[0], out.stdout.strip().split(" ", 1)[1].rsplit(" ", 1)[0], out.stdout.strip().rsplit(" ", 1)[1]
    assert int(number) >= 70 and names == "[]" and pipeline == "False"
