"""The registry: names agree, and the flagship query runs on the given tables."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 40


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_flagship(spark):
    assert "final_score" in entry.entry(spark).columns


def test_queries_without_the_optional_parts(tmp_path):
    """With the training-data folder gone, but for what a run leaves behind there, the other queries stay."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "helixmill"), tmp_path / "helixmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    (tmp_path / "helixmill" / "llm" / "__pycache__").mkdir(parents=True)
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert run.returncode == 0 and int(run.stdout.split()[-2]) == int(run.stdout.split()[-1]) > 40, run.stderr
