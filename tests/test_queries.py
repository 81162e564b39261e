"""Every registered query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle import compare, connect

import quillmesh.queries as q

BASE = list(q.QUERIES)


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", BASE)
def test_query(spark, con, sf, name):
    said = compare(spark, con, name, sf)
    assert said.startswith("equal" if name in q.ORACLE_SQL else "rows only"), said


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("gone", [["quillmesh/llm"], ["quillmesh/llm", "corpus_pipeline.py"]])
def test_entry_without_the_corpus_operators(tmp_path, gone):
    """What is left imports, registers its queries and collects its tests when the subpackage or the pipeline is away."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("quillmesh", "tests", "tools"):
        shutil.copytree(f"{here}/{name}", f"{tmp_path}/{name}", ignore=shutil.ignore_patterns("__pycache__", "llm" if "quillmesh/llm" in gone else "nothing"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in gone and os.path.exists(f"{here}/{name}"):
            shutil.copy(f"{here}/{name}", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q), 'pipeline' in q, any(k.startswith('op') and k[2].isdigit() for k in q))"
    run = lambda *a: subprocess.run([sys.executable, *a], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    said = run("-c", code)
    assert said.returncode == 0, said.stderr
    n, subset, pipeline, operators = said.stdout.split()
    assert int(n) >= len(BASE) and subset == "True" and pipeline == "False" and operators == str("quillmesh/llm" not in gone and os.path.exists(f"{here}/quillmesh/llm"))
    assert run("-m", "pytest", "--collect-only", "-q", "tests").returncode == 0
