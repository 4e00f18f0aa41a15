"""Every registered query against its SQL, and the plans that matter."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest


import __spark_entry__ as entry
from framegrid.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_matches_sql(spark, against_sql, name):
    against_sql(registry.queries()[name](spark, DATA), registry.oracle_sql()[name])


def test_without_the_training_data_part(tmp_path):
    """With its folder and tests gone, and the corpus pipeline there or not, the rest imports and names its queries."""
    root = Path(entry.__file__).resolve().parent
    for name in ("framegrid", "tests"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for f in root.glob("*.py"):
        shutil.copy(f, tmp_path / f.name)
    say = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    for _ in range(2):
        got = subprocess.run([sys.executable, "-c", say], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
        assert got.stdout.split() == [str(len(registry.queries())), str(len(registry.oracle_sql())), "False"]
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


def test_entry(spark):
    assert entry.entry(spark).columns == ["document", "col_idx", "row_idx", "cell"]
    assert set(registry.queries()) <= set(entry.queries())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cell_strings_plan(spark):
    plan = _plan(registry.queries()["cell_strings"](spark, DATA))
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "CartesianProduct" not in plan
    assert plan.count("Exchange hashpartitioning(document") == 1


def test_scans_are_pruned(spark):
    plan = _plan(registry.queries()["pixel_to_grid"](spark, DATA))
    assert "props" not in plan and "value" not in plan


def test_resume_limit_is_ordered(spark):
    rows = [(r.document, r.file) for r in registry.queries()["resume_limit"](spark, DATA).collect()]
    assert rows == sorted(rows) and len(rows) <= registry.RESUME_LIMIT


def test_positions_are_ordered(spark):
    rows = [(r.document, r.time_s, r.ord) for r in registry.queries()["load_positions"](spark, DATA).collect()]
    assert rows == sorted(rows)


def test_core_queries_without_a_package(tmp_path):
    """Where a package of the training-data part cannot be imported, the other queries are all there."""
    (tmp_path / "zstandard.py").write_text("raise ImportError('no such package')")
    root = Path(registry.__file__).resolve().parents[2]
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())), 'pipeline' in e.queries())"
    paths = os.pathsep.join([str(tmp_path), str(root)])
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env={**os.environ, "PYTHONPATH": paths}, cwd=root, check=True).stdout
    assert out.split() == [str(len(registry.queries())), "[]", "False"]
