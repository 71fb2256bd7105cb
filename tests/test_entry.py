"""The driver file must work without the optional corpus package."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LISTED = "import __spark_entry__ as d; print(*sorted(d.queries())); assert set(d.oracle_sql()) <= set(d.queries())"


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_entry_imports_without_the_corpus_package(tmp_path, pipeline_stays):
    shutil.copytree(f"{ROOT}/stridelog", tmp_path / "stridelog",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if pipeline_stays and os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    run = subprocess.run([sys.executable, "-c", LISTED], cwd=tmp_path, capture_output=True,
                         text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
    assert run.returncode == 0, run.stderr
    names = run.stdout.split()
    assert "f21_feature_store" in names
    assert "pipeline" not in names and not any(n.startswith("op") for n in names)
