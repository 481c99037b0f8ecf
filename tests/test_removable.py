"""The library without the optional subpackage, on a copy with both of its folders deleted."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
TRY = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); assert q and set(o) <= set(q); print(sum(n == 'pipeline' or n.startswith('op') for n in q))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_imports_without_the_subpackage(tmp_path, pipeline):
    for name in ("sitewise", "tests", "__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline and (ROOT / "corpus_pipeline.py").exists() else [])):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    for folder in ("sitewise/llm", "tests/llm"):
        shutil.rmtree(tmp_path / folder, ignore_errors=True)
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    got = subprocess.run([sys.executable, "-c", TRY], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0, got.stderr
    assert got.stdout.strip() == "0"
