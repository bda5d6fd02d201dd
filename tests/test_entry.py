"""The entry stands without the training-data folder, whatever is left of it."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "the pipeline"])
def test_entry_without_training_operators(tmp_path, left):
    skip = shutil.ignore_patterns("llm", "__pycache__", "tests", ".git")
    shutil.copytree(ROOT / "wxspark", tmp_path / "wxspark", ignore=skip)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if left == "an empty folder":
        (tmp_path / "wxspark" / "llm" / "__pycache__").mkdir(parents=True)
    if left == "the pipeline" and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 55 and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
