"""The entry imports, and its other queries stand, without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SHOW = "import __spark_entry__ as e; print(sum(n.startswith(('op', 'pipeline')) for n in e.queries()), len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_without_the_optional_subpackage(tmp_path, with_pipeline):
    shutil.copytree(ROOT / "vcat", tmp_path / "vcat", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if with_pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    optional, every, known = done.stdout.split()
    assert optional == "0" and int(every) > 200 and known == "True"
