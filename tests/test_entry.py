"""The entry points with the text operators, without them, and with something missing."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), sorted(q)[-1], set(e.oracle_sql()) <= set(q))"


@pytest.fixture
def copy(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "wayfare", tmp_path / "wayfare", ignore=shutil.ignore_patterns("__pycache__"))
    return tmp_path


def run(folder, code=COUNT):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)


def test_entry_without_the_text_operators(copy):
    shutil.rmtree(copy / "wayfare" / "llm", ignore_errors=True)
    done = run(copy)
    assert done.stdout.split() == ["59", "59", "vw_zone_performance", "True"], done.stderr
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert run(copy).stdout == done.stdout


def test_a_missing_library_is_an_error(copy):
    if not (copy / "wayfare" / "llm").exists():
        pytest.skip("no text operators here")
    done = run(copy, "import sys; sys.modules['zstandard'] = None; " + COUNT)
    assert done.returncode and "zstandard" in done.stderr
