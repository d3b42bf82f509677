"""The entry works without the training-data operators, and hides no other gap."""

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent


@pytest.fixture
def copy(tmp_path):
    skip = shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "__pycache__", ".pytest_cache", "*.parquet")
    return shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)


def names(folder):
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.queries()) == set(e.oracle_sql())"
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True)


def test_without_the_subpackage(copy):
    done = names(copy)
    assert done.returncode == 0, done.stderr
    found = done.stdout.split()
    assert "traffic_window_10s" in found
    assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in found)


def test_a_missing_library_is_not_hidden(copy):
    (copy / "corpus_pipeline.py").write_text("import no_such_library\n")
    done = names(copy)
    assert done.returncode and "no_such_library" in done.stderr
