"""The entry without the training-data operators, in copies of the repository."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import sys, __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()), sorted(e.queries()) == sorted(e.oracle_sql()))"


@pytest.fixture
def copy(tmp_path):
    there = tmp_path / "repo"
    shutil.copytree(ROOT, there, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "*.json", "*.md"))
    return there


def said(folder, *command):
    run = subprocess.run([sys.executable, *command], cwd=folder, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stdout + run.stderr
    return run.stdout


def without_folders(copy):
    shutil.rmtree(copy / "merchmill" / "llm")
    shutil.rmtree(copy / "tests" / "llm", ignore_errors=True)


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_and_tests_without_the_folders(copy, pipeline):
    without_folders(copy)
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink()
    found, of_llm, with_sql = said(copy, "-c", SAY).split()
    assert int(found) >= 58 and (of_llm, with_sql) == ("0", "True")
    assert "error" not in said(copy, "-m", "pytest", "--collect-only", "-q", "tests").lower()


def test_entry_without_a_package_that_the_operators_need(copy):
    if not (copy / "merchmill" / "llm").is_dir():
        pytest.skip("the operators are not here")
    assert said(copy, "-c", "import sys; sys.modules['numpy'] = None; " + SAY).split()[1] == "0"
    assert int(said(copy, "-c", SAY).split()[1]) > 0
