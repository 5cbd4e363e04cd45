"""The entry without the training-data package, as it is when its folders are absent."""

import shutil
import subprocess
import sys
from pathlib import Path

from minekit.checks.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]


def names(folder):
    code = "import __spark_entry__ as e; print('\\n'.join(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


def copy(folder, *absent):
    shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests", *absent))
    return folder


def test_without_the_package(tmp_path):
    assert names(copy(tmp_path / "plain", "llm")) == set(QUERIES)


def test_without_the_package_and_the_pipeline(tmp_path):
    assert names(copy(tmp_path / "bare", "llm", "corpus_pipeline.py")) == set(QUERIES)
