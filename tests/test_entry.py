"""The entry module with and without the optional corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
from lakekit.plans import registry

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=copy, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(registry.queries())), str(len(registry.oracle_sql()))]


def test_registered_names_are_unique_and_sql_has_a_query():
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
