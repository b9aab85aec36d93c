"""The entry points where something is missing."""

import subprocess
import sys
from pathlib import Path

import pytest

from tidemark.workload.queries import QUERIES

REPO = str(Path(__file__).resolve().parent.parent)
ASK = "import sys; sys.path.insert(0, {repo!r}); sys.modules[{gone!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def ask(gone):
    return subprocess.run([sys.executable, "-c", ASK.format(repo=REPO, gone=gone)], capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("gone", ["corpus_pipeline", "tidemark.llm", "xxhash", "ahocorasick", "public_tokenizers"])
def test_the_replication_queries_stay(gone):
    done = ask(gone)
    assert done.stdout.split() == [str(len(QUERIES))] * 2, done.stderr[-1000:]


def test_a_missing_module_of_its_own_is_an_error():
    assert "ModuleNotFoundError" in ask("tidemark.operators.merge").stderr
