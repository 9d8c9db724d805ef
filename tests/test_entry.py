"""The entry point without the training-data operators, or without what they import."""

import subprocess
import sys
from pathlib import Path

import pytest

from ledgerline.plans.registry import QUERIES

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["ledgerline.llm", "corpus_pipeline", "public_tokenizers"])
def test_other_queries_survive_a_missing_import(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.splitlines()
    assert set(QUERIES) <= set(out[0].split()) and set(QUERIES) <= set(out[1].split())
