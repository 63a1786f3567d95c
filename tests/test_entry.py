"""The driver's entry, with and without the training-data operators."""

import subprocess
import sys
from pathlib import Path

import pytest

from chatloom.plans.catalog import QUERIES

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["chatloom.llm", "corpus_pipeline", "xxhash", "zstandard"])
def test_entry_without_a_part(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries())"
    names = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert set(QUERIES) <= set(names)
