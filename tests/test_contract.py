"""The contract holds when a package of the operators for training data is missing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

HIDDEN = """
import sys
sys.modules[{name!r}] = None  # an import of it raises ImportError
import __spark_entry__ as contract
from order_analytics import oracle, registry
assert set(registry.queries()) <= set(contract.queries()) and set(oracle.oracle_sql()) <= set(contract.oracle_sql())
assert not any(name.startswith("op1_") for name in contract.queries() | contract.oracle_sql())
"""


@pytest.mark.parametrize("name", ["sentencepiece", "corpus_pipeline", "order_analytics.llm"])
def test_a_missing_package_leaves_the_library(name):
    done = subprocess.run([sys.executable, "-c", HIDDEN.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
