"""The registry stands without the training-data operators and without the libraries they need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("absent", ["tokenizers", "xxhash", "regex", "public_tokenizers", "corpus_pipeline", "basketry.llm"])
def test_analyses_remain(absent):
    code = (f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; from basketry.catalog.queries import CATALOG; "
            "names = set(e.queries()); assert set(CATALOG) <= names and set(e.oracle_sql()) <= names; assert set(CATALOG) <= set(e.oracle_sql()); "
            "assert not any(n.startswith('op') for n in names)")
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, timeout=120).returncode == 0
