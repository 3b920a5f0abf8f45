"""The entry point with and without its optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None  # importing it raises ImportError
import __spark_entry__ as entry
names = set(entry.queries())
assert set(entry.oracle_sql()) <= names
print(len(names), len([n for n in names if n.startswith("op") or n == "pipeline"]))
"""


@pytest.mark.parametrize("missing", ["paygrain.llm", "corpus_pipeline", "public_tokenizers", "tokenizers", "xxhash"])
def test_queries_without_an_optional_module(missing):
    from checks import inventory, registry  # noqa: F401  (registers the queries)

    done = subprocess.run([sys.executable, "-W", "ignore", "-c", COUNT, missing], capture_output=True, text=True, timeout=120, cwd=ROOT)
    assert done.returncode == 0, done.stderr
    total, optional = map(int, done.stdout.split())
    # The library that reads a vocabulary is imported where it is used only.
    assert (total, optional) == (len(registry.QUERIES), 0) or missing == "tokenizers"
    assert total >= len(registry.QUERIES)
