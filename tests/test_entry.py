"""The entry point without the optional subpackage or one of its libraries."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
for name in {blocked!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
from holdfast.plans import catalog
assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLES) <= set(entry.oracle_sql())
print(len(entry.queries()) - len(catalog.QUERIES))
"""


@pytest.mark.parametrize("blocked", [["ahocorasick"], ["holdfast.llm"], ["tokenizers", "public_tokenizers"], ["holdfast.llm", "corpus_pipeline"]])
def test_other_queries_stay(blocked):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) == 0
