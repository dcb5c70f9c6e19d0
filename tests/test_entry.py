"""The entry module without the corpus operators or what only they need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
names = set(entry.queries())
assert "a1_price_rollup" in names and set(entry.oracle_sql()) <= names
print(len(names), any(n.startswith("op") or n == "pipeline" for n in names))
"""


@pytest.mark.parametrize("name", ["corpus_pipeline", "gridlens.llm", "tiktoken", "public_tokenizers"])
def test_other_queries_stay_without_the_corpus_operators(tmp_path, name):
    done = subprocess.run([sys.executable, "-W", "always", "-c", SCRIPT.format(root=ROOT, name=name)], cwd=tmp_path,
                          capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and done.stdout.split()[1] == "False", done.stderr[-2000:]
    assert "corpus queries are left out" in done.stderr
