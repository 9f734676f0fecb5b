"""The registration of the corpus queries."""

import os
import re
import subprocess
import sys

import __spark_entry__
from evenkeel.llm import queries


def test_one_query_for_each_operator():
    names = [re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES]
    assert sorted(map(int, names)) == list(range(1, 14))
    assert set(__spark_entry__.queries()) >= {*queries.QUERIES, "pipeline"}


def test_nothing_else_imports_the_package():
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    for folder in ("evenkeel", "queries"):
        for at, _, names in os.walk(os.path.join(root, folder)):
            if os.path.join("evenkeel", "llm") not in at:
                for n in names:
                    if n.endswith(".py"):
                        assert "evenkeel.llm" not in open(os.path.join(at, n)).read()


def test_the_entry_works_without_the_package():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "corpus_pipeline" or name.startswith("evenkeel.llm"):
            raise ModuleNotFoundError(name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "reconcile_flagship" in e.queries() and not any(q.startswith("op") for q in e.queries())
"""
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
