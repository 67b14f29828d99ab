"""The entry module with and without the training-data folder."""

import subprocess
import sys

import __spark_entry__ as entry
from places import ROOT
from lakegraph.plans import catalog

WITHOUT = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name in BLOCKED:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
from lakegraph.plans import catalog
assert set(e.queries()) == set(catalog.JOBS) and set(e.oracle_sql()) == set(catalog.SQL)
"""


def test_core_jobs_do_not_need_the_folder():
    for blocked in (("lakegraph.llm",), ("corpus_pipeline",), ("lakegraph.llm", "corpus_pipeline")):
        subprocess.run([sys.executable, "-c", f"BLOCKED = {blocked!r}\n" + WITHOUT], cwd=ROOT, check=True, timeout=120)


def test_registered_names():
    assert set(catalog.JOBS) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
