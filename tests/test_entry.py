"""The entry module without the text operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {missing!r} or name == {missing!r}:
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
print(sum(not n.startswith("op") and n != "pipeline" for n in entry.queries()), len(entry.oracle_sql()),
      any(n.startswith("op") or n == "pipeline" for n in entry.queries()))
"""


def counted(missing):
    out = subprocess.run([sys.executable, "-c", CODE.format(missing=missing)], cwd=ROOT, check=True,
                         capture_output=True, text=True, timeout=120)
    return out.stdout.split()


def test_entry_without_the_subpackage_the_pipeline_or_the_tokenizers():
    from fixtures.registry import ORACLES, QUERIES

    for missing in ("public_tokenizers", "corpus_pipeline", "bidlens.llm"):
        assert counted(missing) == [str(len(QUERIES)), str(len(ORACLES)), "False"]
