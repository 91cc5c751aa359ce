import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

#: Hides the corpus operators, or a library they need, from the import system.
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
from kinmatch.plans.queries import ORACLES, QUERIES
assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)
"""


def test_the_rest_loads_without_the_corpus_operators_or_their_libraries():
    for name in ("kinmatch.llm", "sentencepiece"):
        subprocess.run([sys.executable, "-c", HIDE.format(name=name)], cwd=ROOT, check=True, timeout=120)
