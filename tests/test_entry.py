"""The entry works without the training-data part and without what that part imports."""

import subprocess
import sys
from pathlib import Path

import pytest

from orderlens import catalog

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if any(name == x or name.startswith(x + ".") for x in {blocked!r}):
            raise ImportError(name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
names = entry.queries()
assert set(entry.oracle_sql()) <= set(names)
print(len(names), sum(n.startswith("op") or n == "pipeline" for n in names))
"""


@pytest.mark.parametrize("blocked", [["orderlens.llm"], ["tokenizers"], ["sentencepiece"], ["public_tokenizers"], ["numpy"], ["corpus_pipeline", "orderlens.llm"]])
def test_other_queries_stay(blocked):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split() == [str(len(catalog.queries())), "0"]
