import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

# Imports the entry as if the optional modules named in the arguments were not there.
SCRIPT = """
import importlib.abc, sys
class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in sys.argv[1:]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
assert set(entry.oracle_sql()) <= set(entry.queries())
print(len(entry.queries()))
"""


def queries_without(*missing):
    done = subprocess.run([sys.executable, "-c", SCRIPT, *missing], cwd=ROOT, capture_output=True, text=True, timeout=120)
    return int(done.stdout) if done.returncode == 0 else done.stderr


def test_the_rest_stands_without_the_optional_part():
    rest = queries_without("corpus_pipeline", "addrloom.llm")
    assert rest == queries_without("corpus_pipeline") > 60


def test_other_missing_modules_are_errors():
    assert "pyspark" in str(queries_without("pyspark"))
