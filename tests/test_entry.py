"""The entry module works with and without the optional training-data part, and hides no other import error."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

BLOCK = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if any(name == b or name.startswith(b + ".") for b in {blocked!r}):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
print(sorted(k for k in e.queries() if k.startswith("op") or k == "pipeline"), len(e.queries()) >= 36, set(e.oracle_sql()) <= set(e.queries()))
"""


def run(blocked):
    return subprocess.run([sys.executable, "-B", "-c", BLOCK.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True)


def test_without_the_optional_part():
    for blocked in (["corpus_pipeline"], ["gridmart.llm"], ["corpus_pipeline", "gridmart.llm"]):
        out = run(blocked)
        assert out.returncode == 0, out.stderr
        assert out.stdout.strip().endswith("[] True True")


def test_a_missing_dependency_is_not_hidden():
    assert run(["gridmart.operators.ingest"]).returncode != 0
    if (ROOT / "corpus_pipeline.py").exists():
        assert run(["gridmart.llm.common"]).returncode != 0
