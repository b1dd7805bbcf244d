"""The entry module works without the training-data part or a package that it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)


@pytest.mark.parametrize("blocked, pipeline", [
    ("xxhash", None), ("tallyloom.llm", None), ("corpus_pipeline", False), ("nothing", True)])
def test_a_missing_package_takes_only_its_part(blocked, pipeline):
    if pipeline is not None:
        pytest.importorskip("corpus_pipeline")
    code = f"""
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {blocked!r} and ("tallyloom" in sys.modules or name == "corpus_pipeline"):
            raise ImportError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as entry
names, sql = entry.queries(), entry.oracle_sql()
assert sum(not n.startswith("op") and n != "pipeline" for n in names) >= 99
assert set(sql) <= set(names)
print("pipeline" in names, any(n.startswith("op1_") for n in names))
"""
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    has_pipeline, has_operators = found.stdout.split()
    if pipeline is not None:
        assert has_pipeline == str(pipeline)
    if blocked == "tallyloom.llm":
        assert has_operators == "False"
