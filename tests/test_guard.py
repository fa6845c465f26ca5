"""The library without the training-data operators."""

import subprocess
import sys

from tests.conftest import ROOT

CODE = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("tramline.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = set(e.queries())
assert "stop_day" in names and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names)
assert set(e.oracle_sql()) <= names
"""


def test_imports_without_them():
    subprocess.run([sys.executable, "-c", CODE], cwd=ROOT, check=True)


def test_nothing_else_imports_them():
    for file in (ROOT / "tramline").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert "tramline.llm" not in file.read_text(), file


def test_imports_without_a_session():
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], cwd=ROOT, check=True)
