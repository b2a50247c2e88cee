"""The entry points without the optional subpackage, with what a deletion leaves of it, or without a library it needs."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT

BLOCKED = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing!r} + "."):
            raise ImportError(name)
sys.meta_path.insert(0, Missing())
import __spark_entry__
print(len(__spark_entry__.queries()), len([n for n in __spark_entry__.queries() if n.startswith("op") or n == "pipeline"]))
"""


@pytest.mark.parametrize("missing", ["tallyflow.llm", "ahocorasick", "corpus_pipeline"])
def test_entry_without(missing):
    ran = subprocess.run([sys.executable, "-c", BLOCKED.format(missing=missing)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    every, optional = map(int, ran.stdout.split())
    assert every - optional > 60 and (optional == 0 or missing == "corpus_pipeline")


def test_entry_with_a_leftover_folder(tmp_path):
    for name in ("__spark_entry__.py", "showcase", "tallyflow"):
        (tmp_path / name).symlink_to(ROOT / name)
    (tmp_path / "tallyflow").unlink()
    (tmp_path / "tallyflow").mkdir()
    for part in (ROOT / "tallyflow").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (tmp_path / "tallyflow" / part.name).symlink_to(part)
    (tmp_path / "tallyflow/llm/__pycache__").mkdir(parents=True)
    code = "import sys; sys.path.insert(0, '.'); import tallyflow; import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), tallyflow.__path__[0])"
    entry = (ROOT / "__spark_entry__.py").read_text()
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(entry)
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    assert int(ran.stdout.split()[0]) > 60 and "False" in ran.stdout
