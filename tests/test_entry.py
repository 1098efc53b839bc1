"""The entry module without the corpus operators or without a package that only they need."""

import subprocess
import sys

import pytest

ROOT = __file__.rsplit("/", 2)[0]

CODE = """
import sys, warnings
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {blocked!r} or name in {blocked!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
names = set(entry.queries())
print(len(names) > 250, any(n.startswith("op") for n in names), "pipeline" in names, any("left out" in str(w.message) for w in said))
"""


@pytest.mark.parametrize("blocked, said", [("cohortlens.llm", False), ("zstandard", True)])
def test_entry_imports_without_the_corpus_operators(blocked, said):
    run = subprocess.run([sys.executable, "-c", CODE.format(blocked=[blocked])], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.stdout.split() == ["True", "False", "False", str(said)], run.stderr
