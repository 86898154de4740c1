"""The entry module works without the optional training-data package."""
import subprocess
import sys

BLOCK = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.split(".")[:2] == ["citystream", "llm"]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = set(e.queries())
assert "q_ward_energy" in names and not any(n.startswith("op") for n in names), names
assert "pipeline" not in names and set(e.oracle_sql()) <= names
"""


def test_entry_without_the_optional_package():
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", BLOCK], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_package():
    import os
    import re
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, names in os.walk(os.path.join(root, "citystream")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert not re.search(r"\bcitystream\.llm\b|\bcorpus_pipeline\b", f.read()), name
