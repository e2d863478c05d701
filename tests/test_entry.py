"""The entry point without the text operators, or without what they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = """
import sys
class Refused:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Refused())
import __spark_entry__ as entry
names = set(entry.queries())
assert set(entry.oracle_sql()) <= names
assert len(names) > 80 and "volatility_30" in names
print(sorted(n for n in names if n.startswith("op") or n == "pipeline"))
"""


@pytest.mark.parametrize("missing", ["tickstone.llm", "public_tokenizers", "xxhash", "regex", "corpus_pipeline"])
def test_core_queries_do_not_need_the_text_operators(missing):
    run = subprocess.run(
        [sys.executable, "-c", ASK.format(missing=missing)], cwd=ROOT, capture_output=True, text=True
    )
    assert run.returncode == 0, run.stderr[-2000:]
    if missing in ("tickstone.llm", "public_tokenizers"):
        assert run.stdout.strip() == "[]"
