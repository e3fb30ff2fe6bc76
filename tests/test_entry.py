"""The entry module without its optional parts."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys
for name in {hidden!r}:
    sys.modules[name] = None
import __spark_entry__ as e
print(len(e.queries()), sum(k.startswith("op") or k == "pipeline" for k in e.queries()), len(e.oracle_sql()) > 0)
"""


@pytest.mark.parametrize("hidden", [["tessera.llm"], ["tessera.llm.toxicity"], ["corpus_pipeline", "tessera.llm.queries"]])
def test_entry_without_the_text_operators(hidden):
    """All linkage queries are there if the text operators, or one of them, cannot be imported."""
    from tessera.plans import queries

    out = subprocess.run([sys.executable, "-c", CODE.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(queries.QUERIES)), "0", "True"], out.stderr
