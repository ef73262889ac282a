"""The driver's entry, with and without the optional operators."""

import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parents[1])

# The parent package stays, the optional one is not found.
HIDDEN = """
import importlib.machinery, sys
find = importlib.machinery.PathFinder.find_spec
def hidden(name, *rest):
    return None if name.startswith("tideline.llm") else find(name, *rest)
importlib.machinery.PathFinder.find_spec = hidden
import __spark_entry__ as entry
assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"], entry.queries()
assert len(entry.queries()) > 90 and set(entry.oracle_sql()) <= set(entry.queries())
"""


def test_entry_without_the_optional_operators():
    done = subprocess.run([sys.executable, "-c", HIDDEN], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_every_sql_twin_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
