"""The entry without the training-data operators."""

import subprocess
import sys

CODE = """
import sys
for name in ("rolecall.llm", "corpus_pipeline"):
    sys.modules[name] = None
import __spark_entry__ as entry
from checks.queries import QUERIES
assert entry.queries() == QUERIES and entry.oracle_sql().keys() == QUERIES.keys()
"""


def test_entry_stands_alone():
    subprocess.run([sys.executable, "-c", CODE], check=True)


def test_operators_are_not_imported():
    code = "import sys, rolecall.plans.daily, checks.queries; assert not any('llm' in m for m in sys.modules if m.startswith('rolecall'))"
    subprocess.run([sys.executable, "-c", code], check=True)
