"""The driver's entry works with and without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(blocked: str) -> set[str]:
    """Names of the queries in a fresh process in which one module cannot be imported."""
    code = f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(*e.queries()); e.oracle_sql()"
    return set(subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, capture_output=True, text=True).stdout.split())


def test_other_queries_survive_a_missing_library():
    from larkspur.catalog import QUERIES

    assert names("xxhash") == names("larkspur.llm") == set(QUERIES)
