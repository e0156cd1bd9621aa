"""The driver's contract, and that the library stands without its optional package."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_llm_package():
    for path in (ROOT / "docweft").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            text = path.read_text()
            assert "docweft.llm" not in text and "from .llm" not in text and "from ..llm" not in text


def test_the_rest_works_without_it(tmp_path):
    code = "import sys; sys.modules['docweft.llm'] = None; import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q[0] == 'p' and q[1].isdigit()]"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
