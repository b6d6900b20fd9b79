"""Every registered query against its SQL oracle, at the smallest scale."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, tables, name):
    assert compare(spark, tables, entry.queries()[name], entry.oracle_sql()[name], SF) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "idx", "paragraph"] and df.count() > 0


@pytest.mark.parametrize("gone", ["passagemill.llm", "passagemill.llm.queries", "xxhash", "sentencepiece"])
def test_entry_without_optional_parts(gone):
    """Without the optional subpackage, or a library of it, all other queries are still listed."""
    code = f"import sys; sys.modules[{gone!r}] = None; import __spark_entry__ as e; print(len(e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.abspath(entry.__file__)))
    assert run.returncode == 0 and int(run.stdout) >= len(QUERIES)
