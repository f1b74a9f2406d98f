"""Every oracle-backed batch query equals its DuckDB text (sf0.001).

Stream runs are covered in test_streaming; the driver runs the full set at
sf0.01 (tools/oracle_check.py reproduces that locally).
"""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF001  # noqa: E402

NAMES = [n for n in E.oracle_sql() if not n.startswith("stream_")]


@pytest.fixture(scope="module")
def con():
    import oracle_check
    return oracle_check.duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    import oracle_check
    assert oracle_check.compare(spark, con, name, SF001) is None


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns
