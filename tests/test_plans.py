"""Plan regression: the scale rules hold in every registered batch plan."""

import pytest

import __spark_entry__ as E
from bazaar.registry import QUERIES
from conftest import SF001

NAMES = [n for n in QUERIES if not n.startswith(("stream_", "forecast_", "als_"))]
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "LocalCheckpoint")


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_no_python_udf(spark, name):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_gold_scan_is_pruned_and_filtered(spark):
    plan = E.queries()["gold_daily_sales"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in plan
    scan = plan[plan.index("FileScan parquet ["):]
    cols = scan[len("FileScan parquet ["):scan.index("]")].split(",")
    assert len(cols) == 6  # of the 11 lineitem columns
    assert not any(c.startswith(("l_discount", "l_tax", "l_returnflag")) for c in cols)
    assert "partial_min" in plan  # dedup combines map-side


def test_sanity_filter_reaches_the_scan(spark):
    from bazaar.operators.rollups import sane_dates
    from bazaar.sources.testdata import table
    from pyspark.sql import functions as F
    df = table(spark, SF001, "orders").select(F.col("o_orderdate").cast("date").alias("event_date"))
    plan = sane_dates(df)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(o_orderdate)" in plan
