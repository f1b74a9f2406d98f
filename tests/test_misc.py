import datetime as dt

import pytest
from pyspark.sql import types as T

from bazaar.operators import serving as S
from bazaar.operators import timeseries as TS
from bazaar.operators.dedup import dedup_stream
from bazaar.session import scratch_path
from bazaar.streaming.sources import read_layer


def test_to_display_time_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 20, 0), 1)], "w timestamp, n int")
    r = S.to_display(df, "Asia/Ho_Chi_Minh").first()
    assert r["w"] == "2020-01-02 03:00:00" and r["n"] == 1


def test_read_layer_missing_ok(spark):
    schema = T.StructType([T.StructField("event_date", T.DateType())])
    df = read_layer(spark, scratch_path(spark, "nothing-here"), schema, missing_ok=True)
    assert df.count() == 0 and df.schema == schema
    with pytest.raises(Exception):
        read_layer(spark, scratch_path(spark, "nothing-here"), None)


def test_leakage_safe_drops_same_day_revenue():
    class D:
        columns = ["event_date", "total_revenue", "gross_revenue", "revenue_lag_1", "payment_total",
                   "avg_revenue_per_order", "gold_layer", "month"]
    assert TS.feature_columns(D, leakage="reference") == [
        "gross_revenue", "revenue_lag_1", "payment_total", "avg_revenue_per_order", "month"]
    assert TS.feature_columns(D, leakage="safe") == ["revenue_lag_1", "month"]


def test_dedup_within_watermark(spark):
    src = scratch_path(spark, "wm-in")
    rows = [(1, dt.datetime(2020, 1, 1, 0, 0)), (1, dt.datetime(2020, 1, 1, 0, 5)),
            (2, dt.datetime(2020, 1, 1, 0, 1))]
    spark.createDataFrame(rows, "k int, event_timestamp timestamp").write.parquet(src)
    st = spark.readStream.schema("k int, event_timestamp timestamp").parquet(src)
    out = scratch_path(spark, "wm-out")
    q = (dedup_stream(st, ["k"], "1 hour", within_watermark=True).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", out + "-ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [1, 2]
    with pytest.raises(ValueError):
        dedup_stream(st, ["k"], None, within_watermark=True)


def test_gap_filled_spine(spark):
    from bazaar.operators.rollups import date_spine
    df = spark.createDataFrame([("a", dt.date(2020, 1, 1)), ("a", dt.date(2020, 1, 4)),
                                ("b", dt.date(2020, 1, 2))], "s string, event_date date")
    got = sorted((r["s"], r["event_date"].day) for r in date_spine(df, ["s"], gap_fill=True).collect())
    assert got == [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 2)]


def test_a_missing_library_costs_only_its_own_queries(monkeypatch):
    """Without a library that the training-data subpackage needs, the others stay."""
    import importlib.util
    import sys

    import pytest

    import __spark_entry__ as E
    from bazaar.registry import QUERIES
    if importlib.util.find_spec("bazaar.llm") is None:  # the subpackage was taken out
        assert E.queries().keys() == QUERIES.keys()
        return
    for name in [n for n in sys.modules if n.startswith("bazaar.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    import bazaar
    monkeypatch.delattr(bazaar, "llm", raising=False)
    monkeypatch.setitem(sys.modules, "numpy", None)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    with pytest.warns(UserWarning, match="left out"):
        assert E.queries().keys() == QUERIES.keys()
