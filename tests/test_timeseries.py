import datetime as dt
import statistics

import pytest

from bazaar.operators import timeseries as TS


def _series(spark, n=30, keys=("a",), skip=None):
    rows = []
    for k in keys:
        d0 = dt.date(2021, 1, 1)
        for i in range(n):
            if skip is not None and i == skip:
                continue
            rows.append((k, d0 + dt.timedelta(days=i), float(i + 1)))
    return spark.createDataFrame(rows, "s string, event_date date, y double")


def test_lags_and_rolling_by_hand(spark):
    df = TS.rolling_features(TS.lag_features(_series(spark), "y", ["s"]), "y", ["s"])
    rows = {r["event_date"].day: r for r in df.collect()}
    r = rows[10]  # y = 10; previous rows 1..9
    assert r["revenue_lag_1"] == 9 and r["revenue_lag_7"] == 3 and r["revenue_lag_14"] is None
    assert r["revenue_roll_mean_7"] == pytest.approx(statistics.mean(range(3, 10)))
    assert r["revenue_roll_std_7"] == pytest.approx(statistics.stdev(range(3, 10)))
    assert r["revenue_roll_max_7"] == 9
    assert rows[7]["revenue_roll_mean_7"] is None          # only 6 rows before
    assert rows[8]["revenue_roll_mean_7"] == pytest.approx(4.0)
    assert rows[28]["revenue_roll_mean_28"] is None and rows[28]["revenue_roll_max_28"] is None
    assert rows[29]["revenue_roll_mean_28"] == pytest.approx(14.5)  # rows 1..28
    assert rows[30]["revenue_roll_max_28"] == 29           # never sees the current row


def test_row_based_not_calendar_based(spark):
    df = TS.lag_features(_series(spark, 10, skip=4), "y", ["s"])
    rows = {r["event_date"].day: r for r in df.collect()}
    assert rows[6]["revenue_lag_1"] == 4  # day 5 missing: previous row is day 4


def test_two_series_do_not_mix(spark):
    df = TS.lag_features(_series(spark, 5, keys=("a", "b")), "y", ["s"])
    firsts = [r for r in df.collect() if r["event_date"].day == 1]
    assert len(firsts) == 2 and all(r["revenue_lag_1"] is None for r in firsts)


@pytest.mark.parametrize("n,expect", [(1, (0, 0, 1)), (7, (4, 1, 2)), (20, (14, 3, 3)), (100, (70, 15, 15))])
def test_split_sizes(spark, n, expect):
    df = TS.chronological_split(_series(spark, n), ["s"])
    got = {r["split"]: r["rows"] for r in TS.split_summary(df, ["s"]).collect()}
    assert (got.get("train", 0), got.get("val", 0), got.get("test", 0)) == expect
    # every split is a prefix in time of what follows
    summ = {r["split"]: r for r in TS.split_summary(df, ["s"]).collect()}
    if "train" in summ and "val" in summ:
        assert summ["train"]["last_date"] < summ["val"]["first_date"]


def test_calendar_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "event_date date")
    r = TS.cyclical_features(TS.calendar_features(df)).orderBy("event_date").collect()
    assert r[0]["day_of_week"] == 0 and r[0]["is_weekend"] == 0 and r[0]["week_of_year"] == 1
    assert r[1]["day_of_week"] == 6 and r[1]["is_weekend"] == 1
    assert r[0]["dow_sin"] == pytest.approx(0.0)


def test_ratios_guard_zero_and_null(spark):
    df = spark.createDataFrame([(0, 5, 1, 0, 10.0), (10, 0, 1, 2, 10.0), (None, 2, 1, None, 4.0)],
                               "total_sessions long, total_orders long, returned_orders long,"
                               " unique_visitors long, total_revenue double")
    rows = TS.ratio_features(df).collect()
    assert rows[0]["conversion_rate"] == 0.0 and rows[0]["revenue_per_visitor"] == 0.0
    assert rows[1]["return_rate"] == 0.0 and rows[1]["avg_revenue_per_order"] == 0.0
    assert rows[2]["conversion_rate"] == 0.0 and rows[2]["avg_revenue_per_order"] == 2.0


def test_no_feature_is_zero_throughout(spark):
    """With all entities in one span of days every model feature carries values."""
    from pyspark.sql import functions as F

    from bazaar.operators import timeseries as TS
    from bazaar.plans import features as FP
    from conftest import SF001
    frame = TS.all_features(FP.feature_table(spark, SF001, gold=FP.aligned_gold), FP.TARGET)
    cols = TS.feature_columns(frame, FP.TARGET)
    got = frame.agg(*[F.count_if(F.col(c) != 0).alias(c) for c in cols]).first().asDict()
    assert len(cols) > 30 and [c for c in cols if not got[c]] == []
