import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from bazaar.plans import forecast as FC
from bazaar.plans.features import model_frame

from conftest import SF01


def test_metric_formulas(spark):
    rows = [("val", 10.0, 8.0), ("val", 20.0, 21.0), ("val", 30.0, 33.0)]
    m = FC.metrics(spark.createDataFrame(rows, "split string, actual double, predicted double")).first()
    err = [2.0, -1.0, -3.0]
    assert m["rmse"] == pytest.approx(math.sqrt(sum(e * e for e in err) / 3))
    assert m["mae"] == pytest.approx(2.0)
    assert m["r2"] == pytest.approx(1 - 14 / 200)
    assert m["mape"] == pytest.approx((0.2 + 0.05 + 0.1) / 3 * 100, rel=1e-6)


def test_residual_histogram_bins(spark):
    rows = [("test", float(i), 0.0) for i in range(31)]
    h = FC.residual_histogram(spark.createDataFrame(rows, "split string, actual double, predicted double"))
    got = {r["bin"]: r["count"] for r in h.collect()}
    assert sum(got.values()) == 31 and max(got) == 30 and min(got) == 1
    assert got[30] == 2  # the max value lands in the last bin
    rows = [("val", float(i), 0.0) for i in (0, 1, 100)]
    h = FC.residual_histogram(spark.createDataFrame(rows, "split string, actual double, predicted double"))
    assert sorted(r["bin"] for r in h.collect()) == list(range(1, 31))  # empty bins are there


def test_best_round_waits_for_patience():
    errors = [9.0, 8.0, 8.5, 7.0, 7.5, 7.4, 7.3, 1.0]
    assert FC.best_round(errors, 2) == (3, True)
    assert FC.best_round(errors, 5) == (7, False)
    assert FC.best_round([1.0], 30) == (0, False)


def test_train_and_recursive_forecast(spark):
    fit = FC.fitted(spark, SF01)
    assert len(fit.features) == 54
    fc = FC.forecast(spark, fit, fit.frame, horizon=5)
    rows = fc.orderBy("horizon").collect()
    assert [r["horizon"] for r in rows] == [1, 2, 3, 4, 5]
    last = fit.frame.agg(F.max("event_date")).first()[0]
    assert [r["event_date"] for r in rows] == [last + dt.timedelta(days=h) for h in range(1, 6)]
    assert all(r["predicted_revenue"] >= 0 for r in rows)


def test_multi_series_forecast(spark):
    """Series keys: two copies of the daily series forecast independently."""
    base = model_frame(spark, SF01)
    two = base.withColumn("store", F.lit("a")).unionByName(base.withColumn("store", F.lit("b")))
    fit = FC.train(two.drop("rn", "n_rows"), keys=["store"], maxIter=3)
    fc = FC.forecast(spark, fit, two, horizon=3)
    got = sorted((r["store"], r["horizon"]) for r in fc.collect())
    assert got == [(s, h) for s in ("a", "b") for h in (1, 2, 3)]
