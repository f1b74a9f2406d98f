"""Revenue forecast on Spark ML: gradient-boosted trees, metrics, feature
importance, residual histogram and a recursive multi-day forecast.

Everything runs on DataFrames; the only values that reach the driver are the
model itself and per-step row counts.  The recursive forecast advances all
series at once, one DataFrame step per horizon day, with lineage cut by
``checkpoint()`` into the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.operators import timeseries as TS
from bazaar.session import shared_dir

TARGET = "total_revenue"
HORIZON = 30
HISTORY = 28          # longest lag / rolling window
CONST_WINDOW = 7      # other features: mean of the last 7 rows
HIST_PLOT_DAYS = 60
MAPE_EPS = 1e-9

# Booster settings of the revenue model (trees, learning rate,
# depth, min rows per leaf, row / column sampling, seed), and the rounds without
# a better validation error after which training stops.
GBT_PARAMS = dict(maxIter=500, stepSize=0.05, maxDepth=6, minInstancesPerNode=3,
                  subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42,
                  minInfoGain=0.0)
PATIENCE = 30
FIRST_ROUNDS = 100


@dataclass
class Fit:
    model: PipelineModel
    features: list[str]
    frame: DataFrame          # model frame with split labels
    keys: tuple[str, ...]
    rounds: int = 0           # best number of boosting rounds


def train(frame: DataFrame, target: str = TARGET, keys: Sequence[str] = (),
          leakage: str = "reference", **params) -> Fit:
    """Fit on train; the number of trees is that of the best validation error
    before ``PATIENCE`` rounds in a row bring no better one."""
    feats = TS.feature_columns(frame, target, leakage, keys)
    cfg = {**GBT_PARAMS, **params}
    asm = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    data = asm.transform(frame).select("features", F.col(target).cast("double").alias(target), "split")
    learn, check = data.where("split = 'train'").persist(), data.where("split = 'val'").persist()

    def booster(rounds: int):
        return GBTRegressor(featuresCol="features", labelCol=target, predictionCol="prediction",
                            **{**cfg, "maxIter": rounds}).fit(learn)
    try:
        rounds = min(FIRST_ROUNDS, cfg["maxIter"])
        while True:
            model = booster(rounds)
            best, stopped = best_round(model.evaluateEachIteration(check, "squared"), PATIENCE)
            if stopped or rounds >= cfg["maxIter"]:
                break
            rounds = min(2 * rounds, cfg["maxIter"])
        if best + 1 < rounds:
            model = booster(best + 1)
    finally:
        learn.unpersist()
        check.unpersist()
    return Fit(PipelineModel([asm, model]), feats, frame, tuple(keys), best + 1)


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Index of the best error before ``patience`` rounds without a better one,
    and whether that many rounds followed it."""
    best = 0
    for k, e in enumerate(errors):
        if e < errors[best]:
            best = k
        elif k - best >= patience:
            return best, True
    return best, False


def lag_predictions(frame: DataFrame, lag: int = 7, target: str = TARGET) -> DataFrame:
    """The series of ``predictions`` for "as ``lag`` rows ago", a baseline that
    any engine can repeat."""
    return frame.select("event_date", "split", F.col(target).alias("actual"),
                        F.col(f"revenue_lag_{lag}").alias("predicted"))


def lag_fit(frame: DataFrame, lag: int = 7, keys: Sequence[str] = ()) -> Fit:
    """A fit that predicts "as ``lag`` rows ago": the recursive forecast with it
    is one that any engine can repeat."""
    same = SQLTransformer(statement=f"SELECT *, revenue_lag_{lag} AS prediction FROM __THIS__")
    return Fit(same, TS.feature_columns(frame, TARGET, "reference", keys), frame, tuple(keys))


def predictions(fit: Fit, target: str = TARGET) -> DataFrame:
    """Actual vs predicted for every row (the plotted val/test series)."""
    out = fit.model.transform(fit.frame)
    return out.select(*fit.keys, "event_date", "split", F.col(target).alias("actual"),
                      F.col("prediction").alias("predicted"))


def metrics(pred: DataFrame) -> DataFrame:
    """RMSE, MAE, R^2, MAPE per split."""
    err = F.col("actual") - F.col("predicted")
    g = pred.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop("actual") * F.count("actual")).alias("_sst"),
        (F.avg(F.abs(err / (F.col("actual") + MAPE_EPS))) * 100).alias("mape"),
    )
    r2 = F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst"))
    return g.select("split", "rows", "rmse", "mae", r2.alias("r2"), "mape")


def importance(spark: SparkSession, fit: Fit, top: int = 20) -> DataFrame:
    imp = fit.model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(fit.features, [float(x) for x in imp]))
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)


def residual_histogram(pred: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width histogram of residuals per split (max lands in the last bin)."""
    res = pred.select("split", (F.col("actual") - F.col("predicted")).alias("residual"))
    rng = res.groupBy("split").agg(F.min("residual").alias("lo"), F.max("residual").alias("hi"))
    # one row per split: a bounded broadcast
    j = res.join(F.broadcast(rng), "split")
    b = F.when(F.col("hi") > F.col("lo"),
               F.least(F.width_bucket("residual", "lo", "hi", F.lit(bins)), F.lit(bins))
               ).otherwise(F.lit(1))
    counts = j.withColumn("bin", b).groupBy("split", "bin").agg(F.count(F.lit(1)).alias("count"))
    every = rng.select("split", "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return (every.join(F.broadcast(counts), ["split", "bin"], "left")  # at most splits x bins rows
            .withColumn("bin_start", F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins)
            .select("split", "bin", "bin_start", F.coalesce("count", F.lit(0).cast("long")).alias("count")))


def summary(spark: SparkSession, fit: Fit, met: DataFrame) -> DataFrame:
    """One-row run record: best round, trees, feature count, rows and metrics."""
    trees = len(fit.model.stages[-1].trees)
    piv = met.groupBy().pivot("split", ["train", "val", "test"]).agg(
        F.first("rows").alias("rows"), F.round(F.first("rmse"), 4).alias("rmse"),
        F.round(F.first("mae"), 4).alias("mae"), F.round(F.first("r2"), 4).alias("r2"),
        F.round(F.first("mape"), 4).alias("mape"))
    return piv.select(F.lit(fit.rounds).alias("best_round"), F.lit(trees).alias("trees"), F.lit(len(fit.features)).alias("n_features"), "*")


def _arr_mean(a):
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)


def _arr_std(a, ddof: int):
    m = _arr_mean(a)
    ss = F.aggregate(a, F.lit(0.0), lambda s, x: s + (x - m) * (x - m))
    n = F.size(a)
    return F.when(n > ddof, F.sqrt(ss / (n - ddof))).otherwise(F.lit(0.0))


def forecast(spark: SparkSession, fit: Fit, feature_frame: DataFrame, horizon: int = HORIZON,
             target: str = TARGET, std: str = "sample") -> DataFrame:
    """Recursive ``horizon``-day forecast for every series.

    Per series the state is the last 28 target values (own predictions
    appended), the last traffic values and the 7-row means of all other
    features; each step builds the next day's features from it with array
    functions, scores them with the fitted pipeline and appends the clamped
    prediction.
    """
    keys = list(fit.keys)
    shared_dir(spark)
    ddof = 0 if std == "pop" else 1
    w = TS._w(keys)
    fr = feature_frame.withColumn("_rk", F.row_number().over(w.orderBy(F.desc("event_date"))))
    recent = fr.where(F.col("_rk") <= HISTORY)
    traffic = {f"sessions_lag_{k}": ("total_sessions", k) for k in TS.TRAFFIC_LAGS}
    traffic.update({f"unique_visitors_lag_{k}": ("unique_visitors", k) for k in TS.TRAFFIC_LAGS})
    derived = set(traffic) | {f"revenue_lag_{k}" for k in TS.TARGET_LAGS} | {
        f"revenue_roll_{m}_{w}" for m in ("mean", "std", "max") for w in TS.ROLL_WINDOWS} | {
        "year", "month", "day", "day_of_week", "day_of_year", "week_of_year", "is_weekend",
        "quarter", "month_sin", "month_cos", "dow_sin", "dow_cos"}
    const = [c for c in fit.features if c not in derived]
    aggs = [F.max("event_date").alias("last_date"),
            F.transform(F.array_sort(F.collect_list(F.struct("event_date", F.col(target).cast("double")
                                                                .alias("y")))), lambda s: s["y"]).alias("hist")]
    aggs += [F.max(F.when(F.col("_rk") == k, F.col(src))).alias(name) for name, (src, k) in traffic.items()]
    aggs += [F.avg(F.when(F.col("_rk") <= CONST_WINDOW, F.col(c))).alias(c) for c in const]
    state = recent.groupBy(*keys).agg(*aggs).checkpoint()
    outs = []
    for h in range(1, horizon + 1):
        d = F.date_add("last_date", 1)
        hist = F.col("hist")
        n = F.size(hist)
        cols = [F.col(c) for c in keys] + [F.col("last_date"), hist, d.alias("event_date")]
        cols += [F.col(c) for c in list(traffic) + const]
        for k in TS.TARGET_LAGS:
            cols.append(F.when(n >= k, F.element_at(hist, -k)).otherwise(F.lit(0.0)).alias(f"revenue_lag_{k}"))
        for wdt in TS.ROLL_WINDOWS:
            chunk = F.when(n >= wdt, F.slice(hist, -wdt, wdt)).otherwise(hist)
            cols += [_arr_mean(chunk).alias(f"revenue_roll_mean_{wdt}"),
                     _arr_std(chunk, ddof).alias(f"revenue_roll_std_{wdt}"),
                     F.array_max(chunk).alias(f"revenue_roll_max_{wdt}")]
        step = TS.cyclical_features(TS.calendar_features(state.select(*cols)))
        scored = fit.model.transform(step)
        pred = F.greatest(F.col("prediction"), F.lit(0.0))
        nxt = scored.select(*keys, "event_date", pred.alias("predicted_revenue"),
                            *[F.col(c) for c in list(traffic) + const], "hist")
        nxt = nxt.withColumn("hist", F.slice(F.concat("hist", F.array("predicted_revenue")),
                                             -HISTORY, HISTORY)).checkpoint()
        outs.append(nxt.select(*keys, "event_date", "predicted_revenue", F.lit(h).alias("horizon")))
        state = nxt.withColumnRenamed("event_date", "last_date")
    res = outs[0]
    for o in outs[1:]:
        res = res.unionByName(o)
    return res


def history_and_forecast(feature_frame: DataFrame, fc: DataFrame, keys: Sequence[str] = (),
                         target: str = TARGET, days: int = HIST_PLOT_DAYS) -> DataFrame:
    w = TS._w(keys).orderBy(F.desc("event_date"))
    hist = (feature_frame.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= days)
            .select(*keys, "event_date", F.col(target).alias("value"), F.lit("actual").alias("kind")))
    return hist.unionByName(fc.select(*keys, "event_date", F.col("predicted_revenue").alias("value"),
                                      F.lit("forecast").alias("kind")))


def save(fit: Fit, met: DataFrame, path: str) -> None:
    """Persist the fitted pipeline and its metrics (one JSON file)."""
    fit.model.write().overwrite().save(f"{path}/model")
    met.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


# -- one fitted model per (session, input) for the registered queries -------
_CACHE: dict = {}


def fitted(spark: SparkSession, sf_dir: str, keys: Sequence[str] = (), leakage: str = "reference") -> Fit:
    from bazaar.plans.features import model_frame
    k = (spark.sparkContext.applicationId, sf_dir, tuple(keys))
    if (*k, leakage) not in _CACHE:
        shared_dir(spark)
        # the frame is scanned by training, scoring and the forecast: store it
        # once (reliable checkpoint in the shared folder) instead of
        # recomputing the whole gold -> feature lineage each time
        if k not in _CACHE:
            _CACHE[k] = model_frame(spark, sf_dir, keys).checkpoint()
        _CACHE[*k, leakage] = train(_CACHE[k], keys=keys, leakage=leakage)
    return _CACHE[*k, leakage]
