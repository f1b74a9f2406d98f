"""Registry of named queries (Spark) and their DuckDB oracle texts."""

from __future__ import annotations

from functools import partial

from bazaar import oracle as O
from bazaar.operators.gold import GOLD
from bazaar.plans import medallion as M
from bazaar.specs import ENTITIES

QUERIES: dict = {}
ORACLE: dict = {}


def _silver(name, spark, sf_dir):
    return M.silver_table(spark, sf_dir, name)


def _gold(name, spark, sf_dir, **kw):
    return M.gold_table(spark, sf_dir, name, **kw)


for _n in ENTITIES:
    QUERIES[f"silver_{_n}"] = partial(_silver, _n)
    ORACLE[f"silver_{_n}"] = O.silver_sql(_n)

for _n in GOLD:
    QUERIES[f"gold_{_n}"] = partial(_gold, _n)
    ORACLE[f"gold_{_n}"] = O.gold_sql(_n)

QUERIES["gold_daily_sales_approx"] = partial(_gold, "daily_sales", distinct="approx")


def _serving():
    from bazaar.operators import serving as S

    g = M.gold_table
    table = {
        "serving_sales_kpi": lambda s, d: M.sales_kpi(s, d),
        "serving_headline": lambda s, d: S.headline(M.sales_kpi(s, d)),
        "serving_sales_window": lambda s, d: S.sales_window(M.sales_kpi(s, d)),
        "serving_sales_display": lambda s, d: S.to_display(M.sales_kpi(s, d), S.DISPLAY_TZ),
        "serving_sentiment": lambda s, d: S.sentiment_distribution(g(s, d, "review_analytics")),
        "serving_inventory_alert": lambda s, d: S.inventory_alert(g(s, d, "inventory_kpi")),
        "serving_inventory_status": lambda s, d: S.inventory_status_distribution(
            S.inventory_alert(g(s, d, "inventory_kpi"))),
        "serving_sources": lambda s, d: S.sessions_by_source(g(s, d, "traffic_kpi")),
        "serving_customer_metrics": lambda s, d: M.customer_metrics(s, d),
        "serving_top_customers": lambda s, d: S.top_customers(M.silver_table(s, d, "orders"), M.silver_table(s, d, "payments")),
        "serving_fraud_alerts": lambda s, d: S.fraud_alert(M.silver_table(s, d, "payments")),
        "serving_delivery": lambda s, d: S.delivery_kpi(g(s, d, "shipping_kpi")),
    }
    sql = O.serving_sql()
    for k, fn in table.items():
        QUERIES[k] = fn
        ORACLE[k] = sql[k]


_serving()


def _features():
    from bazaar.operators import rollups as R
    from bazaar.operators import timeseries as TS
    from bazaar.plans import features as FP

    g = M.gold_table
    roll = {
        "rollup_traffic_daily": (R.traffic_daily, "traffic_kpi"),
        "rollup_payment_daily": (R.payment_daily, "payment_analytics"),
        "rollup_inventory_daily": (R.inventory_daily, "inventory_kpi"),
        "rollup_returns_daily": (R.returns_daily, "returns_kpi"),
        "rollup_reviews_daily": (R.reviews_daily, "review_analytics"),
    }
    def shown(df):
        """Means to six places, as the oracle compares them."""
        return TS.round_doubles(df, 6, [c for c in df.columns if c.startswith("avg_")])

    table = {k: (lambda s, d, fn=fn, src=src: shown(fn(R.normalize_event_date(g(s, d, src)))))
             for k, (fn, src) in roll.items()}

    def lag_columns(ft):
        df = TS.traffic_lag_features(TS.lag_features(ft, "total_revenue"))
        return df.select("event_date", "total_revenue", *[c for c in df.columns if "_lag_" in c])

    def rolling_columns(ft):
        df = TS.rolling_features(ft, "total_revenue")
        return TS.round_doubles(df.select("event_date", *[c for c in df.columns if "_roll_" in c]), 4)

    def ratio_columns(ft):
        return TS.round_doubles(TS.ratio_features(ft).select(
            "event_date", "conversion_rate", "return_rate", "avg_revenue_per_order", "revenue_per_visitor"), 6)

    def aligned(s, d):
        return FP.feature_table(s, d, gold=FP.aligned_gold)

    def calendar(s, d):
        df = TS.cyclical_features(TS.calendar_features(FP.feature_table(s, d)))
        cyc = ["month_sin", "month_cos", "dow_sin", "dow_cos"]
        return TS.round_doubles(df.select("event_date", "year", "month", "day", "day_of_week",
                                          "day_of_year", "week_of_year", "is_weekend", "quarter",
                                          *cyc), 6, cyc)

    table.update({
        "feature_table": lambda s, d: shown(FP.feature_table(s, d)),
        "calendar_features": calendar,
        "lag_features": lambda s, d: lag_columns(FP.feature_table(s, d)),
        "rolling_features": lambda s, d: rolling_columns(FP.feature_table(s, d)),
        "ratio_features": lambda s, d: ratio_columns(FP.feature_table(s, d)),
        "aligned_feature_table": lambda s, d: shown(aligned(s, d)),
        "aligned_lag_features": lambda s, d: lag_columns(aligned(s, d)),
        "aligned_rolling_features": lambda s, d: rolling_columns(aligned(s, d)),
        "aligned_ratio_features": lambda s, d: ratio_columns(aligned(s, d)),
        "ts_split": lambda s, d: FP.model_frame(s, d).select("event_date", "rn", "n_rows", "split"),
        "ts_split_summary": lambda s, d: TS.split_summary(FP.model_frame(s, d)),
        "product_rolling_features": FP.product_rolling,
        "date_normalize": FP.date_normalize,
    })
    sql = O.features_sql()
    for k, fn in table.items():
        QUERIES[k] = fn
        ORACLE[k] = sql[k]


_features()


def _bronze():
    from bazaar.plans import bronze_jobs as BJ

    sql = O.bronze_sql()
    for n in ENTITIES:
        QUERIES[f"bronze_roundtrip_{n}"] = partial(lambda name, s, d: BJ.roundtrip_silver(s, d, name), n)
    QUERIES["bronze_events_parse"] = BJ.events_parse
    QUERIES["bronze_rejects"] = BJ.rejects_demo
    QUERIES.update({"wire_subsecond_payments": BJ.subsecond_payments, "bronze_enriched_orders": BJ.enriched_orders,
                    "csv_like_order_items": BJ.csv_like_order_items, "fine_means": BJ.fine_means})
    for n in ("order_items", "payments"):
        QUERIES[f"wire_reference_{n}"] = partial(lambda name, s, d: BJ.dated_silver(s, d, name), n)
    sql |= O.wire_sql()
    for k in sql:
        ORACLE[k] = sql[k]


_bronze()


def _journey():
    from bazaar.operators import journey as J
    from bazaar.operators import quality as Q
    from bazaar.operators.gold import GOLD as _G

    def journey(s, d):
        return J.order_journey(M.all_silver(s, d, [st[0] for st in J.STEPS], keep=J.USES))

    def log(s, d):
        sil = M.all_silver(s, d, keep=J.USES)
        return J.daily_event_counts(J.event_log(J.order_journey(sil), sil))

    table = {
        "order_journey": journey,
        "journey_funnel": lambda s, d: J.journey_funnel(journey(s, d)),
        "daily_event_log": log,
        "readiness": lambda s, d: Q.readiness({t: M.gold_table(s, d, t) for t in _G}),
    }
    sql = O.journey_sql()
    for k, fn in table.items():
        QUERIES[k] = fn
        ORACLE[k] = sql[k]
    QUERIES["replay_log"] = M.replay_log
    ORACLE["replay_log"] = sql["replay_log"]


_journey()


def _streams():
    from bazaar.plans import stream_runs as SR

    QUERIES["stream_silver_order_items"] = lambda s, d: SR.stream_silver(s, d, "order_items")
    ORACLE["stream_silver_order_items"] = O.silver_sql("order_items")
    QUERIES["stream_dedup_watermark"] = lambda s, d: SR.stream_silver(
        s, d, "order_items", duplicate_every=10, watermark="30 days")
    ORACLE["stream_dedup_watermark"] = O.silver_sql("order_items")
    QUERIES["stream_gold_daily_sales"] = lambda s, d: SR.stream_gold_exact(s, d, "daily_sales")
    ORACLE["stream_gold_daily_sales"] = O.gold_sql("daily_sales")
    for n in ("order_items", "payments"):
        QUERIES[f"stream_reference_{n}"] = partial(lambda name, s, d: SR.stream_reference(s, d, name), n)
    QUERIES["stream_survivors_shipments"] = SR.stream_survivors
    for t in GOLD:
        QUERIES[f"stream_update_{t}"] = partial(lambda table, s, d: SR.stream_update(s, d, table), t)
    QUERIES.update({"stream_sales_kpi": SR.stream_sales_kpi, "stream_late_orders": SR.stream_late,
                    "stream_quarantine": SR.stream_quarantine, "stream_evolution": SR.stream_evolution})
    ORACLE.update(O.stream_sql())
    # stateful complete mode with HyperLogLog distinct counts: rows-only check
    QUERIES["stream_gold_daily_sales_approx"] = lambda s, d: SR.stream_gold_complete(s, d, "daily_sales")


_streams()


def _forecast():
    from bazaar.plans import forecast as FC

    def fit(s, d):
        return FC.fitted(s, d)

    def preds(s, d):
        return FC.predictions(fit(s, d))

    def fc30(s, d):
        f = fit(s, d)
        return FC.forecast(s, f, f.frame)

    # model outputs: no SQL twin (tree ensembles) -> rows-only checks
    QUERIES.update({
        "forecast_metrics": lambda s, d: FC.metrics(preds(s, d)),
        "forecast_summary": lambda s, d: FC.summary(s, fit(s, d), FC.metrics(preds(s, d))),
        "forecast_importance": lambda s, d: FC.importance(s, fit(s, d)),
        "forecast_actual_vs_pred": lambda s, d: preds(s, d).where("split IN ('val', 'test')"),
        "forecast_residual_hist": lambda s, d: FC.residual_histogram(
            preds(s, d).where("split IN ('val', 'test')")),
        "forecast_30d": fc30,
        "forecast_history_plot": lambda s, d: FC.history_and_forecast(fit(s, d).frame, fc30(s, d)),
    })


_forecast()


def _recommend():
    from bazaar.plans import recommend as RC

    # factor models: no SQL twin -> rows-only checks
    QUERIES.update({
        "als_factors": lambda s, d: RC.factor_summary(RC.fitted(s, d)),
        "als_scores": lambda s, d: RC.score(RC.fitted(s, d), RC.explicit_ratings(s, d)),
        "als_implicit_scores": lambda s, d: RC.score(RC.fitted(s, d, implicit=True),
                                                     RC.implicit_purchases(s, d)),
        "stream_als_scores": RC.stream_scores,
    })


_recommend()


def _graded_models():
    from pyspark.sql import functions as F

    from bazaar.operators import timeseries as TS
    from bazaar.plans import features as FP
    from bazaar.plans import forecast as FC
    from bazaar.plans import recommend as RC

    def lagged(s, d):
        return FC.lag_predictions(FP.model_frame(s, d))

    def calendar(s, d):
        f = FC.fitted(s, d)
        return FC.forecast(s, f, f.frame).select("event_date", "horizon", (F.col("predicted_revenue") >= 0).alias("non_negative"))

    def pairs(s, d):
        scored = RC.score(RC.fitted(s, d), RC.explicit_ratings(s, d))
        return scored.groupBy("customer_id", "product_id").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(~F.isnan("prediction")).alias("n_finite"))

    def close(s, d):
        year = F.year("event_date").alias("year")
        sums = [F.sum(c).alias(c) for c in ("total_orders", "total_products")]
        exact, approx = (_gold("daily_sales", s, d, distinct=m).groupBy(year).agg(*sums) for m in ("exact", "approx"))
        near = [F.abs(F.col(f"a.{c}") - F.col(f"e.{c}")) <= 0.1 * F.col(f"e.{c}") for c in ("total_orders", "total_products")]
        return exact.alias("e").join(approx.alias("a"), "year").select("year", (near[0] & near[1]).alias("close"))

    def recursion(s, d):
        frame = FP.model_frame(s, d)
        out = FC.forecast(s, FC.lag_fit(frame), frame).select("event_date", "horizon", "predicted_revenue")
        return TS.round_doubles(out, 4, ["predicted_revenue"])

    QUERIES.update({
        "forecast_lag7": recursion,
        "als_factor_counts": lambda s, d: RC.factor_summary(RC.fitted(s, d)),
        "als_scored_pairs": pairs,
        "forecast_calendar": calendar,
        "forecast_summary_safe": lambda s, d: FC.summary(
            s, FC.fitted(s, d, leakage="safe"), FC.metrics(FC.predictions(FC.fitted(s, d, leakage="safe")))),
        "gold_approx_within_10pct": close,
        "lag_forecast": lagged,
        "lag_forecast_metrics": lambda s, d: TS.round_doubles(TS.round_doubles(
            FC.metrics(lagged(s, d)), 6, ["r2"]), 4, ["rmse", "mae", "mape"]),
        "lag_forecast_residual_hist": lambda s, d: TS.round_doubles(
            FC.residual_histogram(lagged(s, d).where("split <> 'train'")), 4, ["bin_start"]),
    })
    for k, text in O.model_sql().items():
        ORACLE[k] = text


_graded_models()
