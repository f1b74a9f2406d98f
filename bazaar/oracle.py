"""Reference SQL (DuckDB dialect) for every registered query.

These texts are the executable specification the Spark operators are checked
against: same inputs (the driver tables), same column names, independently
written logic (window-function de-duplication, CASE ladders, GROUP BY).
Rounded averages go through DECIMAL with ten places so both engines round
half-up on the exact value.
"""

from __future__ import annotations

from bazaar.sources.testdata import ENTITY_SQL
from bazaar.specs import ENTITIES, ID_COLUMNS


def r2avg(x: str) -> str:
    mean = f"CAST(round(CAST(avg(TRY_CAST({x} AS DECIMAL(28,10))) AS DECIMAL(28,10)), 2) AS DOUBLE)"
    return (f"CASE WHEN count(TRY_CAST({x} AS DECIMAL(28,10))) = count({x}) THEN {mean}"
            f" ELSE round(avg(CAST({x} AS DOUBLE)), 2) END")


def r2sum(x: str) -> str:
    return f"round(sum({x}), 2)"


def ratio2(n: str, d: str) -> str:
    return (f"CAST(round(CAST(CAST({n} AS DECIMAL(20,0)) / NULLIF({d}, 0) AS DECIMAL(28,8)), 2)"
            " AS DOUBLE)")


def _typed_cols(name: str) -> list[str]:
    e = ENTITIES[name]
    out = []
    for f in e.fields:
        if f in e.ints:
            out.append(f"CAST({f} AS {'BIGINT' if f in ID_COLUMNS else 'INTEGER'}) AS {f}")
        elif f in e.doubles:
            out.append(f"CAST({f} AS DOUBLE) AS {f}")
        elif f in e.dates:
            out.append(f"CAST({f} AS DATE) AS {f}")
        else:
            out.append(f"CAST({f} AS VARCHAR) AS {f}")
    out.append("event_timestamp")
    out.append("CAST(event_timestamp AS DATE) AS event_date")
    return out


_FILTERS = {
    "orders": "order_id IS NOT NULL",
    "order_items": "order_id IS NOT NULL AND product_id IS NOT NULL",
    "payments": "payment_value > 0",
    "reviews": "rating BETWEEN 1 AND 5",
}

_DERIVED = {
    "orders": [],
    "order_items": ["price + freight_value AS item_total"],
    "payments": [
        "CASE WHEN payment_value >= 500 THEN 'HIGH_VALUE' ELSE 'NORMAL' END AS payment_category",
        "CAST(CASE WHEN payment_value >= 2000 THEN 1 ELSE 0 END AS INTEGER) AS fraud_flag"],
    "reviews": [
        "CASE WHEN rating >= 4 THEN 'POSITIVE' WHEN rating = 3 THEN 'NEUTRAL' "
        "ELSE 'NEGATIVE' END AS review_sentiment"],
    "shipments": [
        "CAST(date_diff('day', ship_date, delivery_date) AS INTEGER) AS delivery_days",
        "CASE WHEN date_diff('day', ship_date, delivery_date) <= 2 THEN 'FAST' "
        "WHEN date_diff('day', ship_date, delivery_date) <= 5 THEN 'NORMAL' "
        "ELSE 'DELAYED' END AS shipping_status"],
    "returns": ["CAST(1 AS INTEGER) AS return_flag"],
    "inventory": [
        "CASE WHEN stock_on_hand <= 0 THEN 'STOCKOUT' WHEN stock_on_hand <= 20 THEN 'LOW_STOCK' "
        "WHEN stock_on_hand >= 500 THEN 'OVERSTOCK' ELSE 'NORMAL' END AS inventory_status"],
    "traffic": [
        f"{ratio2('page_views', 'sessions')} AS pages_per_session",
        "CASE WHEN sessions >= 1000 THEN 'HIGH' ELSE 'NORMAL' END AS traffic_quality"],
}


def silver_sql(name: str) -> str:
    """Silver table as a DuckDB query (survivor: smallest row, NULLs first)."""
    e = ENTITIES[name]
    cols = list(e.fields) + ["event_timestamp", "event_date"]
    rest = [c for c in cols if c not in e.dedup_keys]
    where = f"WHERE {_FILTERS[name]}" if name in _FILTERS else ""
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    derived = "".join(f", {d}" for d in _DERIVED[name])
    return (
        f"SELECT {', '.join(cols)}{derived}, 'silver' AS silver_layer FROM ("
        f" SELECT *, row_number() OVER (PARTITION BY {', '.join(e.dedup_keys)} ORDER BY {order}) AS rn"
        f" FROM (SELECT * FROM (SELECT {', '.join(_typed_cols(name))} FROM ({ENTITY_SQL[name]}) src) t"
        f" {where}) f) d WHERE rn = 1")


def _cd(c: str) -> str:
    return f"count(DISTINCT {c})"


GOLD_SQL_BODY = {
    "daily_sales": ("order_items", ["event_date"], [
        f"{r2sum('price')} AS gross_revenue", f"{r2sum('freight_value')} AS shipping_revenue",
        f"{r2sum('item_total')} AS total_revenue", f"{_cd('order_id')} AS total_orders",
        f"{_cd('product_id')} AS total_products", f"{r2avg('item_total')} AS avg_order_value"]),
    "top_products": ("order_items", ["event_date", "product_id"], [
        "count(*) AS items_sold", f"{r2sum('item_total')} AS product_revenue",
        f"{r2avg('price')} AS avg_price"]),
    "seller_performance": ("order_items", ["event_date", "seller_id"], [
        f"{_cd('order_id')} AS total_orders", f"{r2sum('item_total')} AS seller_revenue"]),
    "payment_analytics": ("payments", ["event_date", "payment_method"], [
        "count(*) AS total_transactions", f"{r2sum('payment_value')} AS payment_total",
        f"{r2avg('payment_value')} AS avg_payment", "CAST(sum(fraud_flag) AS BIGINT) AS fraud_transactions"]),
    "review_analytics": ("reviews", ["event_date", "review_sentiment"], [
        "count(*) AS total_reviews", f"{r2avg('rating')} AS avg_rating"]),
    "shipping_kpi": ("shipments", ["event_date", "shipping_status"], [
        "count(*) AS total_shipments", f"{r2avg('delivery_days')} AS avg_delivery_days",
        f"{r2avg('shipping_fee')} AS avg_shipping_fee"]),
    "inventory_kpi": ("inventory", ["event_date", "inventory_status"], [
        "count(*) AS total_products", f"{r2avg('stock_on_hand')} AS avg_stock",
        "CAST(sum(units_sold) AS BIGINT) AS units_sold"]),
    "traffic_kpi": ("traffic", ["event_date", "traffic_source"], [
        "CAST(sum(sessions) AS BIGINT) AS total_sessions", "CAST(sum(unique_visitors) AS BIGINT) AS unique_visitors",
        "CAST(sum(page_views) AS BIGINT) AS page_views", f"{r2avg('pages_per_session')} AS avg_pages_per_session"]),
    "returns_kpi": ("returns", ["event_date"], [
        "count(*) AS total_returns", f"{_cd('order_id')} AS returned_orders",
        f"{_cd('product_id')} AS returned_products"]),
}


def gold_sql(name: str) -> str:
    src, keys, aggs = GOLD_SQL_BODY[name]
    k = ", ".join(keys)
    return (f"SELECT {k}, {', '.join(aggs)}, 'gold' AS gold_layer "
            f"FROM ({silver_sql(src)}) s GROUP BY {k}")


def share_sql(c: str, alias: str = "share_pct") -> str:
    return (f"CAST(round(CAST(CAST({c} AS DECIMAL(38,0)) * 100 / sum({c}) OVER () AS DECIMAL(28,8)), 2)"
            f" AS DOUBLE) AS {alias}")


SALES_KPI_SQL = (
    "SELECT date_trunc('day', event_timestamp) AS window_start,"
    " date_trunc('day', event_timestamp) + INTERVAL 1 DAY AS window_end,"
    f" {r2sum('item_total')} AS total_revenue, count(DISTINCT order_id) AS total_orders,"
    f" {r2avg('item_total')} AS avg_order_value"
    f" FROM ({silver_sql('order_items')}) s GROUP BY 1, 2")

CUSTOMER_METRICS_SQL = (
    "SELECT customer_id, count(*) AS total_orders,"
    " coalesce(round(sum(paid), 2), 0) AS total_spent,"
    " CAST(coalesce(sum(n_payments), 0) AS BIGINT) AS total_payments,"
    " min(order_date) AS first_order_date, max(order_date) AS last_order_date"
    f" FROM (SELECT order_id, customer_id, order_date FROM ({silver_sql('orders')}) so"
    "        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_date NULLS FIRST,"
    "          customer_id NULLS FIRST) = 1) o"
    f" LEFT JOIN (SELECT order_id, sum(payment_value) AS paid, count(*) AS n_payments"
    f"       FROM ({silver_sql('payments')}) sp GROUP BY order_id) p USING (order_id)"
    " GROUP BY customer_id")


def serving_sql() -> dict[str, str]:
    inv_alert = (f"SELECT event_date, inventory_status, total_products, avg_stock, units_sold"
                 f" FROM ({gold_sql('inventory_kpi')}) g"
                 " WHERE inventory_status IN ('STOCKOUT', 'LOW_STOCK', 'OVERSTOCK')")
    return {
        "serving_sales_kpi": SALES_KPI_SQL,
        "serving_headline": (
            "SELECT coalesce(round(sum(total_revenue), 2), 0) AS total_revenue,"
            " CAST(coalesce(sum(total_orders), 0) AS BIGINT) AS total_orders,"
            f" coalesce({r2avg('avg_order_value')}, 0) AS avg_order_value FROM ({SALES_KPI_SQL}) k"),
        "serving_sales_window": f"SELECT window_start, total_revenue FROM ({SALES_KPI_SQL}) k",
        # display form: local time of a UTC+7 zone without daylight saving
        "serving_sales_display": (
            "SELECT strftime(window_start + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS window_start,"
            " strftime(window_end + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,"
            f" total_revenue, total_orders, avg_order_value FROM ({SALES_KPI_SQL}) k"),
        "serving_sentiment": (
            f"SELECT review_sentiment, total_reviews, {share_sql('total_reviews')} FROM ("
            " SELECT review_sentiment, CAST(sum(total_reviews) AS BIGINT) AS total_reviews"
            f" FROM ({gold_sql('review_analytics')}) g GROUP BY review_sentiment) x"),
        "serving_inventory_alert": inv_alert,
        "serving_inventory_status": (
            f"SELECT inventory_status, total_products, {share_sql('total_products')} FROM ("
            " SELECT inventory_status, CAST(sum(total_products) AS BIGINT) AS total_products"
            f" FROM ({inv_alert}) a GROUP BY inventory_status) x"),
        "serving_sources": (
            f"SELECT traffic_source, total_sessions, {share_sql('total_sessions')} FROM ("
            " SELECT traffic_source, CAST(sum(total_sessions) AS BIGINT) AS total_sessions"
            f" FROM ({gold_sql('traffic_kpi')}) g GROUP BY traffic_source) x"),
        "serving_customer_metrics": CUSTOMER_METRICS_SQL,
        "serving_top_customers": (
            f"SELECT * FROM ({CUSTOMER_METRICS_SQL}) c ORDER BY total_orders DESC, customer_id ASC LIMIT 10"),
        "serving_fraud_alerts": (
            "SELECT order_id, payment_method, payment_value, installments, payment_category,"
            f" event_timestamp, event_date FROM ({silver_sql('payments')}) p WHERE fraud_flag = 1"),
        "serving_delivery": (
            "SELECT event_date, shipping_status, total_shipments, avg_delivery_days, avg_shipping_fee"
            f" FROM ({gold_sql('shipping_kpi')}) g"),
    }


# --- daily roll-ups, feature table, time-series features --------------------
def avg6(x: str) -> str:
    return f"round(avg({x}), 6)"


def i64sum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


ROLLUPS = {
    "traffic_daily": ("traffic_kpi", [
        f"{i64sum('total_sessions')} AS total_sessions", f"{i64sum('unique_visitors')} AS unique_visitors",
        f"{i64sum('page_views')} AS page_views", f"{avg6('avg_pages_per_session')} AS avg_pages_per_session"]),
    "payment_daily": ("payment_analytics", [
        f"{i64sum('total_transactions')} AS total_transactions", "round(sum(payment_total), 2) AS payment_total",
        f"{avg6('avg_payment')} AS avg_payment", f"{i64sum('fraud_transactions')} AS fraud_transactions"]),
    "inventory_daily": ("inventory_kpi", [
        f"{i64sum('units_sold')} AS inv_units_sold", f"{avg6('avg_stock')} AS avg_stock"]),
    "returns_daily": ("returns_kpi", [
        f"{i64sum('total_returns')} AS total_returns", f"{i64sum('returned_orders')} AS returned_orders"]),
    "reviews_daily": ("review_analytics", [
        f"{i64sum('total_reviews')} AS total_reviews", f"{avg6('avg_rating')} AS avg_rating"]),
}


def rollup_sql(name: str, gold=gold_sql) -> str:
    src, aggs = ROLLUPS[name]
    return f"SELECT event_date, {', '.join(aggs)} FROM ({gold(src)}) g GROUP BY event_date"


_FT_NUMERIC = {
    "ds": ["gross_revenue", "shipping_revenue", "total_revenue", "total_orders", "total_products",
           "avg_order_value"],
    "t": ["total_sessions", "unique_visitors", "page_views", "avg_pages_per_session"],
    "p": ["total_transactions", "payment_total", "avg_payment", "fraud_transactions"],
    "i": ["inv_units_sold", "avg_stock"],
    "r": ["total_returns", "returned_orders"],
    "v": ["total_reviews", "avg_rating"],
}


def aligned_gold_sql(name: str) -> str:
    """Gold with all entities' days in one span."""
    day = {"traffic_kpi": "DATE '2006-01-01' + CAST((event_date - DATE '2000-01-01') % 1461 AS INTEGER)",
           "inventory_kpi": "event_date + 1826"}.get(name, "event_date + 3653")
    return f"SELECT * REPLACE (CAST({day} AS DATE) AS event_date) FROM ({gold_sql(name)}) g"


def feature_table_sql(gold=gold_sql) -> str:
    ctes = {
        "ds": (f"SELECT * FROM ({gold('daily_sales')}) g WHERE event_date IS NOT NULL"
               " AND event_date >= DATE '2001-01-01' AND event_date < DATE '2030-01-01'"),
        "t": rollup_sql("traffic_daily", gold), "p": rollup_sql("payment_daily", gold),
        "i": rollup_sql("inventory_daily", gold), "r": rollup_sql("returns_daily", gold),
        "v": rollup_sql("reviews_daily", gold),
    }
    with_ = ", ".join(f"{k} AS ({v})" for k, v in ctes.items())
    cols = ["spine.event_date", "ds.gold_layer"]
    for alias, names in _FT_NUMERIC.items():
        cols += [f"coalesce({alias}.{c}, 0) AS {c}" for c in names]
    joins = " ".join(f"LEFT JOIN {a} ON spine.event_date = {a}.event_date" for a in _FT_NUMERIC)
    return (f"WITH {with_}, spine AS (SELECT DISTINCT event_date FROM ds) "
            f"SELECT {', '.join(cols)} FROM spine {joins}")


def _ft(body: str, gold=gold_sql) -> str:
    return f"WITH ft AS ({feature_table_sql(gold)}) {body}"


CALENDAR_SQL = _ft(
    "SELECT event_date, CAST(year(event_date) AS INTEGER) AS year, CAST(month(event_date) AS INTEGER) AS month,"
    " CAST(day(event_date) AS INTEGER) AS day, CAST(isodow(event_date) - 1 AS INTEGER) AS day_of_week,"
    " CAST(dayofyear(event_date) AS INTEGER) AS day_of_year, CAST(weekofyear(event_date) AS INTEGER) AS week_of_year,"
    " CAST(isodow(event_date) >= 6 AS INTEGER) AS is_weekend, CAST(quarter(event_date) AS INTEGER) AS quarter,"
    " round(sin(2 * pi() * month(event_date) / 12), 6) AS month_sin,"
    " round(cos(2 * pi() * month(event_date) / 12), 6) AS month_cos,"
    " round(sin(2 * pi() * (isodow(event_date) - 1) / 7), 6) AS dow_sin,"
    " round(cos(2 * pi() * (isodow(event_date) - 1) / 7), 6) AS dow_cos FROM ft")

LAG_SQL = _ft(
    "SELECT event_date, total_revenue, "
    + ", ".join(f"lag(total_revenue, {k}) OVER w AS revenue_lag_{k}" for k in (1, 2, 3, 7, 14, 28))
    + ", " + ", ".join(f"lag(total_sessions, {k}) OVER w AS sessions_lag_{k}, "
                       f"lag(unique_visitors, {k}) OVER w AS unique_visitors_lag_{k}" for k in (1, 7))
    + " FROM ft WINDOW w AS (ORDER BY event_date)")


def _roll(target: str, n: int, prefix: str, part: str = "") -> list[str]:
    frame = f"OVER ({part}ORDER BY event_date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    full = f"count({target}) {frame} = {n}"
    return [f"CASE WHEN {full} THEN round({fn}({target}) {frame}, 4) END AS {prefix}_roll_{nm}_{n}"
            for fn, nm in (("avg", "mean"), ("stddev_samp", "std"), ("max", "max"))]


ROLLING_SQL = _ft("SELECT event_date, "
                  + ", ".join(c for n in (7, 14, 28) for c in _roll("total_revenue", n, "revenue"))
                  + " FROM ft")

RATIO_SQL = _ft(
    "SELECT event_date,"
    " round(CASE WHEN total_sessions > 0 THEN total_orders / total_sessions ELSE 0 END, 6) AS conversion_rate,"
    " round(CASE WHEN total_orders > 0 THEN returned_orders / total_orders ELSE 0 END, 6) AS return_rate,"
    " round(CASE WHEN total_orders > 0 THEN total_revenue / total_orders ELSE 0 END, 6) AS avg_revenue_per_order,"
    " round(CASE WHEN unique_visitors > 0 THEN total_revenue / unique_visitors ELSE 0 END, 6)"
    " AS revenue_per_visitor FROM ft")

# Rows survive the NULL drop once every lag/rolling window is complete: the
# 28 leading days.  Then position and size decide the split.
SPLIT_SQL = _ft(
    "SELECT event_date, CAST(rn AS INTEGER) AS rn, n_rows,"
    " CASE WHEN rn <= floor(n_rows * 0.7) THEN 'train' WHEN rn <= floor(n_rows * 0.85) THEN 'val'"
    " ELSE 'test' END AS split FROM ("
    " SELECT event_date, row_number() OVER (ORDER BY event_date) AS rn, count(*) OVER () AS n_rows FROM ("
    "  SELECT event_date FROM (SELECT event_date, row_number() OVER (ORDER BY event_date) AS k FROM ft) a"
    "  WHERE k > 28) b) c")

SPLIT_SUMMARY_SQL = (f"SELECT split, count(*) AS rows, min(event_date) AS first_date,"
                     f" max(event_date) AS last_date FROM ({SPLIT_SQL}) s GROUP BY split")

PRODUCT_ROLLING_SQL = (
    "SELECT event_date, product_id, round(product_revenue, 4) AS product_revenue,"
    " round(lag(product_revenue, 1) OVER w, 4) AS rev_lag_1, round(lag(product_revenue, 7) OVER w, 4) AS rev_lag_7, "
    + ", ".join(_roll("product_revenue", 7, "rev", "PARTITION BY product_id "))
    + f" FROM ({gold_sql('top_products')}) g WINDOW w AS (PARTITION BY product_id ORDER BY event_date)")

DATE_NORMALIZE_SQL = (
    "SELECT * FROM (SELECT order_id, date_text, CAST(coalesce(try_strptime(date_text, '%Y-%m-%d'),"
    " try_strptime(date_text, '%Y%m%d'), try_strptime(date_text, '%d/%m/%Y')) AS DATE) AS event_date FROM ("
    " SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 11 = 0 THEN 'bad'"
    "  WHEN o_orderkey % 3 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')"
    "  WHEN o_orderkey % 3 = 1 THEN strftime(CAST(o_orderdate AS DATE), '%Y%m%d')"
    "  ELSE strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') END AS date_text FROM orders) o) x"
    " WHERE event_date IS NOT NULL AND event_date >= DATE '2001-01-01' AND event_date < DATE '2030-01-01'")


def features_sql() -> dict[str, str]:
    out = {f"rollup_{k}": rollup_sql(k) for k in ROLLUPS}
    out.update({
        "feature_table": feature_table_sql(),
        "calendar_features": CALENDAR_SQL,
        "lag_features": LAG_SQL,
        "rolling_features": ROLLING_SQL,
        "ratio_features": RATIO_SQL,
        "ts_split": SPLIT_SQL,
        "ts_split_summary": SPLIT_SUMMARY_SQL,
        "product_rolling_features": PRODUCT_ROLLING_SQL,
        "date_normalize": DATE_NORMALIZE_SQL,
        "aligned_feature_table": feature_table_sql(aligned_gold_sql),
        **{f"aligned_{n}": t.replace(feature_table_sql(), feature_table_sql(aligned_gold_sql))
           for n, t in (("lag_features", LAG_SQL), ("rolling_features", ROLLING_SQL), ("ratio_features", RATIO_SQL))},
    })
    return out


def bronze_sql() -> dict[str, str]:
    out = {f"bronze_roundtrip_{n}": silver_sql(n) for n in ENTITIES}
    out["bronze_events_parse"] = (
        "SELECT event_id, CAST(ts AS TIMESTAMP) AS kafka_timestamp, props AS raw_json,"
        " json_extract_string(props, '$.k') AS k,"
        " TRY_CAST(regexp_extract(trim(json_extract_string(props, '$.k')), '^([+-]?\\d+)(\\.\\d*)?$', 1)"
        " AS INTEGER) AS k_int FROM events")
    out["bronze_rejects"] = (
        "SELECT l_orderkey * 8 + l_linenumber AS offset,"
        " CASE WHEN l_orderkey % 13 = 0 THEN concat('{\"order_id\": ', l_orderkey, ', \"price\": ')"
        " ELSE '{\"unknown\": 1}' END AS raw_json, 'order_items_topic' AS topic"
        " FROM lineitem WHERE l_orderkey % 13 = 0 OR l_orderkey % 17 = 0")
    return out


_EVENT_PAYMENTS = (
    "SELECT event_id AS order_id, event_type AS payment_method, value AS payment_value, 1 AS installments,"
    " CAST(ts AS TIMESTAMP) AS event_timestamp FROM events")


# Order items and payments as a producer sends them, without a time: the order's
# date, NULL for orders that are not on the topic; (partition, offset) by order.
_REFERENCE_WIRE = {
    "order_items": ("lineitem", "l_orderkey", "l_orderkey * 8 + l_linenumber",
                    "l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,"
                    " l_extendedprice AS price, CAST(l_quantity AS DOUBLE) AS freight_value"),
    "payments": ("orders", "o_orderkey", "o_orderkey",
                 "o_orderkey AS order_id, o_orderpriority AS payment_method,"
                 " CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 300000 AS DOUBLE) / 100 AS payment_value,"
                 " CAST(o_orderkey % 12 + 1 AS INT) AS installments"),
}


def dated_silver_sql(name: str) -> str:
    """Silver of rows dated by their order; the first of the log survives."""
    table, key, place, cols = _REFERENCE_WIRE[name]
    e = ENTITIES[name]
    where = f"WHERE {_FILTERS[name]}" if name in _FILTERS else ""
    derived = "".join(f", {d}" for d in _DERIVED[name])
    rest = "".join(f", {c} NULLS FIRST" for c in e.fields if c not in e.dedup_keys)
    return (
        f"SELECT {', '.join(e.fields)}, event_timestamp, event_date{derived}, 'silver' AS silver_layer FROM ("
        f" SELECT *, row_number() OVER (PARTITION BY {', '.join(e.dedup_keys)} ORDER BY place{rest}) AS rn FROM ("
        f"  SELECT w.*, t.event_timestamp, CAST(t.event_timestamp AS DATE) AS event_date FROM"
        f"  (SELECT {cols}, {place} AS place FROM {table}) w LEFT JOIN"
        f"  (SELECT o_orderkey AS known, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS event_timestamp FROM orders"
        f"   WHERE o_orderkey % 50 <> 0) t ON w.order_id = t.known) d {where}) s WHERE rn = 1")


_PLACED_SHIPMENTS = (
    "SELECT l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS ship_date, CASE WHEN l_quantity = 1 THEN NULL"
    " ELSE CAST(l_shipdate AS DATE) + CAST(l_linenumber - 2 AS INT) END AS delivery_date,"
    " CAST(l_quantity AS DOUBLE) / 2 AS shipping_fee, CAST(l_shipdate AS TIMESTAMP) AS event_timestamp,"
    " CAST(l_shipdate AS DATE) AS event_date, l_orderkey * 8 + l_linenumber AS place FROM lineitem")


def stream_sql() -> dict[str, str]:
    """Results of the stream runs over several micro-batches."""
    out = {f"stream_reference_{n}": dated_silver_sql(n) for n in _REFERENCE_WIRE}
    derived = "".join(f", {d}" for d in _DERIVED["shipments"])
    out["stream_survivors_shipments"] = (
        f"SELECT * EXCLUDE (place, rn){derived}, 'silver' AS silver_layer FROM (SELECT *, row_number() OVER"
        " (PARTITION BY order_id, event_timestamp ORDER BY place, ship_date NULLS FIRST, delivery_date NULLS FIRST,"
        f" shipping_fee NULLS FIRST) AS rn FROM ({_PLACED_SHIPMENTS}) p) s WHERE rn = 1")
    unsure = {"daily_sales": "total_orders, total_products", "seller_performance": "total_orders",
              "returns_kpi": "returned_orders, returned_products"}
    for t in GOLD_SQL_BODY:
        less = f" EXCLUDE ({unsure[t]})" if t in unsure else ""
        out[f"stream_update_{t}"] = f"SELECT *{less} FROM ({gold_sql(t)}) g"
    out["stream_sales_kpi"] = SALES_KPI_SQL
    out["stream_late_orders"] = (
        "WITH o AS (SELECT order_id, event_timestamp, CASE WHEN order_id % 10 = 0 THEN 9999"
        f" ELSE year(event_timestamp) END AS turn FROM ({silver_sql('orders')}) s),"
        " marks AS (SELECT turn, max(max(event_timestamp)) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING"
        " AND 1 PRECEDING) AS largest FROM o GROUP BY turn)"
        " SELECT order_id, event_timestamp, CASE WHEN event_timestamp < largest - INTERVAL 30 DAY THEN 'late'"
        " ELSE 'on time' END AS reason FROM o JOIN marks USING (turn)")
    out["stream_evolution"] = (
        "SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(payment_value AS VARCHAR) AS payment_value,"
        " CASE WHEN order_id % 2 = 0 THEN 'none' WHEN order_id % 5 <> 0 THEN 'C' || (order_id % 10) END AS coupon,"
        f" CAST(event_timestamp AS DATE) AS event_date FROM ({ENTITY_SQL['payments']}) p")
    out["stream_quarantine"] = (
        "SELECT l_orderkey * 8 + l_linenumber AS offset, l_orderkey % 13 = 0 OR l_orderkey % 17 = 0 AS rejected,"
        " CASE WHEN l_orderkey % 13 = 0 THEN '{\"order_id\": ' || l_orderkey || ', \"price\": '"
        " WHEN l_orderkey % 17 = 0 THEN '{\"unknown\": 1}'"
        " ELSE '{\"order_id\":\"' || l_orderkey || '\",\"product_id\":\"' || l_partkey || '\"}' END AS raw_json FROM lineitem")
    return out


def wire_sql() -> dict[str, str]:
    return {
        "wire_subsecond_payments": (
            "SELECT DISTINCT *, CAST(event_timestamp AS DATE) AS event_date,"
            " CASE WHEN payment_value >= 500 THEN 'HIGH_VALUE' ELSE 'NORMAL' END AS payment_category,"
            " CASE WHEN payment_value >= 2000 THEN 1 ELSE 0 END AS fraud_flag, 'silver' AS silver_layer"
            f" FROM ({_EVENT_PAYMENTS} UNION ALL SELECT order_id, payment_method, payment_value, installments,"
            f" event_timestamp + INTERVAL 100 MILLISECOND FROM ({_EVENT_PAYMENTS}) p) u WHERE payment_value > 0"),
        "bronze_enriched_orders": (
            "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS event_timestamp,"
            " CAST(o_orderdate AS DATE) AS event_date, 'orders_topic' AS data_source FROM orders"),
        "csv_like_order_items": (
            "SELECT order_id, product_id, seller_id, price, freight_value, true AS no_event_time FROM ("
            " SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,"
            " l_extendedprice AS price, l_quantity AS freight_value, row_number() OVER (PARTITION BY l_orderkey, l_partkey"
            " ORDER BY l_suppkey, l_extendedprice, l_quantity) AS rn FROM lineitem) x WHERE rn = 1"),
        "fine_means": (
            "SELECT l_partkey AS product_id, " + r2avg("price") + " AS avg_price FROM (SELECT l_partkey,"
            " CASE WHEN l_linenumber = 6 AND l_orderkey % 97 = 0 THEN CAST('NaN' AS DOUBLE)"
            " WHEN l_linenumber = 5 AND l_orderkey % 89 = 0 THEN CAST('Infinity' AS DOUBLE)"
            " WHEN l_linenumber = 4 AND l_orderkey % 83 = 0 THEN 4e18"
            " ELSE l_extendedprice / 1024 + 1e-12 END AS price FROM lineitem) p GROUP BY l_partkey"),
        "wire_reference_order_items": dated_silver_sql("order_items"),
        "wire_reference_payments": dated_silver_sql("payments"),
    }


def model_sql() -> dict[str, str]:
    """What of the models' outputs any engine can repeat."""
    reviews = silver_sql("reviews")
    lagged = _ft(
        "SELECT event_date, actual, predicted, CASE WHEN rn <= floor(n * 0.7) THEN 'train'"
        " WHEN rn <= floor(n * 0.85) THEN 'val' ELSE 'test' END AS split FROM ("
        "  SELECT *, row_number() OVER (ORDER BY event_date) AS rn, count(*) OVER () AS n FROM ("
        "   SELECT event_date, total_revenue AS actual, lag(total_revenue, 7) OVER (ORDER BY event_date) AS predicted,"
        "   row_number() OVER (ORDER BY event_date) AS k FROM ft) a WHERE k > 28) b")
    return {
        "als_factor_counts": (
            f"SELECT 'user' AS side, count(DISTINCT customer_id) AS n, 15 AS rank FROM ({reviews}) r UNION ALL"
            f" SELECT 'item', count(DISTINCT product_id), 15 FROM ({reviews}) r2"),
        "als_scored_pairs": (
            f"SELECT customer_id, product_id, count(*) AS n, count(*) AS n_finite FROM ({reviews}) r"
            " GROUP BY customer_id, product_id"),
        "forecast_lag7": _ft(
            "SELECT CAST(last_date + CAST(h AS INTEGER) AS DATE) AS event_date, CAST(h AS INTEGER) AS horizon,"
            " round(greatest(total_revenue, 0), 4) AS predicted_revenue FROM (SELECT max(event_date) AS last_date FROM ft) m,"
            " range(1, 31) r(h) JOIN (SELECT total_revenue, row_number() OVER (ORDER BY event_date DESC) AS back FROM ft) t"
            " ON t.back = 7 - (h - 1) % 7"),
        "forecast_calendar": (
            f"SELECT last_date + CAST(h AS INT) AS event_date, CAST(h AS INT) AS horizon, true AS non_negative FROM"
            f" (SELECT max(event_date) AS last_date FROM ({SPLIT_SQL}) s), (SELECT unnest(range(1, 31)) AS h)"),
        "gold_approx_within_10pct": (
            f"SELECT DISTINCT CAST(year(event_date) AS INTEGER) AS year, true AS close FROM ({gold_sql('daily_sales')}) g"),
        "lag_forecast": f"SELECT event_date, split, actual, predicted FROM ({lagged}) l",
        "lag_forecast_metrics": (
            "SELECT split, count(*) AS rows, round(sqrt(avg((actual - predicted) ** 2)), 4) AS rmse,"
            " round(avg(abs(actual - predicted)), 4) AS mae,"
            " round(1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*)), 6) AS r2,"
            " round(avg(abs((actual - predicted) / (actual + 1e-9))) * 100, 4) AS mape"
            f" FROM ({lagged}) l GROUP BY split"),
        "lag_forecast_residual_hist": (
            f"WITH l AS (SELECT split, actual - predicted AS r FROM ({lagged}) x WHERE split <> 'train'),"
            " e AS (SELECT split, min(r) AS lo, max(r) AS hi FROM l GROUP BY split),"
            " c AS (SELECT split, least(30, 1 + CAST(floor((r - lo) / (hi - lo) * 30) AS INT)) AS bin, count(*) AS n"
            "  FROM l JOIN e USING (split) GROUP BY ALL)"
            " SELECT e.split, CAST(b AS INT) AS bin, round(lo + (b - 1) * (hi - lo) / 30, 4) AS bin_start,"
            " coalesce(c.n, 0) AS count FROM e CROSS JOIN (SELECT unnest(range(1, 31)) AS b) s"
            " LEFT JOIN c ON c.split = e.split AND c.bin = b"),
    }


_JOURNEY_STEPS = [
    ("orders", "ORDER_CREATED", 1, "NULL", "NULL"),
    ("order_items", "ITEM_ADDED", 2, "CAST(product_id AS VARCHAR)", "item_total"),
    ("payments", "PAYMENT_COMPLETED", 3, "payment_method", "payment_value"),
    ("shipments", "SHIPMENT_CREATED", 4, "NULL", "shipping_fee"),
    ("reviews", "REVIEW_SUBMITTED", 5, "review_id", "NULL"),
    ("returns", "RETURN_REQUESTED", 6, "return_id", "NULL"),
]
_DAY_STEPS = [("inventory", "INVENTORY_UPDATED", 100, "CAST(product_id AS VARCHAR)", "NULL"),
              ("traffic", "WEB_TRAFFIC", 200, "traffic_source", "NULL")]


def _journey_part(src, et, seq, ref, amt, has_order=True):
    oid = "order_id" if has_order else "CAST(NULL AS BIGINT)"
    return (f"SELECT {oid} AS order_id, {seq} AS event_sequence, '{et}' AS event_type,"
            f" event_timestamp AS event_time, event_date, CAST({ref} AS VARCHAR) AS ref_id,"
            f" CAST({amt} AS DOUBLE) AS amount FROM ({silver_sql(src)}) s")


JOURNEY_SQL = " UNION ALL ".join(_journey_part(*s) for s in _JOURNEY_STEPS)
EVENT_LOG_SQL = JOURNEY_SQL + " UNION ALL " + " UNION ALL ".join(
    _journey_part(*s, has_order=False) for s in _DAY_STEPS)


REPLAY_SQL = (
    "SELECT j.*, s.replay_day,"
    " (((o_id % 2147483647 + 2147483647) % 2147483647) * 1640531527 + 42) % 2147483647"
    " AS replay_key FROM ("
    f"{JOURNEY_SQL}) j JOIN (SELECT order_id AS o_id, min(event_date) AS replay_day FROM ({JOURNEY_SQL}) x"
    " WHERE event_sequence = 1 GROUP BY order_id) s ON j.order_id = s.o_id")


def journey_sql() -> dict[str, str]:
    gold_tables = ["daily_sales", "top_products", "seller_performance", "payment_analytics",
                   "review_analytics", "shipping_kpi", "inventory_kpi", "traffic_kpi", "returns_kpi"]
    ready = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, max(event_date) AS max_event_date,"
        f" count(*) >= 1 AS ok FROM ({gold_sql(t)}) g{i}" for i, t in enumerate(gold_tables))
    return {
        "order_journey": JOURNEY_SQL,
        "journey_funnel": (
            "SELECT event_sequence, event_type, count(DISTINCT order_id) AS orders_reached,"
            f" count(*) AS events FROM ({JOURNEY_SQL}) j GROUP BY event_sequence, event_type"),
        "daily_event_log": (
            "SELECT event_date, event_type, event_sequence, count(*) AS events"
            f" FROM ({EVENT_LOG_SQL}) l GROUP BY event_date, event_type, event_sequence"),
        "readiness": ready,
        "replay_log": REPLAY_SQL,
    }
