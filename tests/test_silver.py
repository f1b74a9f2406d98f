import datetime as dt

from bazaar.operators import silver as S

TS = dt.datetime(2020, 1, 1)


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_payments_ladder(spark):
    vals = [None, "-1", "0", "0.01", "499.99", "500", "1999.99", "2000"]
    df = spark.createDataFrame([(str(i), "card", v, "1", TS.isoformat()) for i, v in enumerate(vals)],
                               "order_id string, payment_method string, payment_value string,"
                               " installments string, event_timestamp string")
    out = {r.payment_value: (r.payment_category, r.fraud_flag)
           for r in S.silver_payments(df).collect()}
    assert out == {0.01: ("NORMAL", 0), 499.99: ("NORMAL", 0), 500.0: ("HIGH_VALUE", 0),
                   1999.99: ("HIGH_VALUE", 0), 2000.0: ("HIGH_VALUE", 1)}


def test_reviews_filter_and_sentiment(spark):
    vals = [None, "0", "1", "2", "3", "4", "5", "6"]
    df = spark.createDataFrame([(f"r{i}", "1", "2", "3", "2020-01-01", v, "t", TS.isoformat())
                                for i, v in enumerate(vals)],
                               "review_id string, order_id string, product_id string, customer_id string,"
                               " review_date string, rating string, review_title string, event_timestamp string")
    out = dict(_rows(S.silver_reviews(df), "rating", "review_sentiment"))
    assert out == {1: "NEGATIVE", 2: "NEGATIVE", 3: "NEUTRAL", 4: "POSITIVE", 5: "POSITIVE"}


def test_shipments_ladder_null_is_delayed(spark):
    days = [-1, 0, 2, 3, 5, 6, None]
    rows = []
    for i, d in enumerate(days):
        ship = dt.date(2020, 1, 10)
        deliv = None if d is None else ship + dt.timedelta(days=d)
        rows.append((i, ship, deliv, 1.0, TS))
    df = spark.createDataFrame(rows, "order_id bigint, ship_date date, delivery_date date,"
                                     " shipping_fee double, event_timestamp timestamp")
    out = dict(_rows(S.silver_shipments(df), "order_id", "shipping_status"))
    assert [out[i] for i in range(7)] == ["FAST", "FAST", "FAST", "NORMAL", "NORMAL", "DELAYED", "DELAYED"]


def test_inventory_ladder(spark):
    stock = [None, -1, 0, 1, 20, 21, 499, 500]
    df = spark.createDataFrame([(dt.date(2020, 1, 1), i, s, 1, 1, TS) for i, s in enumerate(stock)],
                               "snapshot_date date, product_id bigint, stock_on_hand int,"
                               " units_received int, units_sold int, event_timestamp timestamp")
    out = dict(_rows(S.silver_inventory(df), "product_id", "inventory_status"))
    assert [out[i] for i in range(8)] == ["NORMAL", "STOCKOUT", "STOCKOUT", "LOW_STOCK", "LOW_STOCK",
                                          "NORMAL", "NORMAL", "OVERSTOCK"]


def test_traffic_zero_sessions_and_quality(spark):
    rows = [(dt.date(2020, 1, 1), s, 1, pv, src, TS)
            for s, pv, src in [(None, 5, "a"), (0, 5, "b"), (999, 2345, "c"), (1000, None, "d"),
                               (200, 469, "e")]]
    df = spark.createDataFrame(rows, "date date, sessions int, unique_visitors int, page_views int,"
                                     " traffic_source string, event_timestamp timestamp")
    out = {r.traffic_source: (r.pages_per_session, r.traffic_quality) for r in S.silver_traffic(df).collect()}
    assert out["a"] == (None, "NORMAL") and out["b"] == (None, "NORMAL")
    assert out["c"] == (2.35, "NORMAL") and out["d"] == (None, "HIGH")
    assert out["e"][0] == 2.35  # 469/200 = 2.345 rounds half-up on the exact value


def test_order_items_nulls_and_duplicates(spark):
    rows = [("1", "10", "5", "2.5", "1.0"), ("1", "10", "5", "2.5", "1.0"), (None, "10", "5", "1", "1"),
            ("2", None, "5", "1", "1"), ("3", "11", "5", None, "1"), ("12.0", "13", "5", "1", "1")]
    df = spark.createDataFrame([r + (TS.isoformat(),) for r in rows],
                               "order_id string, product_id string, seller_id string, price string,"
                               " freight_value string, event_timestamp string")
    out = _rows(S.silver_order_items(df), "order_id", "product_id", "item_total")
    assert out == [(1, 10, 3.5), (3, 11, None), (12, 13, 2.0)]


def test_missing_fields_become_typed_nulls(spark):
    df = spark.createDataFrame([("5", "2020-01-02")], "order_id string, order_date string")
    out = S.silver_orders(df)
    types = dict(out.dtypes)
    assert types["customer_id"] == "bigint" and types["zip"] == "int" and types["order_status"] == "string"
    r = out.first()
    assert r["order_id"] == 5 and r["customer_id"] is None and r["event_date"] == dt.date(2020, 1, 2)
    only_id = spark.createDataFrame([("7",)], "order_id string")
    assert S.silver_orders(only_id).first()["event_timestamp"] is None
