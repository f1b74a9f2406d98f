import datetime as dt

from pyspark.sql import functions as F

from bazaar.operators import bronze as B
from bazaar.specs import ENVELOPE_SCHEMA


def _env(spark, texts):
    rows = [(None if t is None else bytearray(t.encode()), "orders_topic", 0, i, dt.datetime(2020, 1, 1))
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def test_parse_rules(spark):
    texts = ['{"order_id": 12.0, "order_date": "2012-07-04", "extra": 1}',  # number for string, extra key
             '{"order_id": "5"}',                                          # missing keys
             '{"order_id": 1, broken',                                     # truncated
             '{"order_id": null}',
             None]
    b = B.parse_envelope(_env(spark, texts), "orders", event_time="literal")
    rows = b.orderBy("offset").collect()
    assert rows[0]["order_id"] == "12.0" and rows[0]["order_date"] == "2012-07-04"
    assert rows[0]["event_timestamp"] == dt.datetime(2012, 7, 4)
    assert rows[1]["order_id"] == "5" and rows[1]["order_date"] is None
    assert rows[2]["order_id"] is None and rows[2]["raw_json"].startswith('{"order_id": 1')
    assert {"bronze_layer", "data_source", "kafka_timestamp"} <= set(b.columns)
    rej = sorted(r["offset"] for r in B.rejects(b, "orders").collect())
    assert rej == [2, 3]


def test_wire_roundtrip_keeps_values(spark):
    from bazaar.operators.silver import silver_order_items
    df = spark.createDataFrame([(1, 2, 3, 1234567.25, 1e7, dt.datetime(2001, 3, 4)),
                                (4, 5, None, None, 0.1, dt.datetime(2001, 3, 5))],
                               "order_id bigint, product_id bigint, seller_id bigint, price double,"
                               " freight_value double, event_timestamp timestamp")
    direct = silver_order_items(df).drop("silver_layer")
    via = silver_order_items(B.parse_envelope(B.to_wire(df, "order_items"), "order_items")).drop("silver_layer")
    assert sorted(direct.collect()) == sorted(via.select(*direct.columns).collect())


def test_literal_event_column_year_from_order_id(spark):
    # taking order_id as event time turns 4-6 digit ids into years;
    # reproducible with event_time="literal"
    env = _env(spark, ['{"order_id": "12345", "product_id": "1"}'])
    b = B.parse_envelope(env, "order_items", event_time="literal")
    ts = b.select(F.year("event_timestamp")).first()[0]
    assert ts == 12345


def test_own_date_decides_and_ids_are_no_times(spark):
    env = _env(spark, ['{"order_id": "5", "order_date": "2012-07-04"}'])
    assert B.parse_envelope(env, "orders").first()["event_timestamp"] == dt.datetime(2012, 7, 4)
    env = _env(spark, ['{"order_id": "12345", "product_id": "1"}'])
    assert B.parse_envelope(env, "order_items").first()["event_timestamp"] is None
    # the sender's clock is never the event time
    env = _env(spark, ['{"order_id": "5", "order_date": "2012-07-04", "event_time": "2026-01-01T00:00:00"}'])
    assert B.parse_envelope(env, "orders").first()["event_date"] == dt.date(2012, 7, 4)
    env = _env(spark, ['{"order_id": "5", "product_id": "1", "event_time": "2026-01-01T00:00:00"}'])
    assert B.parse_envelope(env, "order_items").first()["event_timestamp"] is None


def test_wire_keeps_microseconds_and_lineage(spark):
    from bazaar.operators.silver import LINEAGE, silver_payments
    stamps = [dt.datetime(2020, 1, 1, 12, 0, 0, us) for us in (100000, 900000, 900001)]
    df = spark.createDataFrame([(1, "card", 5.0, 1, t) for t in stamps],
                               "order_id bigint, payment_method string, payment_value double, installments int,"
                               " event_timestamp timestamp")
    out = silver_payments(B.parse_envelope(B.to_wire(df, "payments"), "payments", clock=True), clock=True)
    assert sorted(r["event_timestamp"] for r in out.collect()) == stamps
    assert set(LINEAGE) <= set(out.columns)


def test_publish_partitioned_by_topic(spark):
    from bazaar.operators.silver import silver
    from bazaar.plans.medallion import silver_table
    from bazaar.session import scratch_path
    from bazaar.sources import testdata
    from bazaar.streaming.sinks import publish_envelopes

    sf = "/root/testdata/sf0.001"
    frames = {n: testdata.entity(spark, sf, n) for n in ("inventory", "returns")}
    path = scratch_path(spark, "topics")
    publish_envelopes(frames, path)
    for n in frames:
        topic = f"{n}_topic"
        # reading one topic folder: the partition value is restored as a column
        env = spark.read.parquet(f"{path}/topic={topic}").withColumn("topic", F.lit(topic))
        got = silver(n, B.parse_envelope(env, n)).drop("silver_layer")
        exp = silver_table(spark, sf, n).drop("silver_layer")
        assert sorted(got.select(*exp.columns).collect()) == sorted(exp.collect())
