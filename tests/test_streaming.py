"""Batch == stream, restart from checkpoint, complete-mode publish."""

from pyspark.sql import functions as F

from bazaar.operators import bronze as B
from bazaar.plans import medallion as M
from bazaar.plans import stream_runs as SR
from bazaar.session import scratch_path
from bazaar.streaming import jobs, sinks
from bazaar.streaming.sources import envelope_stream

from conftest import SF001


def _same(a, b):
    cols = sorted(c for c in a.columns if c not in ("processing_time", "silver_layer"))
    return sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_stream_silver_equals_batch(spark):
    got = SR.stream_silver(spark, SF001, "order_items")
    assert _same(got, M.silver_table(spark, SF001, "order_items"))


def test_stream_dedup_with_watermark_drops_resent_copies(spark):
    got = SR.stream_silver(spark, SF001, "order_items", duplicate_every=10, watermark="30 days")
    assert _same(got, M.silver_table(spark, SF001, "order_items"))


def test_restart_from_checkpoint(spark):
    """Run, add new files, restart on the same checkpoint: only the new files
    are read and the table equals one run over everything (exactly-once via
    the source and sink logs)."""
    from bazaar.sources import testdata
    pay = testdata.entity(spark, SF001, "payments")
    src = scratch_path(spark, "restart-in")
    out = scratch_path(spark, "restart")
    ck = out + "-ckpt"

    def run():
        df = B.parse_envelope(envelope_stream(spark, src), "payments")
        q = sinks.start_append(df, out, ck)
        q.awaitTermination()

    B.to_wire(pay.where(F.col("order_id") % 2 == 0), "payments").write.parquet(src)
    run()
    first = spark.read.parquet(out).count()
    run()  # nothing new: no change
    assert spark.read.parquet(out).count() == first
    B.to_wire(pay.where(F.col("order_id") % 2 == 1), "payments").write.mode("append").parquet(src)
    run()
    full = spark.read.parquet(out)
    assert 0 < first < pay.count()
    assert full.count() == pay.count()
    assert full.select("order_id").distinct().count() == pay.select("order_id").distinct().count()


def test_incremental_gold_is_exact_and_idempotent(spark):
    silver = SR.bronze_silver(spark, SF001, "order_items")
    out = scratch_path(spark, "gold")
    q = jobs.gold_incremental(spark, "daily_sales", silver, out, out + "-ckpt")
    q.awaitTermination()
    got = spark.read.parquet(out)
    exp = M.gold_table(spark, SF001, "daily_sales")
    assert sorted(got.select(*exp.columns).collect()) == sorted(exp.collect())
    # shared scan: the three order-item tables from one read of the touched days
    out2 = scratch_path(spark, "gold-shared")
    tables = ["daily_sales", "top_products", "seller_performance"]
    q = jobs.gold_incremental(spark, tables, silver, out2, out2 + "-ckpt")
    q.awaitTermination()
    for t in tables:
        exp = M.gold_table(spark, SF001, t)
        got = spark.read.parquet(f"{out2}/{t}").select(*exp.columns)
        assert sorted(got.collect()) == sorted(exp.collect()), t


def test_complete_mode_versions(spark):
    silver = SR.bronze_silver(spark, SF001, "returns")
    out = scratch_path(spark, "goldc")
    q = jobs.gold_complete_job(spark, "returns_kpi", silver, out, out + "-ckpt")
    q.awaitTermination()
    got = sinks.read_complete(spark, out)
    exp = M.gold_table(spark, SF001, "returns_kpi")
    assert got.count() == exp.count()
    assert got.agg(F.sum("total_returns")).first()[0] == exp.agg(F.sum("total_returns")).first()[0]


def test_incremental_gold_keeps_null_date_group(spark):
    import datetime as dt

    from bazaar.operators import gold as G
    from bazaar.operators.silver import silver_returns
    rows = [("r1", 1, 10, "x", dt.date(2020, 1, 3), dt.datetime(2020, 1, 2)),
            ("r2", 2, 11, "y", None, None),
            ("r3", 2, 12, "y", None, None)]
    typed = spark.createDataFrame(rows, "return_id string, order_id bigint, product_id bigint,"
                                        " return_reason string, return_date date, event_timestamp timestamp")
    sil = silver_returns(typed, clock=True)
    path = scratch_path(spark, "silver-null")
    sil.write.partitionBy("event_date").parquet(path)
    out = scratch_path(spark, "gold-null")
    q = jobs.gold_incremental(spark, "returns_kpi", path, out, out + "-ckpt", schema=sil.schema)
    q.awaitTermination()
    def key(t):
        return (t[0] is None, t[0] or dt.date.min, t[1])
    got = sorted(((r["event_date"], r["total_returns"]) for r in spark.read.parquet(out).collect()), key=key)
    exp = sorted(((r["event_date"], r["total_returns"]) for r in G.returns_kpi(sil).collect()), key=key)
    assert got == exp and (None, 2) in got


def test_reader_never_sees_a_version_in_the_making(spark):
    from bazaar.streaming.manifest import Versions
    out = scratch_path(spark, "complete")
    v = Versions(spark, out)
    one, two = (spark.createDataFrame([(x,)], "x int") for x in (1, 2))
    assert v.publish(0, lambda folder: one.write.parquet(folder))
    two.write.parquet(f"{out}/data/1-unfinished")  # not published
    assert [r["x"] for r in sinks.read_complete(spark, out).collect()] == [1]
    assert v.publish(1, lambda folder: two.write.parquet(folder))
    assert [r["x"] for r in sinks.read_complete(spark, out).collect()] == [2]
    # a replay of a published batch writes nothing
    assert not v.publish(1, lambda folder: one.write.parquet(folder))
    assert [r["x"] for r in sinks.read_complete(spark, out).collect()] == [2]


def test_touched_days_bound_the_scan(spark):
    import datetime as dt
    path = scratch_path(spark, "days")
    rows = [(i, dt.date(2020, 1, 1 + i % 20)) for i in range(200)] + [(500, None)]
    spark.createDataFrame(rows, "v int, event_date date").write.partitionBy("event_date").parquet(path)
    silver = spark.read.parquet(path)
    day = spark.createDataFrame([(dt.date(2020, 1, 7),)], "event_date date")
    got = jobs.touched_days(silver, day)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "2020-01-07" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert got.count() == 10
    two = spark.createDataFrame([(dt.date(2020, 1, 3),), (dt.date(2020, 1, 9),), (None,)], "event_date date")
    assert jobs.touched_days(silver, two).count() == 21
    assert jobs.touched_days(silver, day.limit(0)) is None


def test_hot_date_is_written_by_several_tasks(spark):
    from bazaar.session import spread_by_date
    df = spark.range(200_000).selectExpr(
        "id", "sha2(string(id), 256) AS body", "if(id % 10 = 0, date'2020-01-01' + int(id % 7), date'2021-06-01') AS event_date")
    out = scratch_path(spark, "hot")
    spread_by_date(df).write.partitionBy("event_date").parquet(out)
    back = spark.read.parquet(out)
    assert back.count() == 200_000
    hot = back.where("event_date = date'2021-06-01'").select(F.input_file_name().alias("f"))
    assert hot.distinct().count() > 3


def test_live_append_leaves_rows_where_they_are(spark):
    """A processing-time stream writes a hot date from all of its tasks."""
    src, out = scratch_path(spark, "hot-in"), scratch_path(spark, "hot-out")
    day = spark.range(400).selectExpr("cast(null as binary) AS value", "'t' AS topic", "0 AS partition", "id AS offset",
                                      "timestamp'2021-06-01' AS timestamp")
    day.repartition(4).write.parquet(src)
    df = envelope_stream(spark, src).withColumn("event_date", F.to_date("timestamp"))
    q = sinks.start_append(df, out, out + "-ckpt", trigger="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == 400
    files = spark.read.parquet(out).select(F.input_file_name()).distinct().count()
    assert files == 4


def test_kafka_plan_needs_no_fallback(spark):
    """With servers the Kafka source is used or its error is raised; files are
    never read instead."""
    import pytest

    from bazaar.streaming import sources
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.source(spark, "orders_topic", servers="127.0.0.1:9", path="/nowhere")
    with pytest.raises(ValueError):
        sources.source(spark, "orders_topic")


def test_processing_time_trigger_runs_until_stopped(spark):
    """The long-running form: a processing-time trigger, drained and stopped."""
    src = SR.publish_files(spark, SF001, "inventory")
    out = scratch_path(spark, "pt")
    q = jobs.bronze_job(spark, "inventory", src, out, out + "-ckpt", trigger="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == spark.read.parquet(src).count()
