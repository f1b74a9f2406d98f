"""Findings of round 4: disk and memory of the stream runs, the replay log and ALS."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bazaar.plans import medallion as M
from bazaar.plans import stream_runs
from bazaar.session import BIG_STATE, CLEAN, preset, scratch_path
from bazaar.streaming import jobs
from bazaar.streaming.manifest import Files

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CLEANUP = next(iter(CLEAN))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Sixty orders of three lines, a line of every tenth order twice."""
    path = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(2001, 1, 1)
    orders = [(k, k % 7, "O", 100.0 + k, day + dt.timedelta(days=k % 9), "1-URGENT") for k in range(60)]
    lines = [(k, 3 * k + n, k % 5, n, 2.0 + n, 10.0 * k + n, 0.0, 0.0, "RAN"[n % 3], "F", day + dt.timedelta(days=k % 9 + n))
             for k in range(60) for n in range(1, 4)]
    lines += [x for x in lines if x[0] % 10 == 0 and x[3] == 1]
    (spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                   "o_orderdate timestamp, o_orderpriority string").coalesce(1).write.parquet(f"{path}/orders.parquet"))
    (spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                  "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                  "l_linestatus string, l_shipdate timestamp").coalesce(1).write.parquet(f"{path}/lineitem.parquet"))
    return path


@pytest.fixture
def unset(spark):
    """The session without the library's state store, as a caller may have it."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.unset(PROVIDER)
    yield
    if before is not None:
        spark.conf.set(PROVIDER, before)


def test_preset_ends_with_its_block_and_leaves_the_callers_values(spark, unset):
    with pytest.raises(KeyError), preset(spark, CLEAN, BIG_STATE):
        assert spark.conf.get(CLEANUP) == "true" and "RocksDB" in spark.conf.get(PROVIDER)
        raise KeyError
    assert spark.conf.get(CLEANUP, None) is None and spark.conf.get(PROVIDER, None) is None
    spark.conf.set(CLEANUP, "false")
    try:
        with preset(spark, CLEAN):
            assert spark.conf.get(CLEANUP) == "false"
        assert spark.conf.get(CLEANUP) == "false"
    finally:
        spark.conf.unset(CLEANUP)


def test_backfill_reads_a_part_at_a_time_and_drops_its_input(spark, tables, monkeypatch):
    kept, ran = [], []
    publish, run = stream_runs.publish_files, stream_runs._run

    def published(session, *a):
        path = publish(session, *a)
        spark.read.parquet(path).repartition(3).write.mode("append").parquet(path)  # everything again, in other files
        kept.append(path)
        return path

    def noted(q):
        run(q)
        ran.append((q.name, len([p for p in q.recentProgress if p["numInputRows"]]), spark.conf.get(CLEANUP)))

    monkeypatch.setattr(stream_runs, "publish_files", published)
    monkeypatch.setattr(stream_runs, "_run", noted)
    monkeypatch.setattr(stream_runs, "BATCH_BYTES", 1)
    silver = spark.read.parquet(stream_runs.bronze_silver(spark, tables, "order_items"))
    want = M.silver_table(spark, tables, "order_items")
    cols = ["order_id", "product_id", "seller_id", "price", "freight_value", "item_total", "event_timestamp"]
    assert sorted(silver.select(*cols).collect()) == sorted(want.select(*cols).collect())
    assert [n for n, _, _ in ran] == ["bronze_order_items", "silver_order_items"]
    assert all(batches > 1 and clean == "true" for _, batches, clean in ran)
    assert Files(spark, kept[0]).names(kept[0]) == [] and spark.conf.get(CLEANUP, None) is None


def test_backfill_with_a_watermark_is_one_batch(spark, tables, monkeypatch):
    monkeypatch.setattr(stream_runs, "BATCH_BYTES", 1)
    got = stream_runs.stream_silver(spark, tables, "order_items", duplicate_every=10, watermark="1 day")
    assert got.count() == M.silver_table(spark, tables, "order_items").count()
    path = scratch_path(spark, "none")
    with pytest.raises(ValueError, match="one micro-batch"):
        jobs.silver_job(spark, "order_items", path, path + "-out", path + "-ckpt", watermark="1 day", batch_bytes=1)


def test_undated_records_are_joined_with_state_on_disk(spark, tables, unset, monkeypatch):
    seen = []
    run = stream_runs._run

    def noted(q):
        run(q)
        state = [s for p in q.recentProgress for s in p["stateOperators"]]
        seen.append((q.name, any("rocksdb" in k for s in state for k in s["customMetrics"])))

    monkeypatch.setattr(stream_runs, "_run", noted)
    got = stream_runs.stream_reference(spark, tables, "order_items")
    assert ("survivors_order_items", True) in seen and spark.conf.get(PROVIDER, None) is None
    undated = got.where(F.col("event_timestamp").isNull()).select("order_id").distinct().collect()
    assert sorted(r[0] for r in undated) == [0, 50]
    assert got.select("order_id").distinct().count() == 60


def test_replay_log_sorts_steps_that_are_written_one_by_one(spark, tables):
    from bazaar.operators import journey as J
    from bazaar.registry import QUERIES

    got = QUERIES["replay_log"](spark, tables)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan  # done, and its shuffle files gone, before the sort
    whole = J.replay_log(J.order_journey(M.all_silver(spark, tables, [n for n, _, _ in J.STEPS], keep=J.USES)), seed=42)
    rows = got.collect()
    assert got.columns == whole.columns and len(rows) > 300
    assert rows == whole.collect()


def test_factor_blocks_grow_in_number_with_the_ratings(spark, tables, monkeypatch):
    from bazaar.plans import recommend as RC

    pairs = RC.implicit_purchases(spark, tables)
    n = pairs.count()
    assert RC.blocks_of(pairs) == RC.LEAST_BLOCKS == RC.blocks_of(pairs.limit(0))
    monkeypatch.setattr(RC, "RATINGS_PER_BLOCK", 9)
    assert RC.blocks_of(pairs) == -(-n // 9) > RC.LEAST_BLOCKS
    used = []
    als = RC._als
    monkeypatch.setattr(RC, "_als", lambda *a, **kw: used.append(als(*a, **kw)) or used[-1])
    scored = RC.score(RC.train(pairs, "purchases", True), pairs)
    assert scored.count() == n and scored.where("prediction IS NULL OR isnan(prediction)").isEmpty()
    assert used[0].getNumUserBlocks() == used[0].getNumItemBlocks() == -(-n // 9)
    assert used[0].getCheckpointInterval() == RC.CHECKPOINT_EVERY
