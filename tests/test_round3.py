"""Turns of several files, narrow survivors, small distinct sketches, training on all rows."""

import os
import random
import sys
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from bazaar.operators import bronze as B
from bazaar.operators import dedup as D
from bazaar.operators import gold as G
from bazaar.operators import journey as J
from bazaar.operators.dating import date_by_order
from bazaar.operators.gold import GOLD
from bazaar.plans import bronze_jobs, stream_runs
from bazaar.plans import medallion as M
from bazaar.plans import recommend as RC
from bazaar.session import scratch_path
from bazaar.streaming import jobs
from bazaar.streaming.manifest import Files
from bazaar.streaming.sources import layer_stream

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def parquet(spark, path):
    return sorted(n for n in Files(spark, path).names(path) if n.endswith(".parquet"))


def test_turns_of_several_files_arrive_turn_by_turn(spark):
    rows = spark.range(0, 1000, 1, 8).withColumn("t", F.when(F.col("id") < 990, F.col("id") % 2).otherwise(F.lit(2)))
    rows = stream_runs.stored(rows, "turn-rows")
    path = stream_runs.publish_in_turn(rows, F.col("t"), 4, "turns", files=3)
    assert len(parquet(spark, path)) == 4 * 3  # thin and empty turns are made up
    seen = []

    def note(batch, batch_id):
        seen.append(sorted({r.t for r in batch.select("t").distinct().collect()}))

    q = (layer_stream(spark, path, rows.schema, max_files_per_trigger=3).writeStream.foreachBatch(note)
         .option("checkpointLocation", scratch_path(spark, "turns-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert seen == [[0], [1], [2], []]
    assert spark.read.parquet(path).count() == 1000


def test_large_turns_are_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(stream_runs, "ROWS_PER_FILE", 10)
    rows = stream_runs.stored(spark.range(0, 400, 1, 8), "large-turns")
    assert stream_runs.turn_files(rows, 2) == 20
    assert stream_runs.turn_files(rows.limit(3), 2) == 1


def tiny_tables(spark):
    """lineitem and orders of a few rows, the order of item 1 missing its line twice."""
    path = scratch_path(spark, "tiny")
    day = datetime(1995, 1, 1)
    items = [(k, k % 5, k % 3, n, float(k), 10.0 * k, "A", "O", day + timedelta(days=k)) for k in range(1, 60) for n in (1, 2)]
    spark.createDataFrame(items + items[:3], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
                          ).write.parquet(f"{path}/lineitem.parquet")
    orders = [(k, k % 7, "O", 100.0 * k, "1-URGENT", day + timedelta(days=k)) for k in range(1, 60)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string, "
                          "o_orderdate timestamp_ntz").write.parquet(f"{path}/orders.parquet")
    return path


def test_undated_items_are_parsed_once_and_compared_without_their_text(spark):
    path = tiny_tables(spark)
    out = bronze_jobs.dated_silver(spark, path, "order_items")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    survivors = plan[plan.index("_survivor"):].split("\n")[0]
    assert "raw_json" not in survivors
    assert plan.count("lineitem.parquet") <= 1 and plan.count("Join LeftOuter") == 1
    rows = out.collect()
    assert len(rows) == 59 and {r.order_id for r in rows if r.event_timestamp is None} == {50}


def test_rows_that_are_not_looked_up_are_spread_and_kept(spark):
    day = datetime(2020, 1, 1)
    rows = spark.createDataFrame([(str(k) if k % 2 else None, day if k % 3 else None, None, 0, k) for k in range(300)],
                                 "order_id string, event_timestamp timestamp, event_date date, partition int, offset long")
    orders = spark.createDataFrame([(str(k), datetime(2021, 1, 1)) for k in range(0, 300, 3)], "order_id string, event_timestamp timestamp")
    got = {r.offset: r for r in date_by_order(rows, orders).collect()}
    assert len(got) == 300
    for k, r in got.items():
        want = day if k % 3 else datetime(2021, 1, 1) if k % 2 else None
        assert r.event_timestamp == want and (r.event_date is None) == (want is None)


def test_dated_stream_does_not_hold_the_text(spark):
    for name in ("order_items", "orders"):
        os.makedirs(scratch_path(spark, f"none-{name}"))
    at = [scratch_path(spark, "b") for _ in range(2)]
    for p, e in zip(at, ("order_items", "orders"), strict=True):
        spark.createDataFrame([], jobs.bronze_schema(spark, e)).write.parquet(p)
    df = jobs.dated_stream(spark, "order_items", *at, without=bronze_jobs.UNPLACED)
    assert not set(df.columns) & set(bronze_jobs.UNPLACED)
    assert {"partition", "offset", "order_id", "event_timestamp"} <= set(df.columns)


def test_small_groups_have_small_sketches(spark):
    rows = spark.range(0, 30000).select(
        F.when(F.col("id") < 28000, F.lit(0)).otherwise(F.col("id")).alias("seller_id"), F.lit("2020-01-01").cast("date").alias("event_date"),
        F.col("id").alias("order_id"), F.lit(1.0).alias("item_total"))
    df = G.seller_performance(rows, distinct="approx")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "approx_count_distinct" not in plan
    got = {r.seller_id: r.total_orders for r in df.collect()}
    assert abs(got.pop(0) - 28000) < 0.1 * 28000 and set(got.values()) == {1}
    held = rows.groupBy("seller_id").agg(F.length(F.hll_sketch_agg("order_id", 12)).alias("n")).where("seller_id > 0")
    assert held.agg(F.max("n")).first()[0] < 100
    nulls = spark.range(3).select(F.lit(1).alias("seller_id"), F.lit(None).cast("date").alias("event_date"),
                                  F.lit(None).cast("long").alias("order_id"), F.lit(1.0).alias("item_total"))
    assert G.seller_performance(nulls, distinct="approx").first().total_orders == 0


def test_pii_learns_from_every_document(spark, monkeypatch):
    from bazaar.llm import pii

    monkeypatch.setattr(pii, "ROUNDS", 4)
    assert not hasattr(pii, "TRAIN_DOCS")
    long = " ".join(f"10.0.{j}.{k}" for j in range(3) for k in range(50))
    assert len(pii.examples(long, None)) > 2 * pii.TRAIN_CANDIDATES
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    texts = [f"{word()}{k} {word()}@{word()}.com call 555-123-{1000 + k} {word()}" for k in range(5000)]
    every = [v for t in texts for v in pii.examples(t, None)]
    seen = []
    real = pii._boost
    monkeypatch.setattr(pii, "_start", lambda n, good: seen.append((n, good)) or 0.0)
    monkeypatch.setattr(pii, "_boost", lambda edges, start, sums: real(edges, start, lambda *a: seen.append(sums(*a)) or seen[-1]))
    trees = pii.train(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    import zlib
    learn = [v for t in texts if zlib.crc32(t.encode()) % 4 for v in pii.examples(t, None)]
    assert len(learn) < len(every) and seen[0] == (len(learn), sum(v[-1] for v in learn))
    x = np.array(learn, float)
    sums = seen[1].reshape(x.shape[1] - 1, pii.BINS + 1, 2)  # of the first node
    want = (0.5 - x[:, -1]).sum()
    assert np.allclose(sums[:, :, 0].sum(axis=1) / pii.UNIT, want)
    assert np.allclose(sums[:, :, 1].sum(axis=1) / pii.UNIT, len(learn) / 4)
    assert len(trees.splits) == 4
    _, added = pii.find(f"{word()} {word()} [at] {word()} [dot] com", trees)
    assert len(added) <= 1


def test_pii_trees_split_as_brute_force(spark):
    """A tree's first cut has the largest gain over all features and values."""
    from bazaar.llm import pii

    r = np.random.default_rng(3)
    x = r.integers(0, 6, (400, 5)).astype(float)
    y = (x[:, 3] > 2).astype(float)
    trees = pii.fit(np.column_stack([x, y]))
    assert trees.splits[0][0][0] == 3 and 2 <= trees.splits[0][1][0] < 3
    p = trees.probability(x)
    assert ((p > 0.5) == (y > 0.5)).all()


def test_survivors_are_compared_up_to_the_columns_that_are_used(spark):
    rows = spark.createDataFrame(
        [(1, None, 5, "b"), (1, 2, 4, "a"), (1, None, 3, "c"), (2, 7, None, "a"), (2, 7, 1, "b"), (None, 1, 1, "a")],
        "k int, a int, b int, c string")
    whole = D.dedup_batch(rows, ["k"])
    for keep in ((), ("a",), ("b",), ("a", "b"), ("c",)):
        part = D.dedup_batch(rows, ["k"], keep)
        assert set(keep) <= set(part.columns)
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.select(*part.columns).collect())), keep
    assert "c" not in D.dedup_batch(rows, ["k"], ("b",)).columns
    plan = D.dedup_batch(rows, ["k"], ("a",))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_readers_of_silver_get_the_same_columns_without_the_rest(spark):
    path = tiny_tables(spark)
    for name, keep in (*((GOLD[t][0], uses) for t, uses in G.USES.items() if t != "traffic_kpi" and t != "inventory_kpi"),
                       *((n, uses) for n, uses in J.USES.items() if n not in ("traffic", "inventory"))):
        part = M.silver_table(spark, path, name, keep=keep)
        assert {*keep, "event_date", "event_timestamp"} <= set(part.columns)
        assert sorted(map(str, part.collect())) == sorted(map(str, M.silver_table(spark, path, name).select(*part.columns).collect()))
    ratings = RC.explicit_ratings(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert "review_title" not in ratings and "to_date" not in ratings
    buyers = RC.implicit_purchases(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert "payment_method" not in buyers


def test_replay_key_is_made_after_the_sort(spark):
    path = tiny_tables(spark)
    journey = J.order_journey(M.all_silver(spark, path, [s[0] for s in J.STEPS], keep=J.USES))
    log = J.replay_log(journey, seed=42)
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert "replay_key" not in plan[plan.index("Sort ["):].split("\n", 1)[1]
    rows = log.collect()
    assert [(r.replay_day, r.replay_key) for r in rows] == sorted((r.replay_day, r.replay_key) for r in rows)


def test_backfill_reads_silver_without_text_and_sizes_its_files(spark, monkeypatch):
    path = tiny_tables(spark)
    silver = spark.read.parquet(stream_runs.bronze_silver(spark, path, "order_items"))
    assert "raw_json" not in silver.columns and "offset" in silver.columns
    assert silver.count() == M.silver_table(spark, path, "order_items").count()
    env = spark.read.parquet(stream_runs.publish_files(spark, path, "order_items"))
    assert stream_runs.files_per_day(env) == 1 and stream_runs.files_per_day(env.limit(0)) == 1
    monkeypatch.setattr(stream_runs, "ROWS_PER_FILE", 2)
    assert stream_runs.files_per_day(env) == 2
    monkeypatch.setattr(stream_runs, "ROWS_PER_FILE", 0.1)
    assert stream_runs.files_per_day(env) == stream_runs.sinks.FILES_PER_DATE
