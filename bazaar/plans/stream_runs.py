"""End-to-end stream runs over the driver tables (availableNow triggers).

The publish step writes the entity as Kafka-shaped envelope files into a
fresh folder under the shared checkpoint folder; bronze, silver and gold then
run as three streaming queries, each with its own checkpoint, exactly as the
long-running jobs would, but ending when the input is consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.operators import bronze as B
from bazaar.operators.gold import GOLD
from bazaar.operators.silver import LINEAGE
from bazaar.plans import bronze_jobs, medallion
from bazaar.session import BIG_STATE, CLEAN, preset, scratch_path, tune_local
from bazaar.sources import testdata
from bazaar.streaming import jobs, merge, routing, sinks
from bazaar.streaming.manifest import Files
from bazaar.streaming.sources import envelope_stream, layer_stream


def publish_files(spark: SparkSession, sf_dir: str, entity: str, duplicate_every: int = 0) -> str:
    """Typed entity -> envelope parquet files (optionally with exact copies of
    every ``duplicate_every``-th order re-sent)."""
    df = testdata.entity(spark, sf_dir, entity)
    env = B.to_wire(df, entity)
    if duplicate_every:
        again = B.to_wire(df.where(F.col("order_id") % duplicate_every == 0), entity)
        env = env.unionByName(again)
    path = scratch_path(spark, f"in-{entity}")
    env.write.option("compression", "zstd").parquet(path)
    return path


#: Bytes of files that a micro-batch of a backfill reads: its shuffle files go with it, so they don't grow with the input.
BATCH_BYTES = 2 << 30


def _run(q) -> None:
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


def bronze_silver(spark: SparkSession, sf_dir: str, entity: str, duplicate_every: int = 0,
                  watermark: str | None = None) -> str:
    tune_local(spark)
    bronze = scratch_path(spark, f"bronze-{entity}")
    silver = scratch_path(spark, f"silver-{entity}")
    with preset(spark, CLEAN, BIG_STATE):
        src = publish_files(spark, sf_dir, entity, duplicate_every)
        files = files_per_day(spark.read.parquet(src))
        _run(jobs.bronze_job(spark, entity, src, bronze, bronze + "-ckpt", files_per_date=files, batch_bytes=BATCH_BYTES))
        Files(spark, src).remove(src)  # the stand-in of a topic, whose records bronze has now
        # the log's text stays in bronze: the results of these runs are without it
        _run(jobs.silver_job(spark, entity, bronze, silver, silver + "-ckpt", watermark=watermark,
                             unbounded=watermark is None, files_per_date=files, without=bronze_jobs.UNPLACED,
                             batch_bytes=None if watermark else BATCH_BYTES))
    return silver


def stream_silver(spark: SparkSession, sf_dir: str, entity: str = "order_items",
                  **kw) -> DataFrame:
    path = bronze_silver(spark, sf_dir, entity, **kw)
    return spark.read.parquet(path).drop("processing_time", *LINEAGE)


def stream_gold_exact(spark: SparkSession, sf_dir: str, table: str = "daily_sales") -> DataFrame:
    from bazaar.operators.gold import GOLD
    silver = bronze_silver(spark, sf_dir, GOLD[table][0])
    out = scratch_path(spark, f"gold-{table}")
    with preset(spark, CLEAN):
        _run(jobs.gold_incremental(spark, table, silver, out, out + "-ckpt"))
    return spark.read.parquet(out)


def stream_gold_complete(spark: SparkSession, sf_dir: str, table: str = "daily_sales") -> DataFrame:
    from bazaar.operators.gold import GOLD
    silver = bronze_silver(spark, sf_dir, GOLD[table][0])
    out = scratch_path(spark, f"goldc-{table}")
    with preset(spark, CLEAN):
        _run(jobs.gold_complete_job(spark, table, silver, out, out + "-ckpt"))
    return sinks.read_complete(spark, out)


# ------------------------------------------------- runs of several micro-batches

#: Rows of a turn's file, about.
ROWS_PER_FILE = 100_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once: turns are cut from the files, not from its plan."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def files_per_day(env: DataFrame) -> int:
    """Files of a day in a backfill's tables: one, unless the largest day needs more."""
    days = env.groupBy(F.to_date("timestamp")).agg(F.count(F.lit(1)).alias("n"))
    most = days.agg(F.max("n")).first()[0] or 0
    return min(sinks.FILES_PER_DATE, max(1, -(-most // ROWS_PER_FILE)))


def turn_files(rows: DataFrame, turns: int) -> int:
    """Files of a turn, for turns of about equal size."""
    return max(1, rows.count() // (turns * ROWS_PER_FILE))


def publish_in_turn(df: DataFrame, turn, turns: int, name: str, files: int = 1) -> str:
    """Write the rows of turn 0, 1, ... one after the other, ``files`` files for each.

    A stream over the folder with ``files`` files a trigger meets them in that
    order.  A turn that fills fewer files is made up with empty ones.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    numbered, disk = df.withColumn("_turn", turn), Files(spark, path)
    empty = None
    for k in range(turns):
        numbered.where(F.col("_turn") == k).drop("_turn").coalesce(files).write.mode("append").parquet(path)
        written = sum(n.endswith(".parquet") for n in disk.names(path))
        for j in range(written, (k + 1) * files):
            if empty is None:
                empty = scratch_path(spark, f"{name}-empty")
                spark.createDataFrame([], df.schema).coalesce(1).write.parquet(empty)
                empty += "/" + next(n for n in disk.names(empty) if n.endswith(".parquet"))
            disk.copy(empty, f"{path}/empty-{j:05d}.parquet")
    return path


def beat(env: DataFrame, entity: str) -> DataFrame:
    """A record a month after all others, which moves the watermark on."""
    last = F.timestamp_seconds(F.lit(1893456000 + 30 * 86400))
    return env.limit(1).select(F.lit(_BEAT[entity]).cast("binary").alias("value"), "topic", "partition",
                               F.lit(-1).cast("long").alias("offset"), last.alias("timestamp"))


def stream_reference(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Undated records of a producer -> bronze -> stream-stream join with their
    orders -> survivors of the log; those without an order come out undated."""
    paths = {}
    with preset(spark, CLEAN, BIG_STATE):
        for e in (name, "orders"):
            src, paths[e] = scratch_path(spark, f"in-{e}"), scratch_path(spark, f"bronze-{e}")
            env = bronze_jobs.reference_envelope(spark, sf_dir, e)
            env.unionByName(beat(env, e)).write.option("compression", "zstd").parquet(src)
            df = B.parse_envelope(envelope_stream(spark, src), e, clock=True)
            _run(sinks.start_append(df, paths[e], paths[e] + "-ckpt", partition_by=()))
            Files(spark, src).remove(src)
        # the log's text and tags are not in the result, so the join's state and the survivors go without
        dated = jobs.dated_stream(spark, name, paths[name], paths["orders"], without=bronze_jobs.UNPLACED)
        out = scratch_path(spark, f"dated-{name}")
        _run(merge.survivors_job(dated, name, out, out + "-ckpt", partition_by=()))
    return merge.read_survivors(spark, name, out).drop("processing_time", *LINEAGE)


# Records that only move the clock.  The order has a date, so it
# takes part in the join; the others fail silver's filters.
_BEAT = {"orders": '{"order_id": "-1", "order_date": "2030-01-31"}', "order_items": '{"order_id": "-2"}',
         "payments": '{"order_id": "-2"}'}


def stream_survivors(spark: SparkSession, sf_dir: str, entity: str = "shipments") -> DataFrame:
    """Records that arrive against the order of the log, over four micro-batches."""
    env = stored(bronze_jobs.placed_envelope(spark, sf_dir, entity), f"log-{entity}")
    files = turn_files(env, 4)
    src = publish_in_turn(env, 3 - F.pmod(F.col("offset"), F.lit(4)), 4, f"in-{entity}", files)
    rows = B.parse_envelope(envelope_stream(spark, src, max_files_per_trigger=files), entity, clock=True)
    rows = rows.drop(*bronze_jobs.UNPLACED)
    out = scratch_path(spark, f"survivors-{entity}")
    _run(merge.survivors_job(rows, entity, out, out + "-ckpt", partition_by=()))
    return merge.read_survivors(spark, entity, out).drop("processing_time", *LINEAGE)


def silver_in_turn(spark: SparkSession, sf_dir: str, entity: str, turns: int = 4) -> tuple[str, DataFrame]:
    """Silver rows written in the order of their time, and a stream over them."""
    rows = stored(medallion.silver_table(spark, sf_dir, entity), f"rows-{entity}")
    span = rows.agg(F.unix_timestamp(F.min("event_timestamp")).alias("lo"),
                    F.unix_timestamp(F.max("event_timestamp")).alias("hi")).first()
    wide = max(1, (span["hi"] - span["lo"]) // turns + 1)
    turn = F.floor((F.unix_timestamp("event_timestamp") - F.lit(span["lo"])) / wide)
    files = turn_files(rows, turns)
    path = publish_in_turn(rows, turn, turns, f"silver-{entity}", files)
    return path, layer_stream(spark, path, rows.schema, max_files_per_trigger=files)


def stream_update(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A gold table kept by key in update mode, without its approximate counts."""
    _, rows = silver_in_turn(spark, sf_dir, GOLD[table][0])
    out = scratch_path(spark, f"update-{table}")
    _run(merge.update_job(rows, table, out, out + "-ckpt", delay="7 days", whole_every=2))
    return merge.read_updates(spark, table, out).drop(*APPROXIMATE.get(table, ()))


#: Columns that a streaming aggregation can only estimate.
APPROXIMATE = {"daily_sales": ("total_orders", "total_products"), "seller_performance": ("total_orders",),
               "returns_kpi": ("returned_orders", "returned_products")}


def stream_sales_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows, each written once when the watermark closes it."""
    path, items = silver_in_turn(spark, sf_dir, "order_items")
    rows = spark.read.parquet(path)
    # a last row, years later, closes the windows of all others
    closing = rows.limit(1).withColumn("event_timestamp", F.lit("2100-01-01").cast("timestamp"))
    closing.coalesce(1).write.mode("append").parquet(path)
    out = scratch_path(spark, "windows")
    _run(merge.window_job(items, out, out + "-ckpt", delay="7 days"))
    return spark.read.parquet(out)


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year, every 10th of them in the turn after the last year's:
    main and side table together, with the reason."""
    orders = stored(medallion.silver_table(spark, sf_dir, "orders").select("order_id", "event_timestamp", "event_date"),
                    "rows-late")
    years = orders.agg(F.min(F.year("event_date")).alias("lo"), F.max(F.year("event_date")).alias("hi")).first()
    turn = F.when(F.col("order_id") % 10 == 0, F.lit(years["hi"] + 1)).otherwise(F.year("event_date")) - F.lit(years["lo"])
    turns = years["hi"] - years["lo"] + 2
    files = turn_files(orders, turns)
    path = publish_in_turn(orders, turn, turns, "in-late", files)
    rows = layer_stream(spark, path, orders.schema, max_files_per_trigger=files)
    main, side = scratch_path(spark, "main"), scratch_path(spark, "late")
    _run(routing.late_rows_job(rows, "30 days", main, side, main + "-ckpt", partition_by=()))
    cols = ["order_id", "event_timestamp"]
    return (spark.read.parquet(main).select(*cols, F.lit("on time").alias("reason"))
            .unionByName(spark.read.parquet(side).select(*cols, "reason")))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items, some of them broken, into bronze and rejects in one pass."""
    env = stored(bronze_jobs.broken_envelope(spark, sf_dir), "log-broken")
    files = turn_files(env, 3)
    src = publish_in_turn(env, F.pmod(F.col("offset"), F.lit(3)), 3, "in-broken", files)
    stream = envelope_stream(spark, src, max_files_per_trigger=files)
    good, bad = scratch_path(spark, "bronze"), scratch_path(spark, "rejects")
    _run(routing.quarantine_job(stream, "order_items", good, bad, good + "-ckpt", partition_by=()))
    both = [spark.read.parquet(p).select("offset", "raw_json", F.lit(rejected).alias("rejected"))
            for p, rejected in ((good, False), (bad, True))]
    return both[0].unionByName(both[1])


def stream_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments into one bronze table: even orders as ever, then odd ones with a
    new wire field that some of them leave empty; all read together."""
    from bazaar.specs import ENTITIES
    from bazaar.streaming import evolution

    env = B.to_wire(testdata.entity(spark, sf_dir, "payments"), "payments")
    text = F.col("value").cast("string")
    k = F.get_json_object(text, "$.order_id").cast("long")
    coupon = F.when(k % 5 == 0, F.lit("null")).otherwise(F.concat(F.lit('"C'), k % 10, F.lit('"')))
    new = F.concat(F.expr("substr(cast(value AS string), 1, length(cast(value AS string)) - 1)"),
                   F.lit(',"coupon":'), coupon, F.lit("}")).cast("binary")
    src, out = scratch_path(spark, "in-evolving"), scratch_path(spark, "evolving")
    old = ENTITIES["payments"]
    for ent, rows in ((old, env.where(k % 2 == 0)),
                      (old.extended(coupon="string"), env.where(k % 2 == 1).withColumn("value", new))):
        rows.write.mode("append").parquet(src)
        _run(jobs.bronze_job(spark, ent, src, out, out + "-ckpt", defaults={"coupon": "none"}, partition_by=()))
    return evolution.read(spark, out).select("order_id", "payment_value", "coupon", "event_date")
