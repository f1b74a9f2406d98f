"""Streams over several micro-batches: dates by order, survivors, updates,
windows, late rows, quarantine and published versions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bazaar.operators import bronze as B
from bazaar.operators import gold as G
from bazaar.operators.dating import date_by_order, date_by_order_stream
from bazaar.operators.silver import LINEAGE, silver
from bazaar.plans import stream_runs as SR
from bazaar.session import scratch_path
from bazaar.specs import ENVELOPE_SCHEMA
from bazaar.streaming import merge, routing, sinks
from bazaar.streaming.manifest import Versions
from bazaar.streaming.sources import envelope_stream, layer_stream

T0 = dt.datetime(2024, 1, 1)


def envelope(spark, rows, topic="t"):
    """rows: (value, partition, offset, minutes after T0)."""
    return spark.createDataFrame([(None if v is None else bytearray(v.encode()), topic, p, o, T0 + dt.timedelta(minutes=m))
                                  for v, p, o, m in rows], ENVELOPE_SCHEMA)


def bronze_rows(df):
    return sorted(((r.order_id, r.product_id, r.event_timestamp) for r in df.collect()), key=str)


# ---------------------------------------------------------------- dates

ORDERS = [('{"order_id": "1", "order_date": "2020-05-01"}', 0, 0, 0),
          ('{"order_id": "1", "order_date": "2021-01-01"}', 0, 9, 3),  # sent again with another date
          ('{"order_id": "2.0", "order_date": "2020-05-02"}', 1, 0, 30),
          ('{"order_id": "3", "order_date": "bad"}', 1, 1, 2), ('{"order_id": null, "order_date": "2020-05-05"}', 1, 2, 2)]
ITEMS = [('{"order_id": "1", "product_id": "7", "event_time": "2024-01-01T00:00:00"}', 0, 0, 1),
         ('{"order_id": "2", "product_id": "8"}', 0, 1, 5), ('{"order_id": "3", "product_id": "9"}', 0, 2, 5),
         ('{"order_id": "4", "product_id": "9"}', 0, 3, 6), ('{"product_id": "9"}', 0, 4, 6),
         ('{"order_id": "1", "product_id": "5", "business_time": "2019-01-01T10:00:00"}', 0, 5, 7)]
DATED = sorted([("1", "7", dt.datetime(2020, 5, 1)), ("2", "8", dt.datetime(2020, 5, 2)), ("3", "9", None), ("4", "9", None),
                (None, "9", None), ("1", "5", dt.datetime(2019, 1, 1, 10))], key=str)


def test_dates_come_from_the_order_in_batch(spark):
    items, orders = (B.parse_envelope(envelope(spark, r), e) for r, e in ((ITEMS, "order_items"), (ORDERS, "orders")))
    got = date_by_order(items, orders)
    assert bronze_rows(got) == DATED and got.columns == items.columns
    assert all((r.event_date is None) == (r.event_timestamp is None) for r in got.collect())
    assert bronze_rows(date_by_order(items, orders.limit(0)))[0][0] == "1"


def test_dates_come_from_the_order_in_a_stream(spark):
    src = {e: scratch_path(spark, f"in-{e}") for e in ("orders", "order_items")}
    out = scratch_path(spark, "dated")

    def run():
        rows, orders = (B.parse_envelope(envelope_stream(spark, src[e]), e) for e in ("order_items", "orders"))
        q = sinks.start_append(date_by_order_stream(rows, orders, "1 hour"), out, out + "-ckpt", partition_by=())
        q.awaitTermination()
        return q

    # items first: their orders come in the next micro-batches
    envelope(spark, ITEMS).write.parquet(src["order_items"])
    envelope(spark, ORDERS[:0]).write.parquet(src["orders"])
    run()
    early = bronze_rows(spark.read.parquet(out))
    assert (None, "9", None) in early and ("4", "9", None) not in early  # what has no key doesn't wait
    first = [o for o in ORDERS if "2021" not in o[0]]
    envelope(spark, first).write.mode("append").parquet(src["orders"])
    run()
    # an order that is sent again has its date already
    envelope(spark, [o for o in ORDERS if o not in first]).write.mode("append").parquet(src["orders"])
    run()
    assert ("2", "8", dt.datetime(2020, 5, 2)) in bronze_rows(spark.read.parquet(out))
    assert ("4", "9", None) not in bronze_rows(spark.read.parquet(out))
    # both clocks move on: what found no order comes out undated, and state goes
    envelope(spark, [('{"order_id": "-2", "product_id": "1"}', 0, 99, 600)]).write.mode("append").parquet(src["order_items"])
    envelope(spark, [('{"order_id": "-1", "order_date": "2024-01-01"}', 0, 99, 600)]).write.mode("append").parquet(src["orders"])
    q = run()
    got = [r for r in bronze_rows(spark.read.parquet(out)) if r[0] != "-2"]
    assert got == DATED
    assert sum(s["numRowsTotal"] for p in q.recentProgress[-1:] for s in p["stateOperators"]) < 8


# ------------------------------------------------------------- survivors

def payment(order, value, day="2024-03-01", **more):
    return ('{"order_id": "%d", "payment_method": "%s", "payment_value": "%s", "business_time": "%sT00:00:00"}'
            % (order, more.get("method", "card"), value, day))


def test_conflicting_copies_end_as_the_batch_row(spark):
    """Copies of a key come in the wrong order over four micro-batches."""
    turns = [[(payment(1, 30), 0, 30, 0), (payment(2, 5), 0, 31, 0), (payment(3, 7), 1, 2, 0)],
             [(payment(1, 20), 0, 20, 0), (payment(2, 6), 0, 40, 0), (payment(3, -1), 0, 1, 0)],
             [(payment(1, 10), 0, 10, 0), (payment(1, 11), 0, 10, 0), (payment(4, 1, "2024-03-02"), 1, 5, 0)],
             [(payment(1, 15), 0, 15, 0), (payment(4, 2, "2024-03-02"), 0, 6, 0)]]
    src, out = scratch_path(spark, "in-turns"), scratch_path(spark, "survivors")
    sizes = []
    for t in turns:
        envelope(spark, t).coalesce(1).write.mode("append").parquet(src)
        rows = B.parse_envelope(envelope_stream(spark, src), "payments", clock=True)
        merge.survivors_job(rows, "payments", out, out + "-ckpt").awaitTermination()
        sizes.append(spark.read.parquet(out).count())
    drop = ("processing_time", *LINEAGE)
    got = merge.read_survivors(spark, "payments", out)
    batch = silver("payments", B.parse_envelope(envelope(spark, [r for t in turns for r in t]), "payments"))
    cols = [c for c in batch.columns if c not in drop]
    assert sorted(got.select(*cols).collect()) == sorted(batch.select(*cols).collect())
    assert {r.order_id: r.payment_value for r in got.collect()} == {1: 10.0, 2: 5.0, 3: 7.0, 4: 2.0}
    assert sizes == [3, 4, 6, 7]  # only new keys and earlier copies are added
    # a replay of the last batch adds nothing
    fresh = silver("payments", B.parse_envelope(envelope(spark, turns[-1]), "payments"), clock=True)
    assert merge.new_survivors(fresh, spark.read.parquet(out), ["order_id", "event_timestamp"]).count() == 0


def test_survivors_read_only_the_touched_days(spark):
    path = scratch_path(spark, "days")
    rows = [(i, dt.date(2020, 1, 1 + i % 20)) for i in range(200)] + [(500, None)]
    spark.createDataFrame(rows, "v int, event_date date").write.partitionBy("event_date").parquet(path)
    days = spark.createDataFrame([(dt.date(2020, 1, 3),), (dt.date(2020, 1, 19),)], "event_date date")
    got = spark.read.parquet(path).where(merge.touched(days))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_date" in plan and got.count() == 20
    assert len(got.inputFiles()) and all("2020-01-03" in f or "2020-01-19" in f for f in
                                         [r[0] for r in got.select(F.input_file_name()).distinct().collect()])


# --------------------------------------------------------------- updates

def returned(spark, rows):
    """(return_id, order, product, day or None)"""
    typed = spark.createDataFrame(
        [(i, o, p, "r", d, None if d is None else dt.datetime.combine(d, dt.time(3))) for i, o, p, d in rows],
        "return_id string, order_id bigint, product_id bigint, return_reason string, return_date date, event_timestamp timestamp")
    return silver("returns", typed)


def test_update_mode_drops_state_and_equals_batch(spark):
    """Six micro-batches a month each: late rows to the side, the rest as the batch has it."""
    days = [[dt.date(2024, m, 1 + k % 28) for k in range(60)] for m in range(1, 7)]
    batches = [[(f"{m}-{k}", k % 17, k % 5, d) for k, d in enumerate(month)] for m, month in enumerate(days)]
    batches[3] += [(f"late-{k}", 500 + k, 1, dt.date(2024, 1, 5)) for k in range(7)]  # two months behind
    batches[4] += [(f"again-{k}", 600 + k, 1, dt.date(2024, 4, 27)) for k in range(4)]  # within the delay
    batches[5] += [("undated", 1, 1, None)]
    src, main, side, out = (scratch_path(spark, n) for n in ("in", "main", "side", "update"))
    every = [r for b in batches for r in b]
    schema = returned(spark, every[:1]).schema
    for b in batches:
        returned(spark, b).coalesce(1).write.mode("append").parquet(src)
    stream = layer_stream(spark, src, schema, max_files_per_trigger=1)
    q = routing.late_rows_job(stream, "10 days", main, side, main + "-ckpt", partition_by=())
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 6
    late = {r.return_id: r.reason for r in spark.read.parquet(side).collect()}
    assert late == {f"late-{k}": "late" for k in range(7)} | {"undated": "undated"}
    kept = spark.read.schema(schema).parquet(main)
    assert kept.count() + len(late) == len(every)
    # the main table, batch by batch as routed
    turn = scratch_path(spark, "turn")
    routed = spark.read.parquet(main)
    for b in range(6):
        routed.where(F.col("batch_id") == b).select(*schema.names).coalesce(1).write.mode("append").parquet(turn)
    q = merge.update_job(layer_stream(spark, turn, schema, max_files_per_trigger=1), "returns_kpi", out, out + "-ckpt",
                         "10 days", whole_every=3)
    q.awaitTermination()
    state = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsRemoved"] for s in state) > 100 and max(s["numRowsTotal"] for s in state) < 80
    assert all(s["numRowsDroppedByWatermark"] == 0 for s in state)  # the side table has them
    got = merge.read_updates(spark, "returns_kpi", out)
    want = G.build("returns_kpi", kept, distinct="approx")
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())
    # readers look at the last whole version and what came after it
    wholes = spark.read.parquet(out).where("whole = 'true'").agg(F.max("version")).first()[0]
    assert wholes >= 3 and merge.versions(spark, out, want.schema).agg(F.min("version")).first()[0] == wholes


def test_update_of_a_replayed_batch_changes_nothing(spark):
    out = scratch_path(spark, "replay")
    src = scratch_path(spark, "replay-in")
    rows = returned(spark, [(f"r{k}", k, k, dt.date(2024, 1, 1 + k % 3)) for k in range(30)])
    rows.coalesce(1).write.parquet(src)
    for ckpt in ("-a", "-b"):  # the second query writes batch 0 again
        merge.update_job(layer_stream(spark, src, rows.schema), "returns_kpi", out, out + ckpt, "1 day").awaitTermination()
    got = merge.read_updates(spark, "returns_kpi", out)
    assert sorted(r.total_returns for r in got.collect()) == [10, 10, 10]


# --------------------------------------------------------------- windows

def test_windows_come_out_when_they_close(spark):
    src, out = scratch_path(spark, "win-in"), scratch_path(spark, "win")
    items = spark.createDataFrame(
        [(o, float(t), dt.datetime(2024, 1, d, h)) for o, t, d, h in
         [(1, 10, 1, 1), (1, 20, 1, 2), (2, 5, 1, 3), (3, 1, 2, 1), (4, 2, 4, 1), (5, 3, 9, 1), (6, 7, 1, 5)]],
        "order_id bigint, item_total double, event_timestamp timestamp")
    turn = F.when(F.col("order_id") == 6, 3).when(F.dayofmonth("event_timestamp") == 1, 0).when(
        F.dayofmonth("event_timestamp") < 9, 1).otherwise(2)
    src = SR.publish_in_turn(items, turn, 4, "win-in")
    q = merge.window_job(layer_stream(spark, src, items.schema, max_files_per_trigger=1), out, out + "-ckpt", "1 day")
    q.awaitTermination()
    got = sorted((r.window_start.day, r.total_revenue, r.total_orders, r.avg_order_value) for r in spark.read.parquet(out).collect())
    # the last day's window is open still; the row of turn 3 came after its window had closed
    assert got == [(1, 35.0, 2, 11.67), (2, 1.0, 1, 1.0), (4, 2.0, 1, 2.0)]
    assert sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"]) >= 1


# ------------------------------------------------------------- quarantine

def test_quarantine_after_a_failure_between_the_writes(spark, monkeypatch):
    env = [('{"order_id": "%d", "product_id": "1"}' % k if k % 4 else '{"order_id": ', 0, k, k) for k in range(40)]
    src, good, bad = (scratch_path(spark, n) for n in ("q-in", "q-good", "q-bad"))
    envelope(spark, env[:20]).coalesce(1).write.parquet(src)

    def run():
        q = routing.quarantine_job(envelope_stream(spark, src), "order_items", good, bad, good + "-ckpt", partition_by=())
        q.awaitTermination()

    run()
    envelope(spark, env[20:]).coalesce(1).write.mode("append").parquet(src)
    write, calls = routing.write_batch, []

    def breaking(*a, **kw):
        calls.append(a)
        if len(calls) == 2:
            raise RuntimeError("lost between the two tables")
        return write(*a, **kw)

    monkeypatch.setattr(routing, "write_batch", breaking)
    with pytest.raises(Exception, match="lost between"):
        run()
    monkeypatch.setattr(routing, "write_batch", write)
    assert spark.read.parquet(good).count() + spark.read.parquet(bad).count() < 45
    run()
    kept, rejected = ([r.offset for r in spark.read.parquet(p).collect()] for p in (good, bad))
    assert sorted(kept) == [k for k in range(40) if k % 4] and sorted(rejected) == [k for k in range(40) if k % 4 == 0]


# --------------------------------------------------------------- versions

def test_reader_keeps_its_version_and_the_log_stays_short(spark):
    out = scratch_path(spark, "versions")
    v = Versions(spark, out)

    def put(n):
        assert v.publish(n, lambda folder: spark.range(n, n + 1).write.parquet(folder))
        v.retain(3)

    put(0)
    with sinks.reading(spark, out) as mine:
        for n in range(1, 9):
            put(n)
        assert [r.id for r in mine.collect()] == [0]
        assert v.numbers() == [0, 6, 7, 8]
    put(9)
    assert v.numbers() == [7, 8, 9]
    assert len(v.files.names(f"{out}/data")) == 3
    assert [r.id for r in sinks.read_complete(spark, out).collect()] == [9]
    assert [r.id for r in sinks.read_complete(spark, out, version=7).collect()] == [7]
    with pytest.raises(ValueError):
        sinks.read_complete(spark, scratch_path(spark, "empty"))


# ------------------------------------------------------------- evolution

def test_a_new_field_appears_in_mid_run(spark):
    from bazaar.specs import ENTITIES
    from bazaar.streaming import evolution, jobs
    src, out = scratch_path(spark, "evo-in"), scratch_path(spark, "evo")
    old = ENTITIES["payments"]
    new = old.extended(coupon="string", points="int")

    def wire(k, **more):
        rest = "".join(f', "{n}": {v}' for n, v in more.items())
        return '{"order_id": "%d", "payment_value": "%d", "business_time": "2024-01-0%dT00:00:00"%s}' % (k, k, 1 + k % 5, rest)

    def run(ent, rows):
        envelope(spark, [(r, 0, k, k) for k, r in enumerate(rows)]).write.mode("append").parquet(src)
        q = jobs.bronze_job(spark, ent, src, out, out + "-ckpt", defaults={"coupon": "none"})
        q.awaitTermination()

    run(old, [wire(1), wire(2, coupon='"X"')])  # the field is not known yet
    before = evolution.declared(spark, out)
    run(new, [wire(3, coupon='"Y"', points="7"), wire(4, coupon="null")])
    run(new, [wire(5)])
    kind = evolution.declared(spark, out)
    assert (before.version, kind.version) == (1, 2) and kind.since["coupon"] == 2 and kind.since["order_id"] == 1
    rows = {r.order_id: (r.coupon, r.points) for r in evolution.read(spark, out).collect()}
    assert rows == {"1": ("none", None), "2": ("none", None), "3": ("Y", "7"), "4": (None, None), "5": (None, None)}
    # as a stream, on to silver with the new fields typed
    dest = scratch_path(spark, "evo-silver")
    typed = silver("payments", evolution.read_stream(spark, out, 1), ent=new)
    sinks.start_append(typed, dest, dest + "-ckpt", partition_by=()).awaitTermination()
    got = {r.order_id: (r.coupon, r.points) for r in spark.read.parquet(dest).collect()}
    assert got == {1: ("none", None), 2: ("none", None), 3: ("Y", 7), 4: (None, None), 5: (None, None)}


def test_declared_columns_widen_but_never_narrow(spark):
    from pyspark.sql import types as T
    from bazaar.streaming import evolution
    path = scratch_path(spark, "declared")

    def put(ddl, n):
        df = spark.range(n).selectExpr(*[f"cast(id AS {t}) AS {c}" for c, t in ddl])
        evolution.fit(df, evolution.declare(spark, path, df.schema)).write.mode("append").parquet(path)

    put([("a", "int"), ("b", "float")], 2)
    put([("a", "bigint"), ("c", "string")], 3)
    put([("a", "int")], 1)  # an old writer goes on: its rows are widened
    kind = evolution.declared(spark, path)
    assert kind.version == 2 and kind.schema.simpleString() == "struct<a:bigint,b:float,c:string>"
    got = evolution.read(spark, path)
    assert got.count() == 6 and got.where("c IS NULL").count() == 3 and got.agg(F.sum("a")).first()[0] == 4
    with pytest.raises(ValueError, match="can't take the place"):
        evolution.declare(spark, path, T.StructType([T.StructField("a", T.StringType())]))
    with pytest.raises(ValueError):
        evolution.read(spark, scratch_path(spark, "undeclared"))


# ----------------------------------------------------------------- models

def test_scorer_takes_a_model_that_is_published_in_mid_run(spark):
    from bazaar.plans import recommend as RC

    def trained(shift):
        return RC.train(spark.range(200).select(
            (F.col("id") % 20).alias("customer_id"), (F.col("id") % 11).alias("product_id"),
            ((F.col("id") + shift) % 5 + 1).cast("float").alias("rating")), "rating", implicit=False)

    first, second = trained(0), trained(3)
    models, src, out = (scratch_path(spark, n) for n in ("models", "ev", "scored"))
    events = spark.range(40).select(F.to_json(F.struct((F.col("id") % 20).alias("user_id"), (F.col("id") % 11).alias("product_id")))
                                    .cast("binary").alias("value"), F.lit("user_events").alias("topic"), F.lit(0).alias("partition"),
                                    F.col("id").alias("offset"), F.lit(T0).alias("timestamp"))
    assert RC.publish_model(first, models) == 0
    events.write.parquet(src)
    q = RC.score_published(models, envelope_stream(spark, src), out, out + "-ckpt", trigger="1 second")
    try:
        q.processAllAvailable()
        assert RC.publish_model(second, models) == 1
        events.write.mode("append").parquet(src)
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    got = spark.read.parquet(out)
    pairs = RC.parse_user_events(events)
    for number, model in ((0, first), (1, second)):
        want = sorted(map(tuple, RC.score(model, pairs).collect()))
        mine = got.where(F.col("model_version") == number).select("user_id", "product_id", "prediction")
        assert sorted(map(tuple, mine.collect())) == want and want


# ---------------------------------------------------- jobs from end to end

class FakeKafka:
    """A session whose Kafka reader gives a file stream; it notes the options."""

    def __init__(self, spark, path):
        self.spark, self.path, self.options = spark, path, {}

    def __getattr__(self, name):
        return getattr(self.spark, name)

    @property
    def readStream(self):
        return self

    def format(self, name):
        assert name == "kafka"
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        # Kafka has more columns than the job reads
        return envelope_stream(self.spark, self.path).withColumn("key", F.lit(None).cast("binary")).withColumn("timestampType", F.lit(0))


@pytest.mark.parametrize("starting", ["earliest", "latest"])
def test_topic_to_bronze(spark, starting):
    from bazaar.streaming import jobs
    src, out = scratch_path(spark, "topic"), scratch_path(spark, "from-topic")
    envelope(spark, ORDERS, "orders_topic").write.parquet(src)
    kafka = FakeKafka(spark, src)
    jobs.kafka_bronze_job(kafka, "orders", "host1:9092,host2:9092", out, out + "-ckpt", trigger=None,
                          starting=starting).awaitTermination()
    assert kafka.options == {"kafka.bootstrap.servers": "host1:9092,host2:9092", "subscribe": "orders_topic",
                             "startingOffsets": starting}
    got = spark.read.parquet(out)
    assert got.count() == len(ORDERS) and got.where("topic = 'orders_topic' AND data_source = 'orders_topic'").count() == len(ORDERS)


def test_the_first_query_that_stops_ends_all(spark):
    src = scratch_path(spark, "any")
    envelope(spark, ORDERS).write.parquet(src)
    rows = envelope_stream(spark, src)
    out = scratch_path(spark, "any-out")
    live = sinks.start_append(B.parse_envelope(rows, "orders"), out, out + "-ckpt", trigger="1 second", partition_by=())
    short = sinks.start_debug(rows.select(F.col("value").cast("string").alias("text")), rows=3)
    sinks.run_until_any_stops([live, short])
    assert not live.isActive and not short.isActive
    assert sum(p["numInputRows"] for p in short.recentProgress) == len(ORDERS)
    assert "ConsoleTable" in short.lastProgress["sink"]["description"]
    sinks.run_until_any_stops([])
    # one that fails raises its error, one outside the list doesn't
    bad = rows.select(F.raise_error(F.lit("broken record")).alias("x"))
    sinks.start_debug(bad)
    live = sinks.start_append(B.parse_envelope(rows, "orders"), out, out + "-ckpt", trigger="1 second", partition_by=())
    with pytest.raises(Exception, match="broken record"):
        sinks.run_until_any_stops([live, sinks.start_debug(bad)])
    assert not live.isActive


def test_silver_state_without_bound_must_be_asked_for(spark):
    from bazaar.streaming import jobs
    with pytest.raises(ValueError, match="unbounded"):
        jobs.silver_job(spark, "orders", "/nowhere", "/nowhere", "/nowhere")


# ------------------------------------------------------------------ means

def test_means_keep_every_value(spark):
    from bazaar.functions.rounding import round2_avg
    inf, nan = float("inf"), float("nan")
    cases = [([inf, 1.0, 3.0], inf), ([2e18, 1.0], 1e18), ([nan, 1.0], nan), ([469 / 200, None], 2.35), ([None], None),
             ([1e-12, 1e-12], 0.0), ([inf, -inf], nan), ([1e300, 1e300], 1e300)]
    for values, want in cases:
        got = spark.createDataFrame([(x,) for x in values], "x double").agg(round2_avg("x")).first()[0]
        assert got == want or (want is not None and want != want and got != got), (values, got)
