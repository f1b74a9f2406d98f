"""Customer x product factor model (Spark ML ALS) and stream scoring.

Training data (the model's training code is not part of the contract, so
the choice is ours): explicit ratings from silver reviews, or implicit
purchase counts from orders joined to order items.  Scoring applies the
fitted model to a stream of (user_id, product_id) events: the model's
transform is a stream-static join with the factor tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.operators.indexing import dense_index
from bazaar.plans.medallion import silver_table
from bazaar.session import scratch_path, shared_dir
from bazaar.specs import USER_EVENTS_SCHEMA
from bazaar.streaming.manifest import Versions
from bazaar.streaming.routing import write_batch
from bazaar.streaming.sinks import apply_trigger

# Factor model settings (rank, block size, cold-start policy).
RANK = 15
BLOCK_SIZE = 4096
COLD_START = "drop"

#: A task holds a block's ratings and the factors that they need, so blocks grow in number, not in size.
RATINGS_PER_BLOCK = 4_000_000
LEAST_BLOCKS = 10
#: Iterations after which factors are written and the shuffle files that led to them go.
CHECKPOINT_EVERY = 2


def blocks_of(ratings: DataFrame) -> int:
    """Blocks of users and of items."""
    return max(LEAST_BLOCKS, -(-ratings.count() // RATINGS_PER_BLOCK))


def _als(rating_col: str, implicit: bool, **kw) -> ALS:
    return ALS(rank=RANK, userCol="customer_idx", itemCol="product_idx", ratingCol=rating_col,
               coldStartStrategy=COLD_START, blockSize=BLOCK_SIZE, implicitPrefs=implicit,
               seed=42, nonnegative=implicit, checkpointInterval=CHECKPOINT_EVERY, **kw)


@dataclass
class Recommender:
    model: ALSModel
    customers: DataFrame   # customer_id -> customer_idx
    products: DataFrame    # product_id -> product_idx


def _indexed(r: Recommender, pairs: DataFrame) -> DataFrame:
    """Attach dense indices; ids unseen in training find no index and are
    dropped, which is the model's cold-start policy."""
    return pairs.join(r.customers, "customer_id").join(r.products, "product_id")


def explicit_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = silver_table(spark, sf_dir, "reviews", keep=("customer_id", "product_id", "rating"))
    return r.select("customer_id", "product_id", F.col("rating").cast("float"))


def implicit_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases per (customer, product): order items joined to their order's
    customer.  Orders are first reduced to one row per order_id, so the join
    is many-to-one and both sides shuffle on order_id only once."""
    o = silver_table(spark, sf_dir, "orders", keep=("order_date", "customer_id")).groupBy("order_id").agg(
        F.min(F.struct("order_date", "customer_id"))["customer_id"].alias("customer_id"))
    i = silver_table(spark, sf_dir, "order_items", keep=()).select("order_id", "product_id")
    return i.join(o, "order_id").groupBy("customer_id", "product_id").agg(
        F.count(F.lit(1)).cast("float").alias("purchases"))


def train(ratings: DataFrame, rating_col: str, implicit: bool) -> Recommender:
    ratings = ratings.checkpoint()  # read by both indexers and by ALS
    customers = dense_index(ratings, "customer_id", "customer_idx").checkpoint()
    products = dense_index(ratings, "product_id", "product_idx").checkpoint()
    rec = Recommender(None, customers, products)
    n = blocks_of(ratings)
    model = _als(rating_col, implicit, numUserBlocks=n, numItemBlocks=n).fit(_indexed(rec, ratings))
    return Recommender(model, customers, products)


def save(r: Recommender, path: str) -> None:
    """Model and id maps together."""
    r.model.write().overwrite().save(f"{path}/model")
    r.customers.write.mode("overwrite").parquet(f"{path}/customers")
    r.products.write.mode("overwrite").parquet(f"{path}/products")


def load(spark: SparkSession, path: str) -> Recommender:
    return Recommender(ALSModel.load(f"{path}/model"), spark.read.parquet(f"{path}/customers"),
                       spark.read.parquet(f"{path}/products"))


_CACHE: dict = {}


def fitted(spark: SparkSession, sf_dir: str, implicit: bool = False) -> Recommender:
    k = (spark.sparkContext.applicationId, sf_dir, implicit)
    if k not in _CACHE:
        shared_dir(spark)
        if implicit:
            _CACHE[k] = train(implicit_purchases(spark, sf_dir), "purchases", True)
        else:
            _CACHE[k] = train(explicit_ratings(spark, sf_dir), "rating", False)
    return _CACHE[k]


def score(r: Recommender, pairs: DataFrame) -> DataFrame:
    return r.model.transform(_indexed(r, pairs)).select("customer_id", "product_id", "prediction")


def factor_summary(r: Recommender) -> DataFrame:
    m = r.model
    u = m.userFactors.agg(F.count(F.lit(1)).alias("n")).select(F.lit("user").alias("side"), "n")
    i = m.itemFactors.agg(F.count(F.lit(1)).alias("n")).select(F.lit("item").alias("side"), "n")
    return u.unionByName(i).withColumn("rank", F.lit(m.rank))


def parse_user_events(env: DataFrame) -> DataFrame:
    """JSON (user_id, product_id) -> model columns (user_id is the customer)."""
    p = env.select(F.from_json(F.col("value").cast("string"), USER_EVENTS_SCHEMA).alias("e"))
    return p.select(F.col("e.user_id").cast("bigint").alias("customer_id"),
                    F.col("e.product_id").cast("bigint").alias("product_id"))


def score_stream(r: Recommender, events: DataFrame, out: str, ckpt: str, trigger=None):
    """Score a stream of user events (any envelope stream, Kafka or files)
    with a fitted or loaded model into a parquet table."""
    from bazaar.streaming.sinks import start_append

    scored = score(r, parse_user_events(events)).withColumnRenamed("customer_id", "user_id")
    return start_append(scored, out, ckpt, trigger, partition_by=(), name="als_scores")


def publish_model(r: Recommender, base: str, number: int | None = None) -> int:
    """Save the model as the next immutable version under ``base``."""
    versions = Versions(r.customers.sparkSession, base)
    last = versions.latest()
    number = (0 if last is None else last + 1) if number is None else number
    if not versions.publish(number, lambda folder: save(r, folder)):
        raise ValueError(f"version {number} is published already")
    return number


def score_published(models: str, events: DataFrame, out: str, ckpt: str, trigger=None):
    """Score a stream with the newest published model under ``models``.

    Each micro-batch looks the newest version up; its factors are loaded when it
    changes, without a restart.  Rows carry ``model_version``; a replayed batch
    replaces its own rows.
    """
    spark = events.sparkSession
    versions, held = Versions(spark, models), {}

    def run(batch: DataFrame, batch_id: int) -> None:
        number = versions.latest()
        if number is None:
            raise ValueError(f"no model is published under {models}")
        if number not in held:
            held.clear()
            held[number] = load(spark, versions.folder(number))
        scored = score(held[number], batch).withColumnRenamed("customer_id", "user_id")
        write_batch(scored.withColumn("model_version", F.lit(number).cast("long")), out, batch_id)

    w = (parse_user_events(events).writeStream.option("checkpointLocation", ckpt).foreachBatch(run)
         .queryName("als_scores_published"))
    return apply_trigger(w, trigger).start()


def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a model and review pairs as user events, score them with a
    streaming query (availableNow) that loads the model, return its table."""
    from bazaar.streaming.sources import envelope_stream

    pairs = silver_table(spark, sf_dir, "reviews", keep=("customer_id", "product_id")).select(
        "customer_id", "product_id", "event_timestamp")
    value = F.to_json(F.struct(F.col("customer_id").alias("user_id"), F.col("product_id")))
    env = pairs.select(value.cast("binary").alias("value"), F.lit("user_events").alias("topic"),
                       F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
                       F.col("event_timestamp").alias("timestamp"))
    src, out, models = (scratch_path(spark, n) for n in ("in-user-events", "scores", "models"))
    env.write.parquet(src)
    publish_model(fitted(spark, sf_dir), models)
    q = score_published(models, envelope_stream(spark, src), out, out + "-ckpt")
    q.awaitTermination()
    return spark.read.parquet(out).select("user_id", "product_id", "prediction")
