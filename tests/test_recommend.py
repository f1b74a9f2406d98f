from pyspark.sql import functions as F

from bazaar.operators.indexing import dense_index
from bazaar.plans import recommend as RC

from conftest import SF001


def test_dense_index_large_and_repeated_keys(spark):
    big = 2**40
    df = spark.range(5000).select(((F.col("id") % 1200) * big + 7).alias("k"))  # repeats, > 2^31
    idx = dense_index(df, "k", "i")
    rows = sorted((r["k"], r["i"]) for r in idx.collect())
    assert len(rows) == 1200
    assert [i for _, i in rows] == list(range(1200))  # dense and in key order


def test_als_on_64_bit_ids(spark):
    big = 2**35
    ratings = spark.range(400).select(
        (F.col("id") % 40 + big).alias("customer_id"), (F.col("id") % 25 + 3 * big).alias("product_id"),
        ((F.col("id") % 5) + 1).cast("float").alias("rating"))
    rec = RC.train(ratings, "rating", implicit=False)
    pairs = ratings.select("customer_id", "product_id").distinct()
    out = RC.score(rec, pairs)
    assert out.count() == pairs.count()
    assert out.where(F.isnan("prediction")).count() == 0
    summ = {r["side"]: r["n"] for r in RC.factor_summary(rec).collect()}
    assert summ == {"user": 40, "item": 25}
    # unknown ids: cold start -> dropped
    cold = spark.createDataFrame([(1, 2)], "customer_id bigint, product_id bigint")
    assert RC.score(rec, cold).count() == 0


def test_saved_model_gives_the_same_scores(spark):
    from bazaar.plans import recommend as RC
    from bazaar.session import scratch_path
    r = RC.fitted(spark, SF001)
    path = scratch_path(spark, "als")
    RC.save(r, path)
    pairs = RC.explicit_ratings(spark, SF001)
    a = sorted(map(tuple, RC.score(r, pairs).collect()))
    b = sorted(map(tuple, RC.score(RC.load(spark, path), pairs).collect()))
    assert a == b and a
