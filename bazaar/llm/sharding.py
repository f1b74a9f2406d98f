"""Sharding by weighted rendezvous hashing of stable record keys.

A record goes to the shard with the highest score
``weight / -ln(h(key, shard))``.  The score of a shard does not depend on the
other shards, so one more shard takes records only into itself, and a changed
weight moves only records to or from that shard.

One MD5 of the key gives uniform words x and y; shard s hashes them to
``(a_s x + b_s y) mod p``, a pairwise independent family in plain integer
arithmetic.  It stays inside code generation and any SQL engine can repeat it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Modulus of the hash family (a Mersenne prime).
PRIME = (1 << 31) - 1

#: Groups per shard in which slots are counted; a documented parameter.
SLOT_GROUPS = 256


def factors(shard: int) -> tuple[int, int]:
    """The two multipliers of a shard, the same in every run."""
    d = hashlib.md5(f"shard {shard}".encode()).digest()
    return tuple(int.from_bytes(d[k:k + 4], "big") % (PRIME - 1) + 1 for k in (0, 4))


def key_words(key: Column) -> tuple[Column, Column, Column]:
    """Three uniform words of a key; a null key counts as the empty string."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return tuple((F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") % PRIME) for k in range(3))


def rendezvous(x: Column, y: Column, weights: Sequence[float]) -> Column:
    """Shard number of a key's words; ties go to the smaller shard."""
    equal = len(set(weights)) == 1
    scored = []
    for s, w in enumerate(weights):
        a, b = factors(s)
        h = (x * F.lit(a) % PRIME + y * F.lit(b) % PRIME) % PRIME
        score = h if equal else F.lit(float(w)) / -F.log((h + F.lit(0.5)) / F.lit(float(PRIME)))
        scored.append(F.struct(score.alias("score"), F.lit(-s).alias("shard")))
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best["shard"]).cast("int")


def assign_shards(df: DataFrame, key_col: str, weights: Sequence[float],
                  out: str = "shard") -> DataFrame:
    """Add the shard of each record.  ``weights[s]`` is shard ``s``'s share.

    Keys of any type are hashed by their text.  Columns of ``df`` are left
    alone, whatever their names, but for ``out``.
    """
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("shard weights must be positive")
    x, y, _ = key_words(F.col(key_col))
    kept = [F.col(f"row.`{c}`") for c in df.columns if c != out]
    return (df.select(F.struct("*").alias("row"), x.alias("x"), y.alias("y"))
            .select(*kept, rendezvous(F.col("x"), F.col("y"), weights).alias(out)))


def number_slots(df: DataFrame, shard_col: str, group: Column, order: Sequence[str],
                 out: str = "slot", groups: int = SLOT_GROUPS) -> DataFrame:
    """Gapless positions from 0 inside each shard.

    A shard is cut into ``groups`` groups by the value of ``group``.  Groups are
    counted (a table of shards x groups rows), their offsets summed, and rows
    numbered inside their group only, so no task sees a whole shard.  The
    frame's columns may have any names.
    """
    taken = {c.lower() for c in [*df.columns, out]}

    def fresh(name: str) -> str:
        while name in taken:
            name = f"_{name}"
        return name

    g_, n_, s_, h_, before_, rank_ = map(fresh, ("_g", "_n", "_s", "_h", "_before", "_rank"))
    g = df.withColumn(g_, F.pmod(group, F.lit(groups)).cast("int"))
    sizes = g.groupBy(shard_col, g_).agg(F.count(F.lit(1)).alias(n_))
    before = Window.partitionBy(shard_col).orderBy(g_).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(shard_col).alias(s_), F.col(g_).alias(h_),
                           F.coalesce(F.sum(n_).over(before), F.lit(0)).alias(before_))
    inside = Window.partitionBy(shard_col, g_).orderBy(*order)
    ranked = g.withColumn(rank_, F.row_number().over(inside))
    return (ranked.join(F.broadcast(offsets),  # at most shards x groups rows
                        (F.col(shard_col) == F.col(s_)) & (F.col(g_) == F.col(h_)))
            .withColumn(out, (F.col(before_) + F.col(rank_) - 1).cast("long"))
            .drop(g_, s_, h_, before_, rank_))


def shard_documents(docs: DataFrame, shards: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Shard, position and what ``shards + 1`` would give, for every row.

    Null text has size 8 and the checksum of the empty text.  Rows that repeat
    an id share its shard and have slots of their own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    x, y, z = key_words(F.col("doc_id"))
    words = slim.withColumns({"_x": x, "_y": y, "_z": z})
    placed = words.select(
        "doc_id", "size", "text_crc32", (F.col("_z") + F.col("text_crc32")).alias("_word"),
        rendezvous(F.col("_x"), F.col("_y"), [1.0] * shards).alias("shard"),
        rendezvous(F.col("_x"), F.col("_y"), [1.0] * (shards + 1)).alias("grown_shard"))
    return (number_slots(placed, "shard", F.col("_word"), ["doc_id", "text_crc32", "size"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                    "grown_shard"))


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], key_col: str = "doc_id") -> None:
    """Write the records as one folder per shard (``shard=<n>``)."""
    placed = assign_shards(docs, key_col, weights, out="shard")
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)

