"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit set if over half of its word shingles'
64-bit hashes have it.  Two fingerprints within ``distance`` bits must agree
in one of their two halves up to ``distance // 2`` bits, so each half is a
table key: every fingerprint is stored under its exact halves and looked up
under the small Hamming ball around them.  Of two keys that differ in one bit
exactly one has even parity, so only even keys enumerate their ball.  Matches
are verified over all 64 bits.

Equal fingerprints are one node, so groups of copies are never paired.  A
bucket with more than ``BUCKET`` fingerprints is joined on balls in the
quarters of the other half as well, which is exact and keeps the pairs few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import stored
from bazaar.llm.components import connected_components

SHINGLE = 3
DISTANCE = 3
SEED = 42
BUCKET = 200

#: Words split at a time; bounds the memory of one very long text.
BLOCK_WORDS = 200_000


def _hash_blocks(data: bytes, shingle: int) -> Iterator[list[int]]:
    """Hashes of all word shingles, a block of words at a time."""
    digest = xxhash.xxh64_intdigest
    held: list[bytes] = []
    first, rest = True, data
    while rest:
        words = rest.split(None, BLOCK_WORDS)
        rest = words.pop() if len(words) > BLOCK_WORDS else b""
        words = held + words
        if len(words) < shingle:
            if rest:
                held = words
                continue
            if first and words:
                yield [digest(b" ".join(words), SEED)]
            return
        yield [digest(b" ".join(w), SEED) for w in zip(*(words[k:] for k in range(shingle)), strict=False)]
        first = False
        held = words[len(words) - shingle + 1:] if shingle > 1 else []


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text; 0 if it has no word."""
    counts, n = np.zeros(64, np.int64), 0
    for block in _hash_blocks((text or "").encode("utf-8", "surrogatepass").lower(), shingle):
        for k in range(0, len(block), 4096):
            h = np.array(block[k:k + 4096], np.uint64)
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            n += len(h)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")
    return of


def _halves(fp: Column) -> list[Column]:
    return [F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF))]


def _index(fps: DataFrame) -> DataFrame:
    seg = F.explode(F.array(*(F.struct(F.lit(s).alias("seg"), h.alias("key"), o.alias("other")) for s, (h, o) in
                              enumerate(zip(_halves(F.col("fp")), _halves(F.col("fp"))[::-1], strict=True)))))
    return fps.select("fp", seg.alias("e")).select("fp", "e.*")


def _ball(df: DataFrame, key: str, bits: int, even_only: bool) -> DataFrame:
    """Rows with ``key`` flipped in no bit and in each single bit (``flip``)."""
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << k).cast("long") for k in range(bits)))
    if even_only:
        flips = F.when(F.bit_count(key) % 2 == 0, flips).otherwise(F.array(F.lit(0).cast("long")))
    return (df.withColumn("flip", F.explode(flips))
            .withColumn(key, F.col(key).bitwiseXOR(F.col("flip"))))


def _close(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """All pairs (a, b) of distinct fingerprints within ``distance`` bits."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves with balls of one bit find distances up to 3")
    index = _index(fps)
    hot = stored(index.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket)
                 .select("seg", "key", F.lit(True).alias("hot")), "hot-buckets")
    some_hot = not hot.isEmpty()
    table = index.select("seg", "key", F.col("fp").alias("b"), F.col("other").alias("bo"))
    probe = _ball(index, "key", 32, even_only=True).withColumnRenamed("fp", "a")
    once = (F.col("flip") != 0) | (F.col("a") < F.col("b"))
    if not some_hot:
        found = probe.join(table, ["seg", "key"])
        return found.where(once & _close("a", "b", distance)).select("a", "b").distinct()
    table = table.join(hot, ["seg", "key"], "left")
    probe = probe.join(hot, ["seg", "key"], "left")
    cold = probe.where("hot IS NULL").drop("hot").join(table.where("hot IS NULL").drop("hot"), ["seg", "key"])
    # the other half differs in at most 3 bits, so one of its quarters in at most 1
    quarters = lambda c: F.explode(F.array(
        F.struct(F.lit(0).alias("q"), F.shiftright(c, 16).alias("qk")),
        F.struct(F.lit(1).alias("q"), F.col(c).bitwiseAND(F.lit(0xFFFF)).alias("qk"))))
    fine = table.where("hot").select("seg", "key", "b", quarters("bo").alias("e")).select("seg", "key", "b", "e.*")
    ask = (probe.where("hot").select("seg", "key", "a", F.col("flip").alias("flip1"), quarters("other").alias("e"))
           .select("seg", "key", "a", "flip1", "e.*"))
    ask = _ball(ask, "qk", 16, even_only=False).drop("flip").withColumnRenamed("flip1", "flip")
    warm = ask.join(fine, ["seg", "key", "q", "qk"])
    pairs = [x.where(once & _close("a", "b", distance)).select("a", "b") for x in (cold, warm)]
    return pairs[0].unionByName(pairs[1]).distinct()


def components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, component_id, first_fp) from ``prints`` (doc_id, fp).

    ``component_id`` is the smallest doc_id of the component, ``first_fp`` the
    smallest fingerprint of that document.
    """
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    nodes = stored(nodes, "fingerprints")
    comps = connected_components(links(nodes.select("fp"), distance))
    rooted = nodes.join(comps, nodes["fp"] == comps["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(
        F.min(F.struct(F.col("low").isNull().alias("none"), "low", "fp")).alias("first"))
    return rooted.join(least, "root").select(
        "fp", F.col("first.low").alias("component_id"), F.col("first.fp").alias("first_fp"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id.

    Null and empty texts have fingerprint zero and link like any other.  A
    null id never names a component that has other ids.  Repeated rows share a
    component.  An empty table gives an empty result.
    """
    fp = fingerprint_udf(shingle)(F.col(text_col))
    prints = stored(docs.select(F.col(id_col).alias("doc_id"), fp.alias("fp")), "prints")
    comps = components(prints, distance).drop("first_fp")
    return (prints.join(comps, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component its smallest id."""
    fp = fingerprint_udf(shingle)(F.col(text_col))
    full = stored(docs.select(F.col(id_col).alias("doc_id"), fp.alias("fp"), F.struct("*").alias("row")), "with-prints")
    comps = components(full.select("doc_id", "fp"), distance)
    stay = (comps.where(F.col("fp") == F.col("first_fp"))
            .select(F.col("fp").alias("first_fp"), "component_id"))
    same = Window.partitionBy("fp", "doc_id").orderBy("fp")
    return (full.join(stay, (F.col("fp") == F.col("first_fp")) & F.col("doc_id").eqNullSafe(F.col("component_id")))
            .withColumn("r", F.row_number().over(same)).where("r = 1").select("row.*"))
