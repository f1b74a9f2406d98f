"""Exact deduplication: tree merge of digest runs.

Every input partition yields runs of (digest, length, check hash) with the
surviving identifier and the number of rows so far.  Runs are merged in
binomial rounds: round ``r`` brings together the ``fan_in`` runs whose numbers
agree after dropping ``r`` digits, so a digest meets its copies level by level
and a hot digest is never gathered by one task before it has been reduced to
one row per run.  The digest range is spread over all tasks at every level.

An identifier is verified at each level: rows count as copies only if SHA-256,
byte length and a second, independent 64-bit hash all agree.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUNS = 64
FAN_IN_BITS = 3

_KEY = ["_digest", "_bytes", "_check"]


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _keyed(id_col: Column, text: Column, *more: Column) -> list[Column]:
    return [id_col.alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("_digest"),
            F.octet_length(text).alias("_bytes"), F.xxhash64(text).alias("_check"),
            F.pmod(F.hash(id_col), F.lit(RUNS)).alias("_run"), *more]


def merge_runs(keyed: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per (digest, run): the survivor and size of the whole group.

    Upward: ``log(RUNS) / FAN_IN_BITS`` rounds of merging.  Downward: the
    root's answer goes back to the (at most ``RUNS``) runs of its digest.
    """
    best = F.max if keep == "largest" else F.min
    level = keyed.groupBy(*_KEY, "_run").agg(best("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    leaves, width = level.select(*_KEY, "_run"), RUNS
    while width > 1:
        level = (level.withColumn("_run", F.shiftright("_run", FAN_IN_BITS))
                 .groupBy(*_KEY, "_run").agg(best("_keep").alias("_keep"), F.sum("_n").alias("_n")))
        width >>= FAN_IN_BITS
    return leaves.join(level.drop("_run"), _KEY)


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest", carry: bool = False) -> DataFrame:
    """Every row with ``_keep`` (survivor's id), ``_n`` (group size), ``_kept``.

    Null text counts as empty.  Of rows that repeat the surviving id with the
    same text exactly one is kept.  A null id survives only if its group has
    no other id.  An empty table gives an empty result.  With ``carry`` the
    input's columns come along as the struct ``row``.
    """
    more = [F.struct("*").alias("row")] if carry else []
    keyed = docs.select(*_keyed(F.col(id_col), _text(text_col), *more))
    groups = merge_runs(keyed.select("doc_id", *_KEY, "_run"), keep)
    same = Window.partitionBy(*_KEY, "_run", "doc_id").orderBy("doc_id")
    return (keyed.join(groups, [*_KEY, "_run"])
            .withColumn("_rn", F.row_number().over(same))
            .withColumn("_kept", F.col("doc_id").eqNullSafe(F.col("_keep")) & (F.col("_rn") == 1)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    return mark_copies(docs, id_col, text_col, keep).select(
        "doc_id", F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"),
        F.col("_kept").alias("kept"), F.lower(F.hex("_digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest") -> DataFrame:
    """The surviving rows of ``docs`` with all their columns."""
    return mark_copies(docs, id_col, text_col, keep, carry=True).where("_kept").select("row.*")
