"""A corpus pipeline of five operators over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before has kept; all but the last return the columns of ``documents``.  Extra
columns are carried along, whatever their names, and empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm import byte_cnn, decontaminate, exact_dedup, sentencepiece_scan, simhash
from bazaar.llm.common import read_table, ship_package, stored
from bazaar.llm.queries import VOCABULARY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; a null text is scored as
    an empty one, and equal texts stay or go together."""
    model = byte_cnn.train(docs, read_table(spark, sf_dir, "labels"))
    return byte_cnn.keep_good(docs, model, threshold=0.3)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id;
    null texts are equal to empty ones, and a null id is the smallest."""
    return exact_dedup.drop_copies(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that with the smallest id; null
    and empty texts are one component, and a null id stays only if no other does."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a leaked benchmark item; null and empty texts and items
    leak nothing, and of rows that repeat an id those with the leak go."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of each document, with the proof of the round trip;
    null and empty texts have no ids, and repeated rows give repeated rows."""
    return sentencepiece_scan.encode(docs, sentencepiece_scan.read_vocabulary(spark, VOCABULARY))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("benchmark decontamination", benchmark_free),
    ("sentencepiece", tokens),
]

#: The classifier and the vocabulary can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each result is written and reread."""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
