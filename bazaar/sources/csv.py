"""CSV exports of the eight entities (header row, every field read as text;
the silver layer does the typing, so a column such as a promo code keeps its
leading zeros)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bazaar.specs import ENTITIES


def read_entity_csv(spark: SparkSession, path: str, entity: str,
                    extra_columns: tuple[str, ...] = ()) -> DataFrame:
    fields = list(ENTITIES[entity].fields) + list(extra_columns)
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .schema(schema).csv(path))
