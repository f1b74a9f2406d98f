"""Tables whose columns grow while they are written.

The declared columns of a table are kept beside its data, one immutable file
for each version.  Rows carry the version that they were written with.  A
reader takes the newest declaration; a column that a row's version did not
have is its typed default, and a NULL that was written stays NULL.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.streaming.manifest import Files

VERSION = "schema_version"

#: Type changes that lose nothing.
_WIDER = {("int", "bigint"), ("float", "double"), ("smallint", "int"), ("smallint", "bigint"),
          ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("date", "timestamp")}


@dataclass(frozen=True)
class Declared:
    """Columns of a table: the schema, the version that brought each, defaults."""

    version: int
    schema: T.StructType
    since: dict = field(default_factory=dict)
    defaults: dict = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"version": self.version, "schema": self.schema.jsonValue(), "since": self.since,
                           "defaults": self.defaults})

    @staticmethod
    def of(text: str) -> Declared:
        d = json.loads(text)
        return Declared(d["version"], T.StructType.fromJson(d["schema"]), d["since"], d["defaults"])


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/_declared"


def declared(spark: SparkSession, path: str) -> Declared | None:
    """The newest declaration of a table."""
    files = Files(spark, path)
    numbers = sorted(int(n) for n in files.names(_folder(path)) if n.isdigit())
    return Declared.of(files.text(f"{_folder(path)}/{numbers[-1]}")) if numbers else None


def merged(old: Declared | None, schema: T.StructType, defaults: dict) -> Declared:
    """``old`` with the new columns of ``schema`` added and types widened.

    Columns that ``schema`` lacks stay.  A type change that could lose a value
    is an error.
    """
    if old is None:
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        return Declared(1, plain, {f.name: 1 for f in schema}, dict(defaults))
    fields = {f.name: f.dataType for f in old.schema}
    since = dict(old.since)
    for f in schema:
        have = fields.get(f.name)
        if have is None:
            since[f.name] = old.version + 1
            fields[f.name] = f.dataType
        elif have != f.dataType:
            pair = have.simpleString(), f.dataType.simpleString()
            if pair in _WIDER:
                fields[f.name] = f.dataType
            elif pair[::-1] not in _WIDER:
                raise ValueError(f"column {f.name}: {pair[1]} can't take the place of {pair[0]}")
    new = T.StructType([T.StructField(n, t) for n, t in fields.items()])
    if new == old.schema and {**old.defaults, **defaults} == old.defaults:
        return old
    return Declared(old.version + 1, new, since, {**old.defaults, **defaults})


def declare(spark: SparkSession, path: str, schema: T.StructType, defaults: dict | None = None) -> Declared:
    """Declare the columns that a writer is about to write; returns the merged ones.

    Writers that declare at the same time each create the next version's file;
    the one that comes second merges into the first's.
    """
    files = Files(spark, path)
    while True:
        old = declared(spark, path)
        new = merged(old, schema, defaults or {})
        if old is not None and new.version == old.version:
            return old
        if files.create(f"{_folder(path)}/{new.version}", new.text()):
            return new


def fit(df: DataFrame, kind: Declared) -> DataFrame:
    """Rows in the declared columns and types, tagged with the version."""
    have = set(df.columns)
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else
            F.lit(kind.defaults.get(f.name)).cast(f.dataType).alias(f.name) for f in kind.schema]
    return df.select(*cols, F.lit(kind.version).alias(VERSION))


def filled(rows: DataFrame, kind: Declared) -> DataFrame:
    """Defaults for the columns that a row's version did not have."""
    cols = []
    for f in kind.schema:
        c, since = F.col(f.name), kind.since[f.name]
        if since > 1 and kind.defaults.get(f.name) is not None:
            old = F.coalesce(F.col(VERSION), F.lit(1)) < since
            c = F.when(old, F.lit(kind.defaults[f.name]).cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return rows.select(*cols)


def stored_schema(kind: Declared) -> T.StructType:
    return T.StructType([*kind.schema.fields, T.StructField(VERSION, T.IntegerType())])


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table, old and new, in its newest columns."""
    kind = declared(spark, path)
    if kind is None:
        raise ValueError(f"no columns are declared for {path}")
    return filled(spark.read.schema(stored_schema(kind)).parquet(path), kind)


def read_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream, in the columns that are declared when it starts."""
    from bazaar.streaming.sources import layer_stream
    kind = declared(spark, path)
    return filled(layer_stream(spark, path, stored_schema(kind), max_files_per_trigger), kind)
