"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from bazaar.session import CLEAN, preset, scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read by Spark's own parquet reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of repeating
    the work, and several readers share one computation.  The shuffle files
    that led to it go.  ``by``: columns with few values, whose rows are read apart.
    """
    path = scratch_path(df.sparkSession, name)
    with preset(df.sparkSession, CLEAN):
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_ROOT = Path(__file__).resolve().parents[2]
_ON_PATH = str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or Path.cwd() == _ROOT
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers unless they can import it.

    On a cluster it is normally installed or given to spark-submit with
    ``--py-files``; a session that was started elsewhere gets a zip of it.
    """
    app = spark.sparkContext.applicationId
    if _ON_PATH or app in _shipped:
        return
    target = os.path.join(tempfile.mkdtemp(prefix="bazaar-zip-"), "bazaar.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((_ROOT / "bazaar").rglob("*.py")):
            z.write(f, f.relative_to(_ROOT))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
