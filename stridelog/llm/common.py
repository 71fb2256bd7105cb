"""What several corpus operators share: session options, checked broadcasts, written tables."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelog.session import new_path

# Rows and bytes handed to a Python worker at once; a worker cuts these further by text size.
_ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}

# A table of at most this many rows of a few numbers may be broadcast.
BROADCAST_ROWS = 200_000


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Ready a session: this package on all Python workers, and Arrow batches of moderate size."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_zipped_package())
        _shipped.add(context.applicationId)
    for key, value in _ARROW.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _zipped_package() -> str:
    """This package as a zip file, which Spark serves from the driver to its executors."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), "stridelog.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    return path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def hash128(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of the same values, taken together as a 128-bit key."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, so that later jobs start from files."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if a written table has few rows; beyond that the join shuffles."""
    return F.broadcast(df) if df.count() <= most else df
