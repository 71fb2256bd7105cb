"""Writing results: parquet, CSV and JSON, and SQL text run straight into a table."""

from __future__ import annotations

from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and return the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_sql_string(spark: SparkSession, sql: str, params: dict[str, str] | None = None,
                   output_parquet: str | None = None) -> DataFrame:
    """Run a query, with session settings ``params``; write it when a path is given.

    A query that is written leaves the settings as they were. One that is not runs later, so
    its settings stay.
    """
    before = {key: spark.conf.get(key, None) for key in params or {}}
    for key, value in (params or {}).items():
        spark.conf.set(key, value)
    result = spark.sql(sql.strip().rstrip(";"))
    if output_parquet is None:
        return result
    try:
        return write_parquet(result, output_parquet)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def run_sql_file(spark: SparkSession, sql_path: str, params: dict[str, str] | None = None,
                 output_parquet: str | None = None) -> DataFrame:
    path = Path(sql_path)
    if not path.exists():
        raise FileNotFoundError(f"SQL file not found: {path}")
    return run_sql_string(spark, path.read_text(encoding="utf-8"), params, output_parquet)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a CSV table; a missing path gives an empty table of that schema."""
    try:
        return spark.read.option("header", True).schema(schema).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
