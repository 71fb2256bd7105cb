"""Reading the event log and the tables of later stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelog.config import BANNED_EVENTS, EVENT, TS
from stridelog.functions.columns import flag, is_known_in, share_pct

# Names a flat session column may have.
SESSION_COLUMNS = ("properties.canvas_id", "canvas_id")
SESSION_KEY = "canvas_id"


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name}`")


def read_table(spark: SparkSession, path: str, what: str = "table") -> DataFrame:
    """Read a parquet table; a missing path is an error that says what is missing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{what} not found: {path}") from error
        raise


def load_feature_store(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, "feature store")


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, "labels")


def load_splits(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, "splits")


def with_timestamps(df: DataFrame, name: str = TS) -> DataFrame:
    """Make a text column a UTC timestamp, null where it cannot be read as one."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return df.withColumn(name, F.try_to_timestamp(F.col(name)))
    return df


def without_banned(events: DataFrame, banned: Sequence[str] = BANNED_EVENTS,
                   keep_null: bool = True) -> DataFrame:
    """Drop the banned events.

    ``keep_null`` says whether rows without an event name stay (as in the labelled
    feature path) or go (as SQL's ``NOT IN`` has it).
    """
    if keep_null:
        return events.where(~is_known_in(F.col(EVENT), banned))
    return events.where(~F.col(EVENT).isin(list(banned)))


def clean_raw(events: DataFrame, drop_banned: bool = True) -> DataFrame:
    """Events with a usable timestamp and, unless asked otherwise, no banned name."""
    events = with_timestamps(events).where(F.col(TS).isNotNull())
    return without_banned(events) if drop_banned else events


def load_raw_events(spark: SparkSession, path: str, drop_banned: bool = True,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """The event log from parquet, cleaned; ``columns`` limits the scan."""
    events = read_table(spark, path, "raw events")
    if columns is not None:
        events = events.select(*[column(c) for c in columns])
    return clean_raw(events, drop_banned)


def drop_audit(events: DataFrame, banned: Sequence[str] = BANNED_EVENTS) -> DataFrame:
    """Rows lost per banned event, with the total lost, its share and what remains."""
    timed = with_timestamps(events).where(F.col(TS).isNotNull())
    # The flag is an aggregate, so that rows and totals read the same counts.
    counts = timed.groupBy(EVENT).agg(
        F.count(F.lit(1)).alias("n_dropped"),
        F.max(flag(is_known_in(F.col(EVENT), banned))).alias("_banned"),
    )
    totals = counts.agg(
        F.sum("n_dropped").alias("_all"),
        F.sum(F.col("n_dropped") * F.col("_banned")).alias("total_dropped"),
    )
    return (
        counts.where("_banned = 1")
        .crossJoin(F.broadcast(totals))
        .select(
            EVENT, "n_dropped", "total_dropped",
            share_pct(F.col("total_dropped"), F.col("_all"), 2).alias("pct_dropped"),
            (F.col("_all") - F.col("total_dropped")).alias("remaining"),
        )
    )


def session_of(events: DataFrame) -> Column:
    """The session key of an event, for each layout the log may have.

    A flat column, a struct or map column ``properties``, or ``properties`` as JSON
    text; null where there is none.
    """
    for name in SESSION_COLUMNS:
        if name in events.columns:
            return column(name).cast("string")
    if "properties" in events.columns:
        kind = events.schema["properties"].dataType
        if isinstance(kind, T.StringType):
            return F.get_json_object("properties", f"$.{SESSION_KEY}")
        if isinstance(kind, T.MapType) or (
            isinstance(kind, T.StructType) and SESSION_KEY in kind.fieldNames()
        ):
            return F.col("properties").getItem(SESSION_KEY).cast("string")
    return F.lit(None).cast("string")

