"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stridelog.catalog import (
    event_queries, funnel_queries, live_queries, score_queries, user_queries,
)
from stridelog.catalog.query import Query
from stridelog.config import FEATURES, LABEL, SEGMENT, USER
from stridelog.catalog.testdata import segment_table

QUERIES: dict[str, Query] = {
    **event_queries.QUERIES, **user_queries.QUERIES,
    **funnel_queries.QUERIES, **score_queries.QUERIES, **live_queries.QUERIES,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_table(spark, sf_dir).select(USER, LABEL, *FEATURES, SEGMENT)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query.run for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: query.sql for name, query in QUERIES.items() if query.sql is not None}
