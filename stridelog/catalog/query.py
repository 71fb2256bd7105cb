"""How a registered query is put together."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stridelog.catalog import oracle
from stridelog.functions.columns import rounded
from stridelog.session import configure

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


class Collection(dict[str, Query]):
    """Queries by name; ``add`` registers one."""

    def add(self, name: str, run: Run, sql: str | None = None,
            doubles: Sequence[str] = ()) -> None:
        """``doubles`` are compared to nine decimals, as the engines may add in another order."""
        def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(run(configure(spark), sf_dir), doubles)

        if name in self:
            raise ValueError(f"query {name} is registered twice")
        self[name] = Query(complete, None if sql is None else oracle.sql(sql, doubles))
