"""Scoring on arrival: users of new events get a fresh score with every batch of a stream.

Every batch writes what its events add to the feature state (see ``operators.feature_state``) and
the scores of its users, each under the number of the batch. A batch that is done again after a
failure overwrites its own tables, so nothing counts twice. The state is the last compacted table
and the batches since; only the rows of the batch's users are read from it into the features.

A stream's own part, here the dropping of redelivered events, is dealt to a fixed number of tasks,
each with files of its own in every batch. So there are only some for each core, and what a batch
does with its events is planned as in a batch job instead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stridelog.config import TS, USER
from stridelog.operators import propensity
from stridelog.operators.feature_state import counted, merged, state_features
from stridelog.sources.sinks import write_parquet

# Batches between two compacted states.
COMPACT = 20
LATENESS = "2 days"
# Tasks of the stream's own part for each core, and how many it may have whatever the cores. The
# checkpoint keeps the number that its first run had.
CORE_TASKS, LEAST_TASKS = 4, 32
ADAPTIVE, PARTITIONS = "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Some settings of a session, put back at the end."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@dataclass(frozen=True)
class ArrivalScoring:
    """A fitted model and the folder that keeps checkpoint, state and scores."""

    model: propensity.PropensityModel
    folder: str
    compact: int = COMPACT

    def start(self, events: DataFrame, event_id: str | None = "event_id",
              lateness: str = LATENESS) -> StreamingQuery:
        """Score all events that the stream has now, from where the last run ended, then stop.

        Events with an id that was seen within ``lateness`` are redelivered ones and are dropped.
        """
        if event_id is not None:
            kind = events.schema[TS].dataType
            timed = events.withColumn(TS, F.col(TS).cast("timestamp"))
            events = timed.withWatermark(TS, lateness).dropDuplicatesWithinWatermark(
                [event_id]).withColumn(TS, F.col(TS).cast(kind))
        spark = events.sparkSession
        outside = {name: spark.conf.get(name) for name in (ADAPTIVE, PARTITIONS)}
        tasks = min(int(outside[PARTITIONS]),
                    max(CORE_TASKS * spark.sparkContext.defaultParallelism, LEAST_TASKS))

        def process(events: DataFrame, batch: int) -> None:
            # The stream's part of the batch is planned by now, and again with the next batch.
            with settings(events.sparkSession, outside):
                self.process(events, batch)

        with settings(spark, {PARTITIONS: str(tasks)}):  # the stream takes a copy of the session
            return (events.writeStream.foreachBatch(process)
                    .option("checkpointLocation", f"{self.folder}/checkpoint")
                    .trigger(availableNow=True).start())

    def _path(self, name: str, batch: int) -> str:
        return f"{self.folder}/{name}/batch={batch}"

    def process(self, events: DataFrame, batch: int) -> None:
        added = write_parquet(counted(events), self._path("added", batch))
        days = added.where("kind = 'day'")
        if days.isEmpty():  # no event of a user
            return
        state = self._state(added, batch)
        touched = state.join(days.select(USER).distinct(), USER, "left_semi")
        # Late events may come in a batch whose own days are past.
        last = touched.where("kind = 'day'").agg(F.max("key").alias("day")).first()["day"]
        found = state_features(merged(touched), dt.date.fromisoformat(last))
        scores = propensity.predict_batch(self.model, found.withColumnRenamed("_cutoff", "as_of"))
        write_parquet(scores, self._path("scores", batch))

    def _state(self, added: DataFrame, batch: int) -> DataFrame:
        """The state with this batch, as rows still to be merged."""
        spark, base = added.sparkSession, batch - batch % self.compact

        def read(name: str, batches: range) -> list[DataFrame]:
            paths = [self._path(name, i) for i in batches]
            return [spark.read.schema(added.schema).parquet(*paths)] if paths else []

        if base and base == batch:
            older = range(base - self.compact, base - self.compact + 1) if base > self.compact else ()
            parts = read("state", older) + read("added", range(base - self.compact, base))
            write_parquet(merged(*parts), self._path("state", base))
        parts = read("state", [base] if base else []) + read("added", range(base, batch + 1))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def scores(self, spark) -> DataFrame:
        """All scores so far with their batch."""
        return spark.read.parquet(f"{self.folder}/scores")

    def latest(self, spark) -> DataFrame:
        """The last score of every user."""
        rows = self.scores(spark)
        whole = F.struct(*rows.columns)
        return rows.groupBy(USER).agg(F.max_by(whole, F.col("batch")).alias("_row")).select("_row.*")
