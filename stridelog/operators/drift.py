"""How scores move from week to week, from a history kept by day."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelog.functions.columns import safe_ratio
from stridelog.functions.ordered import running_totals

ALERT_SHIFT = 0.20
WEEK = 7


def record_scores(scores: DataFrame, path: str, day: dt.date, score: str = "p") -> None:
    """Keep a day's scores; doing a day again replaces that day and no other."""
    scores.select(F.col(score).cast("double").alias("p"), F.lit(day).alias("day")).write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def score_history(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema("p DOUBLE, day DATE").parquet(path)
    except AnalysisException as missing:
        raise ValueError(f"there is no score history at {path}") from missing


def score_drift(history: DataFrame, days: int = WEEK, alert: float = ALERT_SHIFT) -> DataFrame:
    """Every day of ``history`` (``p``, ``day``) that has scores ``days`` days before, next to those.

    ``mean_shift`` is the change of the mean as a share of the former one, ``ks`` the largest
    distance between the two distribution functions, and ``drifted`` whether the shift exceeds
    ``alert`` either way. Null scores are left out.

    Scores are counted per value before anything is ordered, and ordered in cells of equal size, so
    no day has to pass through one task.
    """
    scores = history.where("p IS NOT NULL AND day IS NOT NULL")
    known = scores.select("day").distinct()
    pairs = known.join(known.select(F.date_add("day", days).alias("day")), "day")
    counts = scores.groupBy("day", "p").agg(F.count(F.lit(1)).alias("n"))
    sides = counts.select("day", "p", F.col("n").alias("now"), F.lit(0).cast("long").alias("then"))
    sides = sides.unionByName(counts.select(
        F.date_add("day", days).alias("day"), "p", F.lit(0).cast("long").alias("now"),
        F.col("n").alias("then")))
    values = sides.join(pairs, "day").groupBy("day", "p").agg(
        F.sum("now").alias("now"), F.sum("then").alias("then"))
    n_now, n_then = F.sum("now"), F.sum("then")
    totals = values.groupBy("day").agg(
        n_now.alias("n_scores"), n_then.alias("n_before"),
        (F.sum(F.col("p") * F.col("now")) / n_now).alias("mean_score"),
        (F.sum(F.col("p") * F.col("then")) / n_then).alias("mean_before"))
    curve = running_totals(values, ["day"], "p", ["now", "then"]).join(totals, "day")
    apart = F.abs(F.col("cum_now") / F.col("n_scores") - F.col("cum_then") / F.col("n_before"))
    ks = curve.groupBy("day").agg(F.max(apart).alias("ks"))
    shift = safe_ratio(F.col("mean_score") - F.col("mean_before"), F.col("mean_before"))
    return totals.join(ks, "day").withColumn("mean_shift", shift).select(
        "day", "n_scores", "n_before", "mean_score", "mean_before", "mean_shift", "ks",
        F.coalesce(F.abs("mean_shift") > alert, F.lit(False)).alias("drifted"))
