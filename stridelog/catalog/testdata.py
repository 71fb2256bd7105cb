"""The event log and the tables derived from it, as the registered queries see them.

The test tables hold one stream of five event types. The view below gives its events
product-like names, so that users differ in what they do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelog.config import LABEL, USER
from stridelog.functions.columns import flag
from stridelog.operators import features, labels, segments
from stridelog.session import configure, written_once

# One row per event, in the SQL both engines share; {STR} is the engine's text type.
EVENT_NAME = """
CASE
  WHEN c = 0 AND day(ts) >= 15 THEN 'addon_credits_used'
  WHEN c = 7 AND event_type = 'signup' AND k >= 40 THEN '$ai_generation'
  WHEN c = 7 AND event_type = 'click' AND k < 25 THEN '$ai_generation'
  WHEN c = 7 AND event_type = 'click' AND k < 55 THEN 'run_block'
  WHEN c = 7 AND event_type = 'click' AND k < 80 THEN 'agent_new_chat'
  WHEN c = 7 AND event_type = 'click' THEN 'agent_tool_call_create_block_tool'
  WHEN event_type = 'signup' AND k < 20 THEN 'new_user_created'
  WHEN event_type = 'signup' AND k < 60 THEN 'sign_in'
  WHEN event_type = 'signup' THEN '$identify'
  WHEN event_type = 'error' AND k < 60 THEN '$exception'
  WHEN event_type = 'error' AND k < 80 THEN 'credits_below_3'
  WHEN event_type = 'error' THEN '$web_vitals'
  WHEN event_type = 'purchase' AND k < 3 THEN 'subscription_upgraded'
  WHEN event_type = 'purchase' AND k = 3 THEN 'promo_code_redeemed'
  WHEN event_type = 'purchase' AND k < 6 THEN 'credits_exceeded'
  WHEN event_type = 'purchase' THEN 'credits_used'
  WHEN event_type = 'click' AND c IN (3, 4, 5, 6) AND k < 40 THEN '$ai_generation'
  WHEN event_type = 'click' AND c IN (4, 5, 6) AND k < 60 THEN 'run_block'
  WHEN event_type = 'click' AND c IN (5, 6) AND k < 80 THEN 'agent_new_chat'
  WHEN event_type = 'click' AND c = 6 THEN 'agent_tool_call_create_block_tool'
  WHEN event_type = 'click' THEN '$pageview'
  WHEN event_type = 'view' AND c = 7 THEN 'feature_' || CAST(k AS {STR})
  WHEN event_type = 'view' AND c IN (2, 5) AND k < 50 THEN 'agent_new_chat'
  WHEN event_type = 'view' AND k < 50 THEN '$pageview'
  WHEN event_type = 'view' AND k < 75 THEN '$pageleave'
  ELSE 'skip_onboarding_form'
END
"""
CANVAS = "CASE WHEN k % 5 = 0 THEN NULL ELSE 'canvas_' || CAST(k % 7 AS {STR}) END"
# The user of the raw table is cut into several persons, so that every row is used and persons
# differ in how much they did and when.
PERSON = """
user_id * 100 + CASE
  WHEN c IN (0, 7) THEN 0
  ELSE CASE WHEN day(ts) < 12 + (user_id * 7) % 19 THEN 0 ELSE 1 END
    + CASE WHEN c = 1 THEN 2 * (k % 16) WHEN c = 2 THEN 2 * (k % 3) ELSE 0 END
END
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as a view of the raw test table."""
    raw = table(configure(spark), sf_dir, "events").selectExpr(
        "event_id", "user_id", "ts", "event_type",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k", "user_id % 8 AS c", "props",
    )
    return raw.selectExpr(
        "event_id", f"CAST({PERSON} AS STRING) AS person_id", "ts AS timestamp",
        EVENT_NAME.format(STR="STRING") + " AS event",
        CANVAS.format(STR="STRING") + " AS canvas_id",
        "props",
    )


_stages: dict[tuple[str, str, str], DataFrame] = {}


def stage(spark: SparkSession, sf_dir: str, name: str,
          build: Callable[[], DataFrame]) -> DataFrame:
    """A table that later stages start from, written once per session and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stages:
        _stages[key] = written_once(build(), name)
    return _stages[key]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log: event_id, person_id, timestamp, event, canvas_id, props.

    Written once, so that the names are not worked out again by every scan of every query.
    """
    return stage(spark, sf_dir, "events", lambda: canonical_events(spark, sf_dir))


def label_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir)
    return stage(spark, sf_dir, "labels", lambda: labels.build_labels(log))


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = label_table(spark, sf_dir)
    return stage(spark, sf_dir, "splits", lambda: labels.assign_splits(known))


def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, known = events(spark, sf_dir), label_table(spark, sf_dir)
    return stage(spark, sf_dir, "feature_store", lambda: features.build_feature_store(
        log, known, check_cutoffs=False))


def segment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.with_segment(feature_store(spark, sf_dir))


# A score without a model, the same in both engines; it has ties and spans all tiers.
SCORE = "round(((CAST(person_id AS INT) % 9973 * 37 + 11) % 100 + 60 * y) / {SIXTEEN_TENTHS}, 4)"


def scored_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user with ``y`` (ever upgraded), the score ``p`` and a fold from 1 to 3."""
    history = labels.user_history(events(spark, sf_dir)).select(
        USER, F.col("upgraded").alias("y")
    )
    return history.select(
        USER, "y",
        F.expr(SCORE.format(SIXTEEN_TENTHS="160.0D")).alias("p"),
        F.expr("CAST(CAST(person_id AS INT) % 3 + 1 AS INT)").alias("fold"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_users(spark, sf_dir).select(USER, F.col("p").alias("upgrade_probability"))


def leaky_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature store with columns no honest store has, for the audits to find."""
    log = events(spark, sf_dir)
    raw = log.groupBy(USER).agg(
        F.count_if(F.col("event") == "addon_credits_used").alias("addon_credit_uses"),
        F.count_if(F.col("event") == "promo_code_redeemed").alias("Promo_Code_uses"),
        F.max(flag(F.col("event") == "subscription_upgraded")).alias("post_conversion_flag"),
        F.max("timestamp").alias("timestamp"),
    )
    return feature_store(spark, sf_dir).join(raw, USER).withColumn(
        "upgrade_total", F.col("total_events") * 0 + 3 * F.col(LABEL)
    )
