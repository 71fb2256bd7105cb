"""Queries over daily states and scoring on arrival."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelog.catalog.event_queries import FEATURE_DOUBLES
from stridelog.catalog.oracle import BANNED, CORE
from stridelog.catalog.query import Collection
from stridelog.catalog.score_queries import labelled_rows
from stridelog.catalog.testdata import events, scored_users
from stridelog.config import CUTOFF, EVENT, FEATURES, TS, USER
from stridelog.functions.columns import day_of
from stridelog.operators import drift, propensity, sequences
from stridelog.operators.feature_state import DailyState, state_features
from stridelog.operators.features import build_feature_store
from stridelog.session import new_path, written_once
from stridelog.streaming.scoring import ArrivalScoring

QUERIES = Collection()
add = QUERIES.add


def _last_day(log: DataFrame) -> dt.date:
    return log.agg(F.max(day_of(TS)).alias("day")).first()["day"]


def advanced_state(s: SparkSession, d: str, days: int = 2) -> tuple[DailyState, dt.date]:
    """The log's state up to some days before its end, then advanced day by day."""
    log = events(s, d)
    last, daily = _last_day(log), DailyState(s, new_path(s, "daily-state"))
    daily.start(log, last - dt.timedelta(days=days))
    for i in reversed(range(days)):
        daily.advance(log, last - dt.timedelta(days=i))
    return daily, last


# The features of all users at the end of the last day, from the log as it is.
AS_OF_SQL = f"""
last AS (SELECT MAX(CAST(timestamp AS DATE)) AS day FROM ev),
seen AS (
  SELECT ev.*, CAST(timestamp AS DATE) AS d, day,
    date_diff('microsecond', timestamp, CAST(day AS TIMESTAMP) + INTERVAL 1 DAY) - 1 AS us
  FROM ev, last WHERE event IS NULL OR event NOT IN {BANNED}
),
tally AS (
  SELECT person_id, day, COUNT(event) AS total_events,
    COUNT(DISTINCT event) AS unique_event_types, COUNT(DISTINCT canvas_id) AS total_sessions,
    COUNT(DISTINCT d) AS active_days,
    COUNT(*) FILTER (WHERE d > day - 7) AS events_last_7d,
    COUNT(*) FILTER (WHERE d > day - 14) AS events_last_14d,
    COUNT(*) FILTER (WHERE d > day - 30) AS events_last_30d,
    MIN(us) / 86400000000.0 AS days_since_last_event,
    MAX(us) / 86400000000.0 AS days_since_first_event,
    COALESCE(MAX(us) FILTER (WHERE event = 'new_user_created'), MAX(us)) / 86400000000.0
      AS account_age_days,
    COUNT(DISTINCT event) FILTER (WHERE event IN {CORE}) AS feature_breadth,
    COUNT(*) FILTER (WHERE event = '$ai_generation') AS ai_generation_count,
    COUNT(*) FILTER (WHERE event = 'run_block') AS run_block_count,
    COUNT(*) FILTER (WHERE event = 'agent_new_chat') AS agent_chat_count,
    COUNT(*) FILTER (WHERE event = '$exception') AS friction_events, MAX(d) AS last_seen
  FROM seen GROUP BY person_id, day
),
as_of AS (
  SELECT *, COALESCE(CAST(total_events AS DOUBLE) / NULLIF(total_sessions, 0), 0.0)
      AS avg_events_per_session,
    events_last_14d - events_last_7d AS events_last_14_to_7d,
    ((2 * events_last_7d - events_last_14d) / (events_last_14d - events_last_7d + 1.0))::DOUBLE
      AS wow_growth,
    CAST((2 * events_last_7d - events_last_14d) / (events_last_14d - events_last_7d + 1.0) > 0.20
      AS INTEGER) AS is_accelerating,
    CAST(feature_breadth >= 2 AS INTEGER) AS hit_aha_moment,
    COALESCE(CAST(friction_events AS DOUBLE) / NULLIF(total_events, 0), 0.0) AS friction_ratio,
    0 AS is_social_user
  FROM tally
)"""
COLUMNS = ", ".join(FEATURES)


def _all_features(s, d):
    daily, last = advanced_state(s, d)
    return state_features(daily.state(last), last).select(USER, *FEATURES)


def _active_features(s, d):
    daily, last = advanced_state(s, d)
    return daily.active_features(last).select(USER, *FEATURES)


add("x08_state_features", _all_features,
    f"WITH {AS_OF_SQL.lstrip()} SELECT person_id, {COLUMNS} FROM as_of", FEATURE_DOUBLES)
add("x08_active_yesterday", _active_features,
    f"WITH {AS_OF_SQL.lstrip()} SELECT person_id, {COLUMNS} FROM as_of WHERE last_seen = day",
    FEATURE_DOUBLES)


def _on_arrival(s: SparkSession, d: str) -> DataFrame:
    """The log arrives in three parts; every user's last score next to the one of the batch form.

    Each part is a run of its own that takes up the checkpoint of the run before.
    """
    log = events(s, d).select("event_id", USER, TS, EVENT, "canvas_id")
    rows = labelled_rows(s, d)
    model = propensity.fit(rows, propensity.get_feature_cols(rows), trees=propensity.ROUND_TREES)
    folder, arriving = new_path(s, "arrivals"), new_path(s, "arriving")
    scoring, last = ArrivalScoring(model, folder), _last_day(log)
    stops = [last - dt.timedelta(days=14), last - dt.timedelta(days=7), last]
    for first, stop in zip([None, *stops], stops):
        part = log.where(day_of(TS) <= F.lit(stop))
        part = part if first is None else part.where(day_of(TS) > F.lit(first))
        part.write.mode("append").parquet(arriving)
        stream = s.readStream.schema(log.schema).parquet(arriving)
        scoring.start(stream).awaitTermination()
    latest = written_once(scoring.latest(s).select(
        USER, "total_events", F.col("as_of").alias(CUTOFF), "upgrade_probability",
        "upgrade_risk_tier", "recommended_action"), "latest-scores")
    batch = propensity.predict_batch(
        model, build_feature_store(log, latest.select(USER, CUTOFF), check_cutoffs=False))
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (
        "total_events", "upgrade_probability", "upgrade_risk_tier", "recommended_action")]
    return latest.alias("a").join(batch.alias("b"), USER).select(
        USER, F.col("a.total_events"), day_of(f"a.{CUTOFF}").alias("as_of"),
        (same[0] & same[1] & same[2] & same[3]).alias("as_in_batch"))


add("x08_scoring_on_arrival", _on_arrival, f"""
SELECT person_id, COUNT(event) AS total_events,
  CASE WHEN MAX(CAST(timestamp AS DATE)) <= MAX(z) - 14 THEN MAX(z) - 14
       WHEN MAX(CAST(timestamp AS DATE)) <= MAX(z) - 7 THEN MAX(z) - 7 ELSE MAX(z) END AS as_of,
  true AS as_in_batch
FROM ev, (SELECT MAX(CAST(timestamp AS DATE)) AS z FROM ev)
WHERE event IS NULL OR event NOT IN {BANNED} GROUP BY person_id""")


# Order: labels on daily anchors, n-grams, sessions by inactivity

add("x02_horizon_labels", lambda s, d: sequences.horizon_labels(events(s, d)), f"""
SELECT a.person_id, anchor_day, n_events,
  (SELECT MIN(timestamp) FROM ev u WHERE u.person_id = a.person_id
     AND event = 'subscription_upgraded' AND CAST(timestamp AS DATE) > anchor_day)
    AS next_upgrade_ts,
  CAST(CASE WHEN EXISTS (SELECT 1 FROM ev u WHERE u.person_id = a.person_id
         AND event = 'subscription_upgraded' AND CAST(timestamp AS DATE) > anchor_day
         AND CAST(timestamp AS DATE) <= anchor_day + 7) THEN 1
       WHEN anchor_day + 7 <= (SELECT MAX(CAST(timestamp AS DATE)) FROM ev) THEN 0 END
    AS INTEGER) AS will_upgrade_in_7d
FROM (SELECT person_id, CAST(timestamp AS DATE) AS anchor_day, COUNT(*) AS n_events FROM ev
      WHERE event IS NULL OR event NOT IN {BANNED} GROUP BY ALL) a
WHERE NOT EXISTS (SELECT 1 FROM ev u WHERE u.person_id = a.person_id
  AND event = 'subscription_upgraded' AND CAST(timestamp AS DATE) <= anchor_day)""")


def _ngram_sql(n: int) -> str:
    leads = ", ".join(f"lead(event, {i}) OVER w AS e{i}" for i in range(1, n))
    names = " || ' > ' || ".join(["event", *[f"e{i}" for i in range(1, n)]])
    return f"""
SELECT {names} AS ngram, COUNT(*) AS n_times, COUNT(DISTINCT person_id) AS n_users
FROM (SELECT person_id, event, {leads} FROM ev WHERE event NOT IN {BANNED}
      WINDOW w AS (PARTITION BY person_id ORDER BY timestamp, event_id))
WHERE e{n - 1} IS NOT NULL GROUP BY 1"""


def _ngrams(n: int):
    return lambda s, d: sequences.event_ngrams(events(s, d), n).withColumn(
        "ngram", F.array_join("ngram", " > "))


add("x05_event_bigrams", _ngrams(2), _ngram_sql(2))
add("x05_event_trigrams", _ngrams(3), _ngram_sql(3))

add("x04_session_gaps", lambda s, d: sequences.session_gaps(events(s, d)), f"""
SELECT person_id, COUNT(*) FILTER (WHERE gap > 0.5) + 1 AS n_sessions,
  quantile_cont(gap, 0.5) FILTER (WHERE gap > 0.5) AS median_gap_hours
FROM (SELECT person_id, date_diff('microsecond', timestamp, lead(timestamp) OVER (
        PARTITION BY person_id ORDER BY timestamp)) / 3600000000.0 AS gap
      FROM ev WHERE event IS NULL OR event NOT IN {BANNED})
GROUP BY person_id""", ["median_gap_hours"])

add("x03_activity_shape", lambda s, d: sequences.activity_shape(events(s, d)), f"""
WITH used AS (SELECT person_id, event, timestamp, CAST(timestamp AS DATE) AS d FROM ev
              WHERE event IS NULL OR event NOT IN {BANNED}),
ends AS (SELECT MAX(d) AS z FROM used),
firsts AS (SELECT person_id, MIN(d) AS a, MIN(timestamp) AS t, COUNT(*) AS total_events,
    COUNT(DISTINCT d) AS active_days, COUNT(DISTINCT event) AS types,
    MIN(timestamp) FILTER (WHERE event = '$ai_generation') AS ai FROM used GROUP BY person_id),
days AS (SELECT person_id, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d
         FROM firsts, ends),
filled AS (SELECT days.person_id, days.d, COUNT(used.timestamp) AS n
           FROM days LEFT JOIN used USING (person_id, d) GROUP BY ALL),
weekly AS (SELECT person_id, (d - a) // 7 AS w, SUM(n) AS n
           FROM filled JOIN firsts USING (person_id) GROUP BY ALL),
trend AS (SELECT person_id, CASE WHEN COUNT(*) > 1 THEN regr_slope(n, w) END AS slope
          FROM weekly GROUP BY person_id)
SELECT person_id, total_events, active_days, COUNT(*) AS calendar_days,
  stddev_pop(n) / AVG(n) AS activity_consistency, MAX(slope) AS engagement_trend,
  types::DOUBLE / total_events AS exploration_rate,
  date_diff('microsecond', t, ai) / 86400000000.0 AS days_to_first_ai
FROM filled JOIN firsts USING (person_id) JOIN trend USING (person_id)
GROUP BY person_id, total_events, active_days, types, t, ai""",
    ["activity_consistency", "engagement_trend", "exploration_rate", "days_to_first_ai"])


def _drift(s: SparkSession, d: str) -> DataFrame:
    """Scores of the users active in the week up to a day, for three days a week apart."""
    log, path = events(s, d), new_path(s, "score-history")
    scores, last = scored_users(s, d).select(USER, "p"), _last_day(log)
    for weeks in (2, 1, 0, 0):  # a day done again changes nothing
        day = last - dt.timedelta(days=7 * weeks)
        active = log.where((day_of(TS) > F.lit(day - dt.timedelta(days=7)))
                           & (day_of(TS) <= F.lit(day))).select(USER).distinct()
        drift.record_scores(scores.join(active, USER), path, day)
    return drift.score_drift(drift.score_history(s, path))


add("x07_score_drift", _drift, """
WITH z AS (SELECT MAX(CAST(timestamp AS DATE)) AS last FROM ev),
hist AS (SELECT DISTINCT person_id, p, last - 7 * back AS day
  FROM ev JOIN scored USING (person_id), z, (SELECT unnest([0, 1, 2]) AS back)
  WHERE CAST(timestamp AS DATE) > last - 7 * back - 7 AND CAST(timestamp AS DATE) <= last - 7 * back),
pairs AS (SELECT DISTINCT a.day FROM hist a JOIN hist b ON b.day = a.day - 7),
vals AS (SELECT DISTINCT pairs.day, p FROM pairs JOIN hist h ON h.day IN (pairs.day, pairs.day - 7)),
means AS (SELECT day, (SELECT COUNT(*) FROM hist h WHERE h.day = q.day) AS n_scores,
    (SELECT COUNT(*) FROM hist h WHERE h.day = q.day - 7) AS n_before,
    (SELECT AVG(p) FROM hist h WHERE h.day = q.day) AS mean_score,
    (SELECT AVG(p) FROM hist h WHERE h.day = q.day - 7) AS mean_before FROM pairs q),
dist AS (SELECT v.day, MAX(abs(
    (SELECT COUNT(*) FROM hist h WHERE h.day = v.day AND h.p >= v.p)::DOUBLE / n_scores
    - (SELECT COUNT(*) FROM hist h WHERE h.day = v.day - 7 AND h.p >= v.p)::DOUBLE / n_before))
    AS ks FROM vals v JOIN means m ON m.day = v.day GROUP BY v.day)
SELECT day, n_scores, n_before, mean_score, mean_before,
  (mean_score - mean_before) / mean_before AS mean_shift, ks,
  abs((mean_score - mean_before) / mean_before) > 0.2 AS drifted
FROM means JOIN dist USING (day)""", ["mean_score", "mean_before", "mean_shift", "ks"])
