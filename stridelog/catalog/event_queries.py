"""Queries over the raw event log: sources, sinks, checks and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridelog.catalog.oracle import BANNED
from stridelog.catalog.query import Collection
from stridelog.catalog.testdata import (
    events, feature_store, label_table, scored_users, segment_table, split_table,
)
from stridelog.config import EVENT, PREDICTION_RANGES, TS, USER
from stridelog.operators import metrics, profile, report
from stridelog.session import new_path
from stridelog.sources import events as source
from stridelog.sources import sinks, validation

QUERIES = Collection()
add = QUERIES.add

LOG = [USER, TS, EVENT]
OOF_SCHEMA = "person_id STRING, fold INT, y_true INT, y_pred_proba DOUBLE"
FOLD_SCHEMA = "fold INT, n_val BIGINT, n_pos BIGINT, auc DOUBLE, pr_auc DOUBLE"


# Sources and sinks

add("s01_event_scan",
    lambda s, d: events(s, d).select("event_id", *LOG, "canvas_id"),
    "SELECT event_id, person_id, timestamp, event, canvas_id FROM ev")

add("s02_pruned_scan",
    lambda s, d: events(s, d).select(*LOG),
    "SELECT person_id, timestamp, event FROM ev")


def _raw_events(s, d):
    text = events(s, d).withColumn(TS, F.col(TS).cast("string"))
    return source.clean_raw(text).select("event_id", USER, F.col(TS).cast("timestamp_ntz").alias(TS),
                                         EVENT)


add("s03_load_raw_events", _raw_events, "SELECT event_id, person_id, timestamp, event FROM kept")

add("s04_drop_audit",
    lambda s, d: source.drop_audit(events(s, d)),
    f"""
SELECT event, COUNT(*) AS n_dropped,
  (SELECT COUNT(*) FROM ev WHERE event IN {BANNED}) AS total_dropped,
  round(100.0 * (SELECT COUNT(*) FROM ev WHERE event IN {BANNED})
    / (SELECT COUNT(*) FROM ev)::DOUBLE, 2) AS pct_dropped,
  (SELECT COUNT(*) FROM kept) AS remaining
FROM ev WHERE event IN {BANNED} GROUP BY event""")


def _load_labels(s, d):
    path = new_path(s, "labels")
    sinks.write_parquet(label_table(s, d), path)
    return source.load_labels(s, path)


add("s05_load_labels", _load_labels, "SELECT * FROM lab")


def _load_splits(s, d):
    path = new_path(s, "splits")
    sinks.write_parquet(split_table(s, d), path)
    return source.load_splits(s, path)


add("s05_load_splits", _load_splits, "SELECT * FROM spl")


def _sql_to_parquet(s, d):
    events(s, d).createOrReplaceTempView("product_events")
    return sinks.run_sql_string(s, """
        SELECT person_id, COUNT(*) AS n_events, MIN(timestamp) AS first_ts,
               MAX(timestamp) AS last_ts
        FROM product_events GROUP BY person_id""", output_parquet=new_path(s, "sql-result"))


add("s06_sql_to_parquet", _sql_to_parquet, """
SELECT person_id, COUNT(*) AS n_events, MIN(timestamp) AS first_ts, MAX(timestamp) AS last_ts
FROM ev GROUP BY person_id""")

FEATURE_DOUBLES = ("avg_events_per_session", "wow_growth", "days_since_last_event",
                   "days_since_first_event", "account_age_days", "friction_ratio")

add("s07_feature_store_parquet",
    lambda s, d: sinks.write_parquet(feature_store(s, d), new_path(s, "feature-store")),
    "SELECT * FROM fs", FEATURE_DOUBLES)


def _oof_csv(s, d):
    path = new_path(s, "oof-csv")
    sinks.write_csv(scored_users(s, d).select(
        USER, "fold", F.col("y").alias("y_true"), F.col("p").alias("y_pred_proba")), path)
    return sinks.read_csv(s, path, OOF_SCHEMA)


add("s08_oof_predictions_csv", _oof_csv,
    "SELECT person_id, fold, y AS y_true, p AS y_pred_proba FROM scored")


def _report_json(s, d):
    path = new_path(s, "report-json")
    result = report.generate_full_report(segment_table(s, d))
    sinks.write_json(result, path)
    back = sinks.read_json(s, path, result.schema)
    return back.select("funnel_segment", "user_count", "pct_of_total", "mean_upgrade_prob",
                       "actual_conversion_rate", "upgrade_likelihood",
                       F.size("top_diagnostic_features").alias("n_top_features"))


add("s09_report_json", _report_json, """
SELECT funnel_segment, COUNT(*) AS user_count,
  round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM seg)::DOUBLE, 2) AS pct_of_total,
  CAST(NULL AS DOUBLE) AS mean_upgrade_prob, AVG(will_upgrade_in_7d) AS actual_conversion_rate,
  CASE WHEN funnel_segment IN ('Power User', 'AI Builder') THEN 'High'
       WHEN funnel_segment IN ('Collaborator', 'Explorer') THEN 'Medium'
       WHEN funnel_segment = 'Unclassified' THEN 'Unknown' ELSE 'Low' END AS upgrade_likelihood,
  3 AS n_top_features
FROM seg GROUP BY funnel_segment""", ["actual_conversion_rate"])


def _fold_csv(s, d):
    path = new_path(s, "fold-csv")
    sinks.write_csv(metrics.fold_scores(scored_users(s, d)), path)
    none = sinks.read_csv(s, new_path(s, "no-such-table"), FOLD_SCHEMA)
    return sinks.read_csv(s, path, FOLD_SCHEMA).unionByName(none)


FOLD_SQL = """
SELECT f.fold, f.n_val, f.n_pos, round(a.auc, 4) AS auc, round(b.pr_auc, 4) AS pr_auc
FROM (SELECT fold, COUNT(*) AS n_val, CAST(SUM(y) AS BIGINT) AS n_pos FROM scored GROUP BY fold) f
JOIN (
  SELECT x.fold, AVG(CASE WHEN x.p > z.p THEN 1.0 WHEN x.p = z.p THEN 0.5 ELSE 0.0 END) AS auc
  FROM scored x JOIN scored z ON x.fold = z.fold AND x.y = 1 AND z.y = 0 GROUP BY x.fold
) a ON a.fold = f.fold
JOIN (
  SELECT fold, AVG(precision_at) AS pr_auc FROM (
    SELECT x.fold, x.person_id,
      SUM(z.y)::DOUBLE / COUNT(*) AS precision_at
    FROM scored x JOIN scored z ON x.fold = z.fold AND z.p >= x.p AND x.y = 1
    GROUP BY x.fold, x.person_id) GROUP BY fold
) b ON b.fold = f.fold"""

add("s10_fold_scores_csv", _fold_csv, FOLD_SQL)

add("s11_required_columns",
    lambda s, d: validation.column_findings(
        events(s, d).withColumn("plan", F.lit(None).cast("string")), [*LOG, "plan", "country"]),
    """
SELECT 'person_id' AS "column", COUNT(*) AS n_rows, COUNT(person_id) AS n_values, 'ok' AS status
FROM ev
UNION ALL SELECT 'timestamp', COUNT(*), COUNT(timestamp), 'ok' FROM ev
UNION ALL SELECT 'event', COUNT(*), COUNT(event), 'ok' FROM ev
UNION ALL SELECT 'plan', COUNT(*), 0, 'all_null' FROM ev
UNION ALL SELECT 'country', COUNT(*), CAST(NULL AS BIGINT), 'missing' FROM ev""")

add("s12_label_domain",
    lambda s, d: validation.label_domain(label_table(s, d)),
    """
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE will_upgrade_in_7d IS NULL) AS n_null,
  COUNT(*) FILTER (WHERE will_upgrade_in_7d NOT IN (0, 1)) AS n_outside FROM lab""")


def _range_sql() -> str:
    parts = []
    for name, (low, high) in PREDICTION_RANGES.items():
        rules = [("required", f"{name} IS NULL")]
        if low is not None:
            rules.append(("min", f"{name} < {low}"))
        if high is not None:
            rules.append(("max", f"{name} > {high}"))
        parts += [
            f"SELECT '{name}' AS \"column\", '{rule}' AS rule, COUNT(*) FILTER (WHERE {test}) AS n_bad"
            " FROM shifted" for rule, test in rules
        ]
    shifted = ", ".join(f"{f} - 1 AS {f}" if f in SHIFTED else f for f in PREDICTION_RANGES)
    return f"WITH shifted AS (SELECT {shifted} FROM fs) " + " UNION ALL ".join(parts)


# Two columns are moved out of their range, so that the check has something to find.
SHIFTED = ("total_sessions", "friction_ratio")

add("s13_input_ranges",
    lambda s, d: validation.range_findings(
        feature_store(s, d).withColumns({c: F.col(c) - 1 for c in SHIFTED})),
    _range_sql())


# Profiles

add("p01_total_rows", lambda s, d: profile.total_rows(events(s, d)),
    "SELECT COUNT(*) AS total_rows FROM ev")

add("p02_distinct_users", lambda s, d: profile.distinct_users(events(s, d)),
    "SELECT COUNT(DISTINCT person_id) AS distinct_users FROM ev")

add("p03_distinct_event_types", lambda s, d: profile.distinct_event_types(events(s, d)),
    "SELECT COUNT(DISTINCT event) AS distinct_event_types FROM ev")

add("p04_time_range", lambda s, d: profile.time_range(events(s, d)), """
SELECT 'timestamp_min' AS metric, MIN(timestamp) AS value FROM ev
UNION ALL SELECT 'timestamp_max', MAX(timestamp) FROM ev""")

add("p05_users_with_upgrade",
    lambda s, d: profile.users_with_event(events(s, d), "subscription_upgraded"),
    "SELECT COUNT(DISTINCT person_id) AS users FROM ev WHERE event = 'subscription_upgraded'")

RATE_SQL = """round(100.0 * COUNT(DISTINCT CASE WHEN event = 'subscription_upgraded' THEN person_id END)
  / NULLIF(COUNT(DISTINCT person_id), 0)::DOUBLE, 2)"""

add("p06_positive_rate", lambda s, d: profile.positive_rate(events(s, d)),
    f"SELECT {RATE_SQL} AS positive_rate_pct FROM ev")

add("p07_null_counts", lambda s, d: profile.null_counts(events(s, d)), """
SELECT 'person_id' AS "column", COUNT(*) AS n_null FROM ev WHERE person_id IS NULL
UNION ALL SELECT 'event', COUNT(*) FROM ev WHERE event IS NULL
UNION ALL SELECT 'timestamp', COUNT(*) FROM ev WHERE timestamp IS NULL""")

TOP_SQL = """
SELECT row_number() OVER (ORDER BY cnt DESC, event) AS rank, event, cnt FROM (
  SELECT event, COUNT(*) AS cnt FROM ev GROUP BY event ORDER BY cnt DESC, event LIMIT 10)"""

add("p08_top_events", lambda s, d: profile.top_events(events(s, d)), TOP_SQL)

add("p09_users_with_promo",
    lambda s, d: profile.users_with_event(events(s, d), "promo_code_redeemed"),
    "SELECT COUNT(DISTINCT person_id) AS users FROM ev WHERE event = 'promo_code_redeemed'")

add("p10_full_profile", lambda s, d: profile.full_profile(events(s, d)), f"""
SELECT '01_total_rows' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM ev
UNION ALL SELECT '02_distinct_users', CAST(COUNT(DISTINCT person_id) AS VARCHAR) FROM ev
UNION ALL SELECT '03_distinct_event_types', CAST(COUNT(DISTINCT event) AS VARCHAR) FROM ev
UNION ALL SELECT '04_timestamp_min', CAST(MIN(timestamp) AS VARCHAR) FROM ev
UNION ALL SELECT '04_timestamp_max', CAST(MAX(timestamp) AS VARCHAR) FROM ev
UNION ALL SELECT '05_users_with_subscription_upgraded', CAST(COUNT(DISTINCT person_id) AS VARCHAR)
  FROM ev WHERE event = 'subscription_upgraded'
UNION ALL SELECT '06_positive_rate_pct', CAST({RATE_SQL} AS VARCHAR) FROM ev
UNION ALL SELECT '07_null_person_id', CAST(COUNT(*) AS VARCHAR) FROM ev WHERE person_id IS NULL
UNION ALL SELECT '07_null_event', CAST(COUNT(*) AS VARCHAR) FROM ev WHERE event IS NULL
UNION ALL SELECT '07_null_timestamp', CAST(COUNT(*) AS VARCHAR) FROM ev WHERE timestamp IS NULL
UNION ALL SELECT '08_top_event_' || rank, event || ' (' || cnt || ')' FROM ({TOP_SQL})
UNION ALL SELECT '09_users_promo_code_redeemed', CAST(COUNT(DISTINCT person_id) AS VARCHAR)
  FROM ev WHERE event = 'promo_code_redeemed'
ORDER BY metric""")

add("p11_value_frequency", lambda s, d: profile.value_frequency(events(s, d)), """
SELECT event, COUNT(*) AS cnt,
  round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM ev)::DOUBLE, 2) AS pct
FROM ev GROUP BY event ORDER BY cnt DESC, event LIMIT 30""")

EXPECTED = ("subscription_upgraded", "subscription upgraded", "redeem upgrade offer",
            "redeem_upgrade_offer")

add("p12_event_name_check", lambda s, d: profile.event_name_check(events(s, d), EXPECTED), f"""
SELECT name AS event, COUNT(ev.event) AS n_rows, COUNT(DISTINCT person_id) AS n_users,
  CASE WHEN COUNT(ev.event) > 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT unnest({list(EXPECTED)}) AS name) LEFT JOIN ev ON ev.event = name GROUP BY name""")

ALLOWED_CANVAS = tuple(f"canvas_{i}" for i in range(7))


def _properties(s, d):
    log = events(s, d).withColumn("k", F.get_json_object("props", "$.k"))
    return profile.property_scan(log, {"canvas_id": ALLOWED_CANVAS, "k": ("0", "1")})


add("p13_property_scan", _properties, """
SELECT 'canvas_id' AS property, canvas_id AS value, COUNT(*) AS cnt, 0 AS leaks FROM ev
GROUP BY canvas_id
UNION ALL
SELECT 'k', regexp_extract(props, '([0-9]+)', 1), COUNT(*), 1 FROM ev GROUP BY ALL""")

add("p14_upgrade_timing", lambda s, d: profile.upgrade_timing(events(s, d)), f"""
SELECT event, COUNT(*) AS n_events, quantile_cont(hours, 0.5) AS median_hours,
  CAST(quantile_cont(hours, 0.5) <= 3 AS INTEGER) AS suspect,
  CAST(event IN {BANNED} AS INTEGER) AS is_banned
FROM (
  SELECT event, date_diff('microsecond', timestamp, up) / 86400000000.0 * 24 AS hours
  FROM ev JOIN (SELECT person_id, MIN(timestamp) AS up FROM ev
                WHERE event = 'subscription_upgraded' GROUP BY person_id) USING (person_id))
GROUP BY event""", ["median_hours"])

add("p15_dataset_summary",
    lambda s, d: profile.dataset_summary(events(s, d), label_table(s, d)), """
SELECT CAST(SUM(n) AS BIGINT) AS total_events, COUNT(*) AS unique_users,
  quantile_cont(CAST(n AS DOUBLE), 0.5) AS median_events_per_user,
  (SELECT COUNT(*) FROM lab) AS labelled_users,
  round(100.0 * (SELECT COUNT(*) FROM lab) / COUNT(*)::DOUBLE, 1) AS labelled_pct,
  (SELECT COUNT(*) FROM lab WHERE will_upgrade_in_7d = 1) AS upgraded_users,
  round(100.0 * (SELECT COUNT(*) FROM lab WHERE will_upgrade_in_7d = 1)
    / (SELECT COUNT(*) FROM lab)::DOUBLE, 2) AS upgraded_pct,
  COUNT(*) - (SELECT COUNT(*) FROM lab) AS excluded_users
FROM (SELECT person_id, COUNT(*) AS n FROM ev GROUP BY person_id)""")
