"""Queries over the propensity model, score metrics and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelog.catalog.event_queries import FEATURE_DOUBLES, FOLD_SQL
from stridelog.catalog.funnel_queries import DEFINITIONS_SQL
from stridelog.catalog.oracle import FEATURE_LIST
from stridelog.catalog.query import Collection
from stridelog.catalog.testdata import (
    feature_store, label_table, predictions, scored_users, segment_table, split_table, stage,
)
from stridelog.config import FEATURES, LABEL, SEED, SPLIT, USER
from stridelog.operators import leakage, metrics, propensity, report

QUERIES = Collection()
add = QUERIES.add


# The model. One training run per session and data set serves all queries about it.

_runs: dict[tuple[str, str], tuple[DataFrame, propensity.PropensityModel]] = {}


def training(s: SparkSession, d: str) -> DataFrame:
    return stage(s, d, "training", lambda: propensity.training_table(
        feature_store(s, d), split_table(s, d)))


def labelled_rows(s, d):
    return training(s, d).where(F.col(SPLIT).isin("train", "validation"))


def folds(s: SparkSession, d: str) -> tuple[DataFrame, dict[int, propensity.PropensityModel]]:
    key = (s.sparkContext.applicationId, d, "folds")
    if key not in _runs:
        _runs[key] = propensity.fit_folds(labelled_rows(s, d))
    return _runs[key]


def oof(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    key = (s.sparkContext.applicationId, d, "oof")
    if key not in _runs:
        _runs[key] = propensity.out_of_fold(*folds(s, d))
    return _runs[key]


def model(s: SparkSession, d: str) -> propensity.PropensityModel:
    key = (s.sparkContext.applicationId, d, "model")
    if key not in _runs:
        trees = propensity.median_iteration(oof(s, d)[1])
        _runs[key] = propensity.refit(training(s, d), trees)
    return _runs[key]


add("m01_training_table",
    lambda s, d: propensity.training_table(feature_store(s, d), split_table(s, d)),
    "SELECT fs.*, split FROM fs JOIN spl USING (person_id)", FEATURE_DOUBLES)


def _feature_columns(s, d):
    table = training(s, d)
    catalog = leakage.column_catalog(table)
    return catalog.where(F.col("column").isin(propensity.get_feature_cols(table)))


add("m02_feature_columns", _feature_columns, " UNION ALL ".join(
    f"SELECT '{f}' AS \"column\", COUNT({f}) AS n_values FROM fs" for f in FEATURES))

add("m03_train_medians",
    lambda s, d: propensity.feature_medians(
        training(s, d).where(F.col(SPLIT) == "train"), FEATURES),
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, quantile_cont(CAST({f} AS DOUBLE), 0.5) AS median"
        " FROM fs JOIN spl USING (person_id) WHERE split = 'train'" for f in FEATURES),
    ["median"])

add("m04_stratified_folds",
    lambda s, d: propensity.stratified_folds(labelled_rows(s, d)).select(USER, LABEL, "fold"),
    f"""
SELECT person_id, will_upgrade_in_7d, CAST((row_number() OVER (
    PARTITION BY will_upgrade_in_7d ORDER BY md5(person_id || '{SEED}')) - 1) % 3 + 1 AS INTEGER)
  AS fold
FROM spl WHERE split IN ('train', 'validation')""")

add("m05_boosted_trees",
    lambda s, d: propensity.scored(model(s, d), labelled_rows(s, d)).select(
        USER, LABEL, propensity.PROBA))
add("m06_best_iterations", lambda s, d: oof(s, d)[1])


def _stopping_checks(s, d):
    """The best round is that of the least recorded loss, and is not the last that may run."""
    at = F.col("losses")[F.col("best_iteration") - 1]
    before = F.slice("losses", 1, propensity.PATIENCE)
    return oof(s, d)[1].select(
        "fold", (at <= F.array_min(before)).alias("best_so_far"),
        ((F.col("rounds") <= propensity.TREES)
         & (F.col("best_iteration") < propensity.TREES)).alias("within_rounds"),
        (F.size("losses") == F.col("rounds")).alias("all_recorded"))


add("m06_stopping_checks", _stopping_checks, """
SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS fold, true AS best_so_far, true AS within_rounds,
  true AS all_recorded""")
add("m07_out_of_fold", lambda s, d: oof(s, d)[0])

FOLD_ROWS = f"""
SELECT person_id, will_upgrade_in_7d, CAST((row_number() OVER (
    PARTITION BY will_upgrade_in_7d ORDER BY md5(person_id || '{SEED}')) - 1) % 3 + 1 AS INTEGER)
  AS fold
FROM spl WHERE split IN ('train', 'validation')"""
IN_RANGE = f"{propensity.PROBA} BETWEEN 0 AND 1 AS in_range"

add("m07_out_of_fold_rows",
    lambda s, d: oof(s, d)[0].selectExpr(USER, "fold", "y_true", IN_RANGE),
    f"SELECT person_id, fold, will_upgrade_in_7d AS y_true, true AS in_range FROM ({FOLD_ROWS})")
add("m08_fold_scores", lambda s, d: metrics.fold_scores(scored_users(s, d)), FOLD_SQL)
add("m08_model_fold_scores",
    lambda s, d: metrics.fold_scores(
        propensity.as_scored(oof(s, d)[0]), oof(s, d)[1].drop("losses")))
add("m09_test_scores", lambda s, d: propensity.score_split(model(s, d), training(s, d)))
add("m09_test_rows",
    lambda s, d: propensity.score_split(model(s, d), training(s, d)).select(
        USER, "y", F.col("p").between(0, 1).alias("in_range")),
    "SELECT person_id, will_upgrade_in_7d AS y, true AS in_range FROM spl WHERE split = 'test'")
add("m10_batch_scoring",
    lambda s, d: propensity.predict_batch(
        model(s, d), feature_store(s, d).drop("account_age_days")).select(
        USER, "upgrade_probability", "upgrade_risk_tier", "recommended_action"))



def _scored_rows(s, d):
    """Every row twice, as the batch may hold a user more than once, with the tier it must have."""
    store = feature_store(s, d).select(USER, *FEATURES[:4])
    p = F.col("upgrade_probability")
    tier = F.when(p > 0.75, "HOT_LEAD").when(p > 0.5, "WARM_LEAD").when(p > 0.25, "NURTURE")
    edge = p.isin(0.75, 0.5, 0.25)  # rounded, so either tier may be right
    return propensity.predict_batch(model(s, d), store.unionByName(store)).select(
        USER, "total_events", p.between(0, 1).alias("in_range"),
        (edge | (F.coalesce(tier, F.lit("COLD")) == F.col("upgrade_risk_tier"))).alias("tier_fits"))


add("m10_batch_rows", _scored_rows, """
SELECT person_id, total_events, true AS in_range, true AS tier_fits
FROM (SELECT * FROM fs UNION ALL SELECT * FROM fs)""")

TIER_CASE = """
  CASE WHEN p >= 0.75 THEN 'HOT_LEAD' WHEN p >= 0.5 THEN 'WARM_LEAD'
       WHEN p >= 0.25 THEN 'NURTURE' ELSE 'COLD' END AS upgrade_risk_tier,
  CASE WHEN p >= 0.75 THEN 'Trigger in-app upgrade modal'
       WHEN p >= 0.5 THEN 'Send personalized feature highlight email'
       WHEN p >= 0.25 THEN 'Enroll in drip campaign'
       ELSE 'Focus on Aha moment activation' END AS recommended_action"""

add("m11_lead_tiers",
    lambda s, d: metrics.lead_tiers(scored_users(s, d)).drop("y", "fold"),
    f"SELECT person_id, p, {TIER_CASE} FROM scored")

add("m12_feature_importance",
    lambda s, d: propensity.feature_importance(model(s, d), s).drop("share"))
add("m12_top_features", lambda s, d: propensity.top_features(model(s, d), feature_store(s, d)))
add("m13_importance_share",
    lambda s, d: propensity.feature_importance(model(s, d), s).select("feature", "share"))


def _importance_checks(s, d):
    """Importances are shares of one, from the largest, for every feature.

    With too few rows for a single split all of them are 0.
    """
    order = Window.orderBy("rank")  # a row per feature
    rows = propensity.feature_importance(model(s, d), s).withColumn(
        "_less", F.lead("importance").over(order))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        ((F.abs(F.sum("share") - 1) < 1e-9) | (F.sum("importance") == 0)).alias("shares_add_up"),
        F.bool_and(F.col("importance") >= F.coalesce("_less", F.lit(0.0))).alias("in_order"))


add("m12_importance_checks", _importance_checks,
    f"SELECT CAST({len(FEATURES)} AS BIGINT) AS n, true AS shares_add_up, true AS in_order")


def _top_values(s, d):
    """The values a user has of the top features, next to the table's own."""
    names = [r["feature"] for r in propensity.feature_importance(model(s, d), s)
             .where("rank <= 3").collect()]
    found = propensity.top_features(model(s, d), feature_store(s, d))
    own = feature_store(s, d).select(USER, F.create_map(*[
        x for n in names for x in (F.lit(n), F.col(n).cast("double"))]).alias("own"))
    return found.join(own, USER).select(USER, (
        F.map_entries("own") == F.map_entries("top_features")).alias("own_values"))


add("m12_top_values", _top_values, "SELECT person_id, true AS own_values FROM fs")


def held_out(s: SparkSession, d: str) -> tuple[propensity.PropensityModel, DataFrame]:
    """The model of all folds but the first, and the rows of the first, which it has not seen."""
    rows, models = folds(s, d)
    return models[1], rows.where("fold = 1")


add("m14_permutation_importance",
    lambda s, d: propensity.permutation_importance(*held_out(s, d)))
add("m14_permutation_checks",
    lambda s, d: propensity.permutation_importance(*held_out(s, d)).agg(
        F.count(F.lit(1)).alias("n"), (F.count_distinct("base_auc") <= 1).alias("one_base"),
        F.coalesce(F.bool_and(F.col("shuffled_auc").between(0, 1)), F.lit(True)).alias("in_range")),
    f"SELECT CAST({len(FEATURES)} AS BIGINT) AS n, true AS one_base, true AS in_range")

add("m15_seeded_sample",
    lambda s, d: propensity.seeded_sample(label_table(s, d)).select(USER, LABEL),
    f"SELECT person_id, will_upgrade_in_7d FROM lab ORDER BY md5(person_id || '{SEED}') LIMIT 1000")

add("m16_model_metadata",
    lambda s, d: propensity.model_metadata(
        training(s, d), *oof(s, d), propensity.score_split(model(s, d), training(s, d))))

add("m16_metadata_sizes",
    lambda s, d: propensity.model_metadata(
        training(s, d), *oof(s, d), propensity.score_split(model(s, d), training(s, d))
    ).select("n_train", "n_val", "n_test", "n_features"), f"""
SELECT COUNT(*) FILTER (WHERE split = 'train') AS n_train,
  COUNT(*) FILTER (WHERE split = 'validation') AS n_val,
  COUNT(*) FILTER (WHERE split = 'test') AS n_test,
  CAST({len(FEATURES)} AS INTEGER) AS n_features FROM spl""")


# Metrics

PAIRS_SQL = """
  SELECT AVG(CASE WHEN x.p > z.p THEN 1.0 WHEN x.p = z.p THEN 0.5 ELSE 0.0 END)
  FROM scored x, scored z WHERE x.y = 1 AND z.y = 0"""
AP_SQL = """
  SELECT AVG(precision_at) FROM (
    SELECT x.person_id, SUM(z.y)::DOUBLE / COUNT(*) AS precision_at
    FROM scored x JOIN scored z ON z.p >= x.p AND x.y = 1 GROUP BY x.person_id)"""
TP = "COUNT(*) FILTER (WHERE p >= 0.5 AND y = 1)"
FLAGGED = "COUNT(*) FILTER (WHERE p >= 0.5)"
POSITIVES = "COUNT(*) FILTER (WHERE y = 1)"
PRF = f"""
  COALESCE({TP}::DOUBLE / NULLIF({FLAGGED}, 0), 0.0) AS precision,
  COALESCE({TP}::DOUBLE / NULLIF({POSITIVES}, 0), 0.0) AS recall,
  COALESCE(2.0 * {TP} / NULLIF({FLAGGED} + {POSITIVES}, 0)::DOUBLE, 0.0) AS f1"""
CLIPPED = "greatest(least(p, 1 - 2.220446049250313e-16), 2.220446049250313e-16)"
LOSS = f"AVG(-ln(CASE WHEN y = 1 THEN {CLIPPED} ELSE 1 - {CLIPPED} END))"

add("e01_roc_auc", lambda s, d: metrics.rank_metrics(scored_users(s, d)).select("roc_auc"),
    f"SELECT ({PAIRS_SQL}) AS roc_auc", ["roc_auc"])

add("e02_average_precision",
    lambda s, d: metrics.rank_metrics(scored_users(s, d)).select("pr_auc"),
    f"SELECT ({AP_SQL}) AS pr_auc", ["pr_auc"])

add("e03_threshold_metrics", lambda s, d: metrics.threshold_metrics(scored_users(s, d)),
    f"SELECT {PRF} FROM scored", ["precision", "recall", "f1"])

add("e04_brier_score", lambda s, d: metrics.brier_score(scored_users(s, d)),
    "SELECT AVG((p - y) * (p - y)) AS brier_score FROM scored", ["brier_score"])

add("e05_log_loss", lambda s, d: metrics.log_loss(scored_users(s, d)),
    f"SELECT {LOSS} AS log_loss FROM scored", ["log_loss"])

add("e06_full_report", lambda s, d: metrics.full_eval_report(scored_users(s, d)), f"""
SELECT round(({PAIRS_SQL}), 4) AS roc_auc, round(({AP_SQL}), 4) AS pr_auc,
  round(f1, 4) AS f1, round(precision, 4) AS precision, round(recall, 4) AS recall,
  round(brier, 4) AS brier_score, round(loss, 4) AS log_loss, n_positives, n_total,
  round(n_positives::DOUBLE / n_total, 4) AS positive_rate, 0.5::DOUBLE AS threshold_used
FROM (SELECT {PRF}, AVG((p - y) * (p - y)) AS brier, {LOSS} AS loss,
  {POSITIVES} AS n_positives, COUNT(*) AS n_total FROM scored)""")


def _report_by_split(s, d):
    scores = scored_users(s, d).select(USER, "p").join(split_table(s, d), USER)
    return metrics.full_eval_report(
        scores.select(SPLIT, F.col(LABEL).alias("y"), "p"), [SPLIT]
    ).select(SPLIT, "roc_auc", "pr_auc", "n_positives", "n_total")


add("e06_report_by_split", _report_by_split, """
WITH ss AS (SELECT split, person_id, will_upgrade_in_7d AS y, p FROM scored JOIN spl USING (person_id))
SELECT split, round((SELECT AVG(CASE WHEN x.p > z.p THEN 1.0 WHEN x.p = z.p THEN 0.5 ELSE 0.0 END)
    FROM ss x, ss z WHERE x.split = g.split AND z.split = g.split AND x.y = 1 AND z.y = 0), 4)
    AS roc_auc,
  round((SELECT AVG(precision_at) FROM (
    SELECT x.split AS sp, SUM(z.y)::DOUBLE / COUNT(*) AS precision_at
    FROM ss x JOIN ss z ON x.split = z.split AND z.p >= x.p AND x.y = 1
    GROUP BY x.split, x.person_id) WHERE sp = g.split), 4) AS pr_auc,
  CAST(SUM(y) AS BIGINT) AS n_positives, COUNT(*) AS n_total
FROM ss g GROUP BY split""")

CURVE = """
  SELECT p AS threshold,
    (SELECT COUNT(*) FROM scored z WHERE z.p >= x.p AND z.y = 1)::DOUBLE AS tp,
    (SELECT COUNT(*) FROM scored z WHERE z.p >= x.p AND z.y = 0)::DOUBLE AS fp
  FROM (SELECT DISTINCT p FROM scored) x"""
SIZES = "(SELECT COUNT(*) FROM scored WHERE y = 1)"
NEGATIVES = "(SELECT COUNT(*) FROM scored WHERE y = 0)"

add("e07_roc_points", lambda s, d: metrics.roc_points(scored_users(s, d)), f"""
SELECT threshold, fp / {NEGATIVES} AS fpr, tp / {SIZES} AS tpr FROM ({CURVE})
UNION ALL SELECT NULL, 0.0, 0.0""", ["fpr", "tpr"])

add("e08_pr_points", lambda s, d: metrics.pr_points(scored_users(s, d)), f"""
SELECT threshold, tp / (tp + fp) AS precision, tp / {SIZES} AS recall,
  (SELECT AVG(y) FROM scored) AS base_rate FROM ({CURVE})
UNION ALL SELECT NULL, 1.0, 0.0, (SELECT AVG(y) FROM scored)""",
    ["precision", "recall", "base_rate"])

add("e09_calibration", lambda s, d: metrics.calibration(scored_users(s, d)), """
SELECT CAST(greatest(ceil(p * 10) - 1, 0) AS INTEGER) AS bin, AVG(p) AS mean_predicted,
  AVG(y) AS fraction_positive, COUNT(*) AS n FROM scored GROUP BY 1""",
    ["mean_predicted", "fraction_positive"])

add("e10_calibration_custom", lambda s, d: metrics.calibration_at(scored_users(s, d)), """
SELECT CASE WHEN p < 0.1 THEN '0.0 - 0.1' WHEN p < 0.2 THEN '0.1 - 0.2'
    WHEN p < 0.3 THEN '0.2 - 0.3' WHEN p < 0.5 THEN '0.3 - 0.5' WHEN p < 0.7 THEN '0.5 - 0.7'
    ELSE '0.7 - 1.0' END AS score_range,
  COUNT(*) AS n, AVG(y) AS actual_rate, AVG(p) AS mean_predicted,
  abs(AVG(y) - AVG(p)) AS calibration_error
FROM scored GROUP BY 1""", ["actual_rate", "mean_predicted", "calibration_error"])

add("e11_confusion_matrix", lambda s, d: metrics.confusion_matrix(scored_users(s, d)), """
SELECT a.v AS actual, b.v AS predicted,
  (SELECT COUNT(*) FROM scored WHERE y = a.v AND CAST(p >= 0.5 AS INTEGER) = b.v) AS n
FROM (SELECT unnest([0, 1]) AS v) a, (SELECT unnest([0, 1]) AS v) b""")

SWEEP = """
  SELECT round(t, 2) AS threshold, round(COALESCE(tp / NULLIF(flagged, 0), 0.0), 4) AS precision,
    round(COALESCE(tp / NULLIF(actual, 0), 0.0), 4) AS recall,
    round(COALESCE(2 * tp / NULLIF(flagged + actual, 0), 0.0), 4) AS f1,
    CAST(flagged AS BIGINT) AS n_flagged, round(100.0 * flagged / n, 2) AS pct_flagged
  FROM (
    SELECT t, COUNT(*) FILTER (WHERE p >= t AND y = 1)::DOUBLE AS tp,
      COUNT(*) FILTER (WHERE p >= t)::DOUBLE AS flagged,
      COUNT(*) FILTER (WHERE y = 1)::DOUBLE AS actual, COUNT(*)::DOUBLE AS n
    FROM scored, (SELECT 0.1::DOUBLE + 0.05::DOUBLE * unnest(range(17)) AS t) GROUP BY t)"""

add("e12_threshold_sweep", lambda s, d: metrics.threshold_analysis(scored_users(s, d)), SWEEP)

add("e13_best_threshold", lambda s, d: metrics.best_threshold(scored_users(s, d)),
    f"SELECT * FROM ({SWEEP}) ORDER BY f1 DESC, threshold LIMIT 1")

add("e14_class_separation", lambda s, d: metrics.class_separation(scored_users(s, d)), """
SELECT y, COUNT(*) AS n, AVG(p) AS mean_p, MIN(p) AS min_p, MAX(p) AS max_p,
  quantile_cont(p, 0.5) AS median_p FROM scored GROUP BY y""", ["mean_p", "median_p"])

add("e15_score_histogram", lambda s, d: metrics.score_histogram(scored_users(s, d)), """
WITH r AS (
  SELECT y, MIN(p) AS lo, (MAX(p) - MIN(p)) / 50 AS w, COUNT(*) AS total FROM scored GROUP BY y),
binned AS (
  SELECT scored.y, CAST(least(floor((p - lo) / w), 49) AS INTEGER) AS bin, COUNT(*) AS n
  FROM scored JOIN r ON r.y = scored.y GROUP BY 1, 2)
SELECT r.y, CAST(i AS INTEGER) AS bin, lo + i * w AS bin_start, COALESCE(n, 0) AS n,
  COALESCE(n, 0) / (total * w) AS density
FROM r CROSS JOIN (SELECT unnest(range(50)) AS i)
LEFT JOIN binned ON binned.y = r.y AND binned.bin = i""", ["bin_start", "density"])

add("e16_score_bands", lambda s, d: metrics.score_bands(scored_users(s, d)), """
SELECT CASE WHEN p >= 0.8 THEN 'HOT_LEAD' WHEN p >= 0.5 THEN 'WARM_LEAD'
    WHEN p >= 0.2 THEN 'NURTURE' ELSE 'COLD' END AS score_band,
  COUNT(*) AS users, CAST(SUM(y) AS BIGINT) AS actual_upgrades, round(AVG(y), 3) AS precision
FROM scored GROUP BY 1""")

add("e17_fold_table",
    lambda s, d: metrics.with_mean_row(metrics.fold_scores(scored_users(s, d))), f"""
WITH folds AS ({FOLD_SQL})
SELECT rows.*, (SELECT MIN(auc) FROM folds) AS auc_min, (SELECT MAX(auc) FROM folds) AS auc_max
FROM (
  SELECT CAST(fold AS VARCHAR) AS fold, CAST(n_val AS DOUBLE) AS n_val,
    CAST(n_pos AS DOUBLE) AS n_pos, auc, pr_auc FROM folds
  UNION ALL SELECT 'Mean', round(AVG(n_val), 4), round(AVG(n_pos), 4), round(AVG(auc), 4),
    round(AVG(pr_auc), 4) FROM folds) AS rows""")


# Reports

UNPIVOTED = f"""
  SELECT person_id, funnel_segment, feature, v FROM (
    SELECT person_id, funnel_segment,
      {", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FEATURES)} FROM seg)
  UNPIVOT (v FOR feature IN ({FEATURE_LIST}))"""
LIFTS = f"""
  SELECT funnel_segment, feature, m AS segment_mean,
    (m - overall) / (abs(overall) + 1e-9) AS lift
  FROM (SELECT funnel_segment, feature, AVG(v) AS m FROM ({UNPIVOTED}) GROUP BY ALL)
  JOIN (SELECT feature, AVG(v) AS overall FROM ({UNPIVOTED}) GROUP BY ALL) USING (feature)"""
TOP3 = f"""
  SELECT funnel_segment, row_number() OVER (PARTITION BY funnel_segment
      ORDER BY round(abs(lift), 9) DESC, feature) AS rank,
    feature, round(segment_mean, 3) AS value, lift FROM ({LIFTS})
  QUALIFY rank <= 3"""


def _full_report(s, d):
    return report.generate_full_report(segment_table(s, d), predictions(s, d)).withColumn(
        "top_diagnostic_features",
        F.concat_ws(", ", F.transform("top_diagnostic_features", lambda t: t["feature"])))


add("r01_funnel_report", _full_report, f"""
SELECT seg.funnel_segment, COUNT(*) AS user_count,
  round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM seg)::DOUBLE, 2) AS pct_of_total,
  AVG(p) AS mean_upgrade_prob, AVG(will_upgrade_in_7d) AS actual_conversion_rate,
  COALESCE(ANY_VALUE(def.upgrade_likelihood), 'Unknown') AS upgrade_likelihood,
  ANY_VALUE(top) AS top_diagnostic_features,
  COALESCE(ANY_VALUE(def.recommended_action), 'Review and classify manually')
    AS recommended_action,
  COALESCE(ANY_VALUE(def.description), '') AS description
FROM seg LEFT JOIN scored USING (person_id)
LEFT JOIN (SELECT funnel_segment, string_agg(feature, ', ' ORDER BY rank) AS top
           FROM ({TOP3}) GROUP BY funnel_segment) t USING (funnel_segment)
LEFT JOIN __DEFINITIONS__ ON def.funnel_segment = seg.funnel_segment
GROUP BY seg.funnel_segment""".replace("__DEFINITIONS__", DEFINITIONS_SQL),
    ["mean_upgrade_prob", "actual_conversion_rate"])


def _one_prediction(s, d):
    """Two scores per user: the user's own and half of it."""
    scores = predictions(s, d)
    halves = scores.select(USER, (F.col("upgrade_probability") / 2).alias("upgrade_probability"))
    return report.one_prediction_per_user(scores.unionByName(halves))


add("r02_one_prediction_per_user", _one_prediction,
    "SELECT person_id, p AS upgrade_probability FROM scored")

add("r03_top_diagnostic_features",
    lambda s, d: report.top_diagnostic_features(segment_table(s, d)), TOP3, ["lift"])

add("r04_kpi_row", lambda s, d: report.kpi_row(feature_store(s, d)), """
SELECT COUNT(*) AS labelled_users, CAST(SUM(will_upgrade_in_7d) AS BIGINT) AS upgraders,
  round(AVG(will_upgrade_in_7d) * 100, 2) AS upgrade_rate_pct FROM fs""")



def _kpis_with_aucs(s, d):
    """The KPI row with AUCs as a training run's metadata has them, here of the fixed score."""
    auc = F.round("roc_auc", 4)
    metadata = metrics.rank_metrics(scored_users(s, d)).select(
        auc.alias("oof_auc"), auc.alias("test_auc"))
    return report.kpi_row(feature_store(s, d), metadata)


add("r04_kpi_row_with_aucs", _kpis_with_aucs, f"""
SELECT COUNT(*) AS labelled_users, CAST(SUM(will_upgrade_in_7d) AS BIGINT) AS upgraders,
  round(AVG(will_upgrade_in_7d) * 100, 2) AS upgrade_rate_pct,
  (SELECT round(({PAIRS_SQL}), 4)) AS oof_auc, (SELECT round(({PAIRS_SQL}), 4)) AS test_auc
FROM fs""")

add("r05_descriptive_stats", lambda s, d: report.descriptive_stats(feature_store(s, d)),
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(AVG({c}), 2) AS mean,"
        f" round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) AS median,"
        f" round(CAST(MIN({c}) AS DOUBLE), 2) AS min, round(CAST(MAX({c}) AS DOUBLE), 2) AS max"
        " FROM fs" for c in report.DESCRIBED))

add("r06_feature_quantiles",
    lambda s, d: report.quantile_table(
        feature_store(s, d), FEATURES, {"p25": 0.25, "p50": 0.5, "p90": 0.9}),
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,"
        f" quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,"
        f" quantile_cont(CAST({c} AS DOUBLE), 0.9) AS p90 FROM fs" for c in FEATURES),
    ["p25", "p50", "p90"])

add("r07_form_features", lambda s, d: report.form_features(feature_store(s, d)), """
SELECT person_id, round(friction_events::DOUBLE / greatest(total_events, 1), 4)
    AS form_friction_ratio,
  round(events_last_7d::DOUBLE / greatest(events_last_14_to_7d, 1) - 1, 4) AS form_wow_growth,
  CAST(round(events_last_7d::DOUBLE / greatest(events_last_14_to_7d, 1) - 1, 4) > 0.20
    AS INTEGER) AS form_is_accelerating
FROM fs""")

add("r08_score_minus_base_rate",
    lambda s, d: report.score_minus_base_rate(scored_users(s, d)), """
SELECT person_id, p, (SELECT AVG(y) FROM scored) AS base_rate,
  p - (SELECT AVG(y) FROM scored) AS delta FROM scored""", ["base_rate", "delta"])
