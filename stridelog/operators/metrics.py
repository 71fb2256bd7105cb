"""Evaluation of scores against labels.

Every function takes a table with a label ``y`` (0 or 1) and a score ``p``.
With ``by`` the metrics are per group, such as per fold or split. Scores are first
counted per distinct value, so curves have one point per distinct score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelog.config import LEAD_TIERS
from stridelog.functions.columns import first_match, safe_ratio, share_pct
from stridelog.functions.ordered import exact_quantiles, running_totals
from stridelog.functions.skew import attach_per_group

EPSILON = 2.220446049250313e-16

# Thresholds 0.10, 0.15, … 0.90.
SWEEP_START, SWEEP_STEP, SWEEP_POINTS = 0.1, 0.05, 17

# Score bands as (lowest score, name); not the same as the lead tiers.
SCORE_BANDS = ((0.8, "HOT_LEAD"), (0.5, "WARM_LEAD"), (0.2, "NURTURE"), (0.0, "COLD"))

# Edges of the calibration ranges.
CUSTOM_EDGES = (0.0, 0.1, 0.2, 0.3, 0.5, 0.7, 1.0)
HISTOGRAM_BINS = 50
CALIBRATION_BINS = 10


def _pair(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    return left.join(right, list(by)) if by else left.crossJoin(F.broadcast(right))


def score_curve(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: positives and negatives with it, and with it or a higher one."""
    counts = scored.groupBy(*by, "p").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    return running_totals(counts, by, "p", ["pos", "neg"])


def rank_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and average precision; null for a group of one class."""
    pos, neg = F.col("pos"), F.col("neg")
    n_pos, n_neg = F.sum(pos), F.sum(neg)
    below = F.sum(neg * (F.col("cum_pos") - pos / F.lit(2.0)))
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    both = (n_pos > 0) & (n_neg > 0)
    return score_curve(scored, by).groupBy(*by).agg(
        F.when(both, safe_ratio(below, n_pos * n_neg)).alias("roc_auc"),
        F.when(both, safe_ratio(F.sum(pos * precision), n_pos)).alias("pr_auc"),
    )


def threshold_metrics(scored: DataFrame, by: Sequence[str] = (),
                      threshold: float = 0.5) -> DataFrame:
    """Precision, recall and F1 when scores from the threshold on count as positive."""
    called = F.col("p") >= threshold
    counts = scored.groupBy(*by).agg(
        F.count_if(called & (F.col("y") == 1)).alias("tp"),
        F.count_if(called).alias("flagged"),
        F.count_if(F.col("y") == 1).alias("actual"),
    )
    return counts.select(*by, *_precision_recall_f1())


def _precision_recall_f1() -> list[Column]:
    tp, flagged, actual = F.col("tp"), F.col("flagged"), F.col("actual")
    return [
        safe_ratio(tp, flagged, 0.0).alias("precision"),
        safe_ratio(tp, actual, 0.0).alias("recall"),
        safe_ratio(F.lit(2) * tp, flagged + actual, 0.0).alias("f1"),
    ]


def brier_score(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(_brier().alias("brier_score"))


def _brier() -> Column:
    return F.avg((F.col("p") - F.col("y")) * (F.col("p") - F.col("y")))


def log_loss(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(_log_loss().alias("log_loss"))


def _log_loss() -> Column:
    p = F.greatest(F.least(F.col("p"), F.lit(1.0 - EPSILON)), F.lit(EPSILON))
    return F.avg(-F.ln(F.when(F.col("y") == 1, p).otherwise(F.lit(1.0) - p)))


def full_eval_report(scored: DataFrame, by: Sequence[str] = (),
                     threshold: float = 0.5) -> DataFrame:
    """All metrics of a score in one row (per group), to four digits."""
    called = F.col("p") >= threshold
    counts = scored.groupBy(*by).agg(
        F.count_if(called & (F.col("y") == 1)).alias("tp"),
        F.count_if(called).alias("flagged"),
        F.count_if(F.col("y") == 1).alias("actual"),
        _brier().alias("brier_score"),
        _log_loss().alias("log_loss"),
        F.count(F.lit(1)).alias("n_total"),
    ).select(
        *by, *_precision_recall_f1(), "brier_score", "log_loss",
        F.col("actual").alias("n_positives"), "n_total",
        safe_ratio(F.col("actual"), F.col("n_total")).alias("positive_rate"),
        F.lit(threshold).alias("threshold_used"),
    )
    metrics = ["roc_auc", "pr_auc", "f1", "precision", "recall", "brier_score", "log_loss"]
    return _pair(counts, rank_metrics(scored, by), by).select(
        *by, *[F.round(m, 4).alias(m) for m in metrics], "n_positives", "n_total",
        F.round("positive_rate", 4).alias("positive_rate"), "threshold_used",
    )


def _class_sizes(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    return scored.groupBy(*by).agg(
        F.count_if(F.col("y") == 1).alias("_P"), F.count_if(F.col("y") == 0).alias("_N")
    )


def roc_points(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate per distinct score, and the origin (score null)."""
    sizes = _class_sizes(scored, by)
    points = attach_per_group(score_curve(scored, by), sizes, by, "p").select(
        *by, F.col("p").alias("threshold"),
        safe_ratio(F.col("cum_neg"), F.col("_N")).alias("fpr"),
        safe_ratio(F.col("cum_pos"), F.col("_P")).alias("tpr"),
    )
    origin = sizes.select(
        *by, F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(origin)


def pr_points(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall per distinct score with the base rate, and the end at recall 0."""
    sizes = _class_sizes(scored, by).withColumn(
        "base_rate", safe_ratio(F.col("_P"), F.col("_P") + F.col("_N"))
    )
    points = attach_per_group(score_curve(scored, by), sizes, by, "p").select(
        *by, F.col("p").alias("threshold"),
        safe_ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        safe_ratio(F.col("cum_pos"), F.col("_P")).alias("recall"),
        "base_rate",
    )
    end = sizes.select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"), "base_rate",
    )
    return points.unionByName(end)


def calibration(scored: DataFrame, bins: int = CALIBRATION_BINS) -> DataFrame:
    """Mean score and share of positives per equal bin (edge, next edge]; no empty bins."""
    place = F.greatest(F.ceil(F.col("p") * bins) - 1, F.lit(0)).cast("int")
    return scored.groupBy(place.alias("bin")).agg(
        F.avg("p").alias("mean_predicted"), F.avg("y").alias("fraction_positive"),
        F.count(F.lit(1)).alias("n"),
    )


def calibration_at(scored: DataFrame, edges: Sequence[float] = CUSTOM_EDGES) -> DataFrame:
    """Count, actual rate, mean score and their distance per bin [edge, next edge)."""
    names = [
        (f"{low:.1f} - {high:.1f}", F.col("p") < high if high < edges[-1] else F.lit(True))
        for low, high in zip(edges, edges[1:])
    ]
    actual, mean = F.avg("y"), F.avg("p")
    return scored.groupBy(first_match(names, "").alias("score_range")).agg(
        F.count(F.lit(1)).alias("n"), actual.alias("actual_rate"),
        mean.alias("mean_predicted"), F.abs(actual - mean).alias("calibration_error"),
    )


def confusion_matrix(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The four cells (actual, predicted, n), empty ones included."""
    called = F.when(F.col("p") >= threshold, 1).otherwise(0)
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    counts = scored.agg(*[
        F.count_if((F.col("y") == a) & (called == b)).alias(f"c{a}{b}") for a, b in cells
    ])
    rows = F.array(*[
        F.struct(
            F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("n")
        )
        for a, b in cells
    ])
    return counts.select(F.inline(rows))


def threshold_analysis(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and share flagged at each threshold of the sweep.

    Scores are counted by how many thresholds they reach; a threshold's figures are sums
    of these few counts.
    """
    steps = F.sequence(F.lit(0), F.lit(SWEEP_POINTS - 1))
    thresholds = F.transform(steps, lambda i: F.lit(SWEEP_START) + F.lit(SWEEP_STEP) * i)
    reached = F.size(F.filter(thresholds, lambda t: F.col("p") >= t))
    counts = scored.groupBy(reached.alias("reached")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("pos")
    )
    # A count takes part in every threshold; only those reached add to what is flagged.
    spread = counts.select(
        "reached", "n", "pos", F.posexplode(thresholds).alias("i", "threshold")
    )
    flagged = F.col("reached") > F.col("i")
    sums = spread.groupBy("i", "threshold").agg(
        F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(flagged, F.col("n")).otherwise(0)).alias("flagged"),
        F.sum("pos").alias("actual"), F.sum("n").alias("n_total"),
    )
    return sums.select(
        F.round("threshold", 2).alias("threshold"),
        *_rounded_metrics(),
        F.col("flagged").alias("n_flagged"),
        share_pct(F.col("flagged"), F.col("n_total"), 2).alias("pct_flagged"),
    )


def _rounded_metrics() -> list[Column]:
    tp, flagged, actual = F.col("tp"), F.col("flagged"), F.col("actual")
    return [
        F.round(safe_ratio(tp, flagged, 0.0), 4).alias("precision"),
        F.round(safe_ratio(tp, actual, 0.0), 4).alias("recall"),
        F.round(safe_ratio(F.lit(2) * tp, flagged + actual, 0.0), 4).alias("f1"),
    ]


def best_threshold(scored: DataFrame) -> DataFrame:
    """The lowest threshold of the sweep with the highest F1."""
    return threshold_analysis(scored).orderBy(F.desc("f1"), F.asc("threshold")).limit(1)


def class_separation(scored: DataFrame) -> DataFrame:
    """Mean, median, least and greatest score per class."""
    spread = scored.groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.avg("p").alias("mean_p"),
        F.min("p").alias("min_p"), F.max("p").alias("max_p"),
    )
    return spread.join(exact_quantiles(scored, ["y"], "p", {"median_p": 0.5}, True), "y")


def score_histogram(scored: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Score density per class in equal bins over the class's own range, empty bins included."""
    low, high = F.min("p"), F.max("p")
    ranges = scored.groupBy("y").agg(
        F.when(low == high, low - 0.5).otherwise(low).alias("_lo"),
        F.when(low == high, high + 0.5).otherwise(high).alias("_hi"),
        F.count(F.lit(1)).alias("_total"),
    ).withColumn("_width", (F.col("_hi") - F.col("_lo")) / bins)
    ranges = F.broadcast(ranges)  # one row per class
    place = F.least(F.floor((F.col("p") - F.col("_lo")) / F.col("_width")), F.lit(bins - 1))
    counts = scored.join(ranges, "y").groupBy("y", place.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    frame = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return frame.join(counts, ["y", "bin"], "left").select(
        "y", "bin", (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
        n.alias("n"), (n / (F.col("_total") * F.col("_width"))).alias("density"),
    )


def score_bands(scored: DataFrame) -> DataFrame:
    """Users, upgraders and precision per score band that has users."""
    band = first_match([(name, F.col("p") >= low) for low, name in SCORE_BANDS], "COLD")
    return scored.groupBy(band.alias("score_band")).agg(
        F.count("y").alias("users"), F.sum(F.col("y").cast("long")).alias("actual_upgrades"),
        F.round(F.avg("y"), 3).alias("precision"),
    )


def lead_tiers(scored: DataFrame, score: str = "p") -> DataFrame:
    """Add the lead tier and the action recommended for it."""
    return scored.withColumns({
        "upgrade_risk_tier": first_match(
            [(tier, F.col(score) >= low) for low, tier, _ in LEAD_TIERS], LEAD_TIERS[-1][1]
        ),
        "recommended_action": first_match(
            [(action, F.col(score) >= low) for low, _, action in LEAD_TIERS], LEAD_TIERS[-1][2]
        ),
    })


def fold_scores(scored: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Rows, positives, ROC-AUC and average precision per fold; ``extra`` adds columns by fold."""
    counts = scored.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_val"), F.count_if(F.col("y") == 1).alias("n_pos")
    )
    scores = counts.join(rank_metrics(scored, ["fold"]), "fold").select(
        "fold", "n_val", "n_pos", F.round("roc_auc", 4).alias("auc"),
        F.round("pr_auc", 4).alias("pr_auc"),
    )
    return scores if extra is None else scores.join(extra, "fold")


def with_mean_row(folds: DataFrame) -> DataFrame:
    """The fold table with its means as a last row, and each metric's span over the folds."""
    figures = [c for c in folds.columns if c != "fold"]
    rows = folds.select(F.col("fold").cast("string").alias("fold"),
                        *[F.col(c).cast("double").alias(c) for c in figures])
    means = folds.agg(*[F.round(F.avg(c), 4).alias(c) for c in figures]).select(
        F.lit("Mean").alias("fold"), *figures
    )
    span = folds.agg(F.min("auc").alias("auc_min"), F.max("auc").alias("auc_max"))
    return rows.unionByName(means).crossJoin(F.broadcast(span))

