from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stridelog.operators import leakage, profile
from stridelog.sources import events as source
from stridelog.sources import sinks, validation


def test_missing_and_empty_columns_raise(spark):
    df = spark.createDataFrame([("a", None)], "person_id STRING, event STRING")
    with pytest.raises(ValueError, match="missing"):
        validation.validate_raw_events(df)
    with pytest.raises(ValueError, match="without values"):
        validation.validate(df, ["person_id", "event"], "t")
    assert validation.validate_prediction_input(df) is df


def test_label_outside_zero_and_one_raises(spark):
    df = spark.sql("SELECT 'a' AS person_id, 2 AS will_upgrade_in_7d, "
                   "TIMESTAMP '2024-01-01' AS user_cutoff_ts")
    with pytest.raises(ValueError, match="neither"):
        validation.validate_labels(df)
    validation.validate_labels(df.withColumn("will_upgrade_in_7d", F.lit(1)))


def test_missing_paths(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="labels"):
        source.load_labels(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        sinks.run_sql_file(spark, str(tmp_path / "none.sql"))
    empty = sinks.read_csv(spark, str(tmp_path / "none"), "fold INT, auc DOUBLE")
    assert empty.count() == 0 and empty.columns == ["fold", "auc"]


def test_sql_file_writes_parquet(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT id FROM range(3);")
    out = sinks.run_sql_file(spark, str(tmp_path / "q.sql"), output_parquet=str(tmp_path / "o"))
    assert out.count() == 3


def test_text_timestamps_are_read_and_bad_ones_dropped(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00", "x"), ("a", "nonsense", "x"),
         ("a", "2024-01-01T00:00:00Z", None), ("a", "2024-01-01 00:00:00", "offer_declined")],
        "person_id STRING, timestamp STRING, event STRING")
    df.write.parquet(str(tmp_path / "log"))
    assert source.load_raw_events(spark, str(tmp_path / "log")).count() == 2
    assert source.load_raw_events(spark, str(tmp_path / "log"), drop_banned=False).count() == 3
    assert source.drop_audit(df).first()["remaining"] == 2


def test_empty_log_has_null_rate(log):
    empty = log(("a", "2024-01-01 00:00:00", "x")).where("false")
    assert profile.positive_rate(empty).first()[0] is None
    metrics = {r[0]: r[1] for r in profile.full_profile(empty).collect()}
    assert metrics["01_total_rows"] == "0" and metrics["06_positive_rate_pct"] is None


def test_audit_layers(spark):
    df = spark.range(40).selectExpr(
        "CAST(id % 2 AS INT) AS will_upgrade_in_7d", "id % 2 * 2.0 AS twin", "7 AS constant",
        "CAST(IF(id < 5, id % 2, NULL) AS DOUBLE) AS too_few", "rand(1) AS noise",
        "1 AS Upgrade_Plan", "TIMESTAMP '2024-01-02' AS timestamp",
        "TIMESTAMP '2024-01-01' AS user_cutoff_ts")
    found = {(r["layer"], r["column"]): r for r in leakage.audit_features(df).collect()}
    assert set(found) == {(1, "Upgrade_Plan"), (2, "twin"), (3, "timestamp / user_cutoff_ts")}
    assert "'Upgrade'" in found[1, "Upgrade_Plan"]["reason"]
    assert found[3, "timestamp / user_cutoff_ts"]["severity"] == "CRITICAL"
    clean = df.drop("timestamp", "twin", "Upgrade_Plan")
    assert leakage.audit_features(clean).count() == 0


def test_banned_columns_are_dropped(spark):
    df = spark.sql("SELECT 1 AS total_events, 2 AS post_count, 3 AS plan_TYPE, 4 AS promo_code_n")
    assert leakage.drop_banned_columns(df).columns == ["total_events"]
