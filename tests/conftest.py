from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stridelog.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("stridelog-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)


@pytest.fixture
def log(spark):
    """Build an event log from (user, timestamp text, event[, session]) rows."""
    def build(*rows):
        full = [(r[0], r[1], r[2], r[3] if len(r) > 3 else None) for r in rows]
        return spark.createDataFrame(
            full, "person_id STRING, timestamp STRING, event STRING, canvas_id STRING"
        ).selectExpr("person_id", "CAST(timestamp AS TIMESTAMP_NTZ) AS timestamp", "event",
                     "canvas_id")
    return build


@pytest.fixture
def cutoffs(spark):
    def build(**users):
        return spark.createDataFrame(list(users.items()), "person_id STRING, c STRING").selectExpr(
            "person_id", "CAST(c AS TIMESTAMP_NTZ) AS user_cutoff_ts")
    return build
