"""Compare registered queries with their SQL on one data set; names on the command line limit it."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _key(row):
    return tuple((v is None, str(type(v).__name__), str(v)) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(_cell(r[c]) for c in names) for r in df.select(
        *[f"`{c}`" for c in names]).collect()]
    return names, sorted(rows, key=_key)


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_cell(r[i]) for i in order) for r in result.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=_key)


def difference(left, right) -> str | None:
    """What is different between two (names, rows), or None. Numbers must have equal types."""
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])} rows"
    for a, b in zip(left[1], right[1]):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"{dict(zip(left[0], a))} != {dict(zip(right[0], b))}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as driver

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = driver.oracle_sql()
    wanted = sys.argv[1:]
    bad = 0
    for name, run in driver.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            mine = spark_rows(run(spark, sf_dir))
            took = time.time() - start
            theirs = duck_rows(con, oracle[name]) if name in oracle else None
            problem = difference(mine, theirs) if theirs else None
        except Exception as error:  # noqa: BLE001
            took, problem, mine = time.time() - start, f"{type(error).__name__}: {error}"[:900], ([], [])
        kind = "sql " if name in oracle else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {took:6.2f}s {len(mine[1]):6d} {name}"
              + (f"\n     {problem[:900]}" if problem else ""), flush=True)
        bad += bool(problem)
    print(f"{bad} failed")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
