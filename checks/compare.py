"""Runs registered queries against DuckDB on the same tables."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.queries import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def difference(df: DataFrame, connection, name: str) -> str | None:
    """None if both engines agree, else what differs."""
    ours = rows_of(df.columns, df.collect())
    if name not in ORACLE:
        return None if ours else "no rows"
    result = connection.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if ours == theirs:
        return None
    ours_only = sorted(set(ours) - set(theirs), key=repr)[:3]
    theirs_only = sorted(set(theirs) - set(ours), key=repr)[:3]
    return (
        f"{len(ours)} rows != {len(theirs)}; {sorted(columns)}\n"
        f"  ours {ours_only}\n  theirs {theirs_only}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    # A plain session: the queries must not depend on the settings of build_session().
    builder = SparkSession.builder.master("local[8]").appName("checks")
    options = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found = difference(QUERIES[name](spark, sf_dir), connection, name)
        except Exception as error:  # noqa: BLE001  (report and go on)
            found = f"{type(error).__name__}: {str(error)[:700]}"
        failed += found is not None
        status, took = "FAIL" if found else "ok", time.time() - start
        print(f"{status} {name} {took:.1f}s {found or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
