"""Compare every registered query with its DuckDB oracle: names, row count, values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.sources import TABLES  # noqa: E402


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value: object) -> str:
    if isinstance(value, float) and not math.isnan(value):
        return repr(round(value, 9))
    return repr(value)


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    expected = connection.execute(sql)
    names = [item[0] for item in expected.description]
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} instead of {sorted(names)}"]
    wanted = _sorted_rows(names, expected.fetchall())
    found = _sorted_rows(result.columns, [tuple(row) for row in result.collect()])
    if len(wanted) != len(found):
        return [f"{len(found)} rows instead of {len(wanted)}"]
    return [f"{f} instead of {w}" for f, w in zip(found, wanted) if f != w][:3]


def main(sf_dir: str, *names: str) -> None:
    import __spark_entry__ as driver

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("FATAL")
    connection = oracle_connection(sf_dir)
    oracles = driver.oracle_sql()
    failed = 0
    for name, query in driver.queries().items():
        if name not in (names or oracles):
            continue
        started = time.time()
        try:
            found = differences(query(spark, sf_dir), connection, oracles[name])
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':5}{name:28}{time.time() - started:6.2f}s", *found, sep="\n      " if found else " ", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(*sys.argv[1:])
