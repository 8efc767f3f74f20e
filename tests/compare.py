"""Run registered queries in Spark and DuckDB side by side: ``python -m tests.compare [sf_dir] [names]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from typing import Any

import duckdb
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value: Any) -> Any:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else 0.0 if value == 0 else value
    return value


def _rows(names: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got == expected:
        return None
    extra, lacking = sorted(set(got) - set(expected))[:3], sorted(set(expected) - set(got))[:3]
    return f"{len(got)} rows, expected {len(expected)}\n   extra {extra}\n   lacking {lacking}"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(contract.queries())
    spark, con, oracle = local_session(), database(sf_dir), contract.oracle_sql()
    failures = 0
    for name in chosen:
        start = time.time()
        try:
            df = contract.queries()[name](spark, sf_dir)
            problem = differences(df, con, oracle[name]) if name in oracle else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failures += problem is not None and name in oracle
        print(f"{name:36} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print("failures:", failures)


if __name__ == "__main__":
    main()
