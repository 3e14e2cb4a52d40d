"""Run registered queries and compare them with their SQL: ``python -m checks.compare [names]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES
from tradeweir.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    return connection


def differences(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What is unequal: column names, value kinds, or rows as a multiset. Empty if nothing is."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} and {sorted(names)}"]
    order = sorted(names)
    wanted = Counter(_plain(row, names, order) for row in cursor.fetchall())
    found = Counter(_plain(tuple(row), frame.columns, order) for row in frame.collect())
    notes = []
    for title, surplus in (("only in Spark", found - wanted), ("only in SQL", wanted - found)):
        if surplus:
            notes.append(f"{sum(surplus.values())} rows {title}, such as {next(iter(surplus))}")
    return notes


def small_session(name: str = "checks", cores: int | str = 8) -> SparkSession:
    spark = build_session(
        name,
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
        master=f"local[{cores}]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(names: list[str]) -> int:
    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = small_session()
    connection = oracle_connection(sf_dir)
    failed = 0
    for name, query in QUERIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            notes = differences(frame, connection, ORACLE[name]) if name in ORACLE else []
            rows = "" if name in ORACLE else f" (no SQL, {frame.count()} rows)"
        except Exception as error:
            notes, rows = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        failed += bool(notes)
        state = "DIFF" if notes else "ok"
        print(f"{state:4} {name} {time.time() - start:.1f}s{rows} {'; '.join(notes)}", flush=True)
    print(f"{failed} of {len(names) or len(QUERIES)} differ")
    return 1 if failed else 0


def _plain(row: tuple, names: list[str], order: list[str]) -> tuple:
    values = dict(zip(names, row, strict=True))
    return tuple(_value(values[name]) for name in order)


def _value(value: object) -> object:
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, Decimal):
        return ("decimal", value)
    if isinstance(value, float):
        return ("float", round(value, 9))
    return value


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
