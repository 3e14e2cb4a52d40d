"""JDBC copy of Silver (S5, K5, K9). Options are plain dicts; credentials come from the caller.

A JDBC append is not atomic: a task that is run again after a lost executor may insert its rows
twice. Publishing therefore always compares counts and fingerprints after the write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tradeweir.contracts import SILVER_12, TableRoles, check_identifier
from tradeweir.errors import PipelineError


@dataclass(frozen=True)
class JdbcTarget:
    """Where the copy lives. The password is kept out of ``repr``."""

    url: str
    driver: str
    user: str = field(repr=False)
    password: str = field(repr=False)


def clickhouse_target(
    host: str, port: int, database: str, user: str, password: str
) -> JdbcTarget:
    """A ClickHouse endpoint over HTTP whose sessions run in UTC."""
    check_identifier(database, 1)
    return JdbcTarget(
        url=f"jdbc:clickhouse://{host}:{port}/{database}?session_timezone=UTC",
        driver="com.clickhouse.jdbc.Driver",
        user=user,
        password=password,
    )


def jdbc_options(target: JdbcTarget, table: str) -> dict[str, str]:
    return {
        "url": target.url,
        "dbtable": check_identifier(table),
        "driver": target.driver,
        "user": target.user,
        "password": target.password,
    }


def partitioned_read_options(low: int, high: int, tasks: int) -> dict[str, str]:
    """Even steps of ``kafka_offset`` for a caller who knows its bounds; rows outside of them still come."""
    return {
        "partitionColumn": "kafka_offset",
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(tasks),
    }


def equal_ranges(silver: DataFrame, column: str, tasks: int, error: float = 0.001) -> list[str]:
    """SQL conditions that cut a copy of ``silver`` into ranges of about equally many rows, one for each connection.

    The cuts are quantiles of the pinned source, which the cluster reads in parallel, so gaps and hot stretches of the column
    do not make one connection slow as even steps from least to greatest would. Together the conditions are true of
    every row once; a column with few values gives fewer ranges.
    """
    if tasks < 1:
        raise PipelineError("a scan needs at least one connection")
    check_identifier(column, 1)
    if dict(silver.dtypes).get(column) not in ("int", "bigint"):
        raise PipelineError(f"{column} is no whole number that ranges could be cut on")
    steps = [i / tasks for i in range(1, tasks)]
    cuts = sorted({int(x) for x in silver.approxQuantile(column, steps, error)}) if steps else []
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def count_statement(table: str) -> str:
    """One row that the database counts by itself; no row of the table travels."""
    return f"SELECT COUNT(*) AS row_count FROM {check_identifier(table)}"


def read_copy(
    spark: SparkSession,
    target: JdbcTarget,
    table: str,
    ranges: Sequence[str] | None = None,
) -> DataFrame:
    """Scan the copy, over one connection for each of ``ranges``."""
    options = jdbc_options(target, table)
    if not ranges:
        return spark.read.format("jdbc").options(**options).load()
    login = {k: options[k] for k in ("driver", "user", "password")}
    return spark.read.jdbc(target.url, options["dbtable"], predicates=list(ranges), properties=login)


def count_copy(spark: SparkSession, target: JdbcTarget, table: str) -> int:
    """Rows of the copy, counted by the database."""
    options = jdbc_options(target, table)
    del options["dbtable"]
    return int(spark.read.format("jdbc").options(**options, query=count_statement(table)).load().first()[0])


def append_copy(silver: DataFrame, target: JdbcTarget, table: str, **tuning: int) -> None:
    """Append Silver rows in contract order (K5)."""
    _write(silver, target, table, "append", **tuning)


def replace_staging(
    silver: DataFrame, target: JdbcTarget, table: str, roles: TableRoles, **tuning: int
) -> None:
    """Empty the staging role and write Silver rows to it; the table itself is kept (K9)."""
    _write(silver, target, roles.require("staging", table), "overwrite", truncate=True, **tuning)


def _write(
    silver: DataFrame,
    target: JdbcTarget,
    table: str,
    mode: str,
    *,
    truncate: bool = False,
    batch_rows: int = 50_000,
    connections: int | None = None,
) -> None:
    SILVER_12.require_names(silver, "JDBC input")
    options = {
        **jdbc_options(target, table),
        "batchsize": str(batch_rows),
        **({} if connections is None else {"numPartitions": str(connections)}),
        "truncate": str(truncate).lower(),
    }
    silver.write.format("jdbc").options(**options).mode(mode).save()
