"""Snapshot-bound copy of Silver to an external serving database over JDBC.

The swap of the external tables is a statement of that database (``EXCHANGE TABLES`` or a rename)
and is left to its own client. Needs the JDBC driver on the class path.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tradeweir.contracts import TableRoles
from tradeweir.errors import PublishError
from tradeweir.plans.publish import CopyReport, LoadReport, checked_source, validate_copy
from tradeweir.sources.jdbc import JdbcTarget, count_copy, equal_ranges, read_copy, replace_staging
from tradeweir.sources.snapshots import read_version


def load_jdbc_staging(
    spark: SparkSession,
    source: str,
    target: JdbcTarget,
    roles: TableRoles,
    *,
    fmt: str = "parquet",
    **tuning: int,
) -> LoadReport:
    """Write the current source snapshot to the external staging table and compare row counts.

    The source is checked completely before a connection is opened.
    """
    snapshot_id, rows, profile = checked_source(spark, source, roles, fmt)
    replace_staging(rows, target, roles.staging, roles, **tuning)
    staged = count_copy(spark, target, roles.staging)
    if staged != profile.row_count:
        raise PublishError(f"staged {staged} rows of {profile.row_count}")
    return LoadReport(source, snapshot_id, profile, roles.staging, staged)


def validate_jdbc_staging(
    spark: SparkSession,
    source: str,
    snapshot_id: int,
    target: JdbcTarget,
    roles: TableRoles,
    *,
    fmt: str = "parquet",
    connections: int = 16,
    range_column: str = "kafka_offset",
) -> CopyReport:
    """Compare the external staging table with one source snapshot, row for row, read over several connections."""
    pinned = read_version(spark, source, snapshot_id, fmt)
    ranges = equal_ranges(pinned, range_column, connections)
    copy = read_copy(spark, target, roles.staging, ranges)
    return validate_copy(spark, source, snapshot_id, copy, fmt)
