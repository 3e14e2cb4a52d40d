"""Immutable versions of a table and reads pinned to one of them.

With ``fmt="iceberg"`` the table format keeps the versions itself. Elsewhere a plain convention
does it: version ``n`` of ``db.t`` is the table ``db.t__v<n>``, ``db.t__history`` lists the
versions, and ``db.t`` is a view on the current one. A commit writes the version first, its history
row second and the view last, so a crash in between leaves readers on the old version.

The Iceberg branch needs the connector on the class path and cannot be tested without it.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweir.contracts import check_identifier
from tradeweir.errors import SnapshotError

HISTORY_DDL = "snapshot_id BIGINT, made_current_at TIMESTAMP, is_current_ancestor BOOLEAN"
VERSION_PROPERTY = "tradeweir.version"
# Files of a version are written once and kept: a quarter to a third smaller than with Parquet's usual Snappy. Row groups
# are half as large, as they would hold more rows; a task of a later scan gets whole row groups.
WRITE_OPTIONS = {"parquet": {"compression": "zstd", "parquet.block.size": str(64 << 20)}}


def version_table(table: str, snapshot_id: int) -> str:
    return f"{table}__v{snapshot_id}"


def history(spark: SparkSession, table: str, fmt: str = "parquet") -> DataFrame:
    """The versions ever made current."""
    check_identifier(table)
    return spark.table(f"{table}.history" if fmt == "iceberg" else f"{table}__history")


def commit_version(
    frame: DataFrame,
    table: str,
    fmt: str = "parquet",
    *,
    partition_by: Sequence[str] = (),
) -> int:
    """Store ``frame`` as the new current version of ``table`` and return its id."""
    spark = frame.sparkSession
    check_identifier(table)
    if fmt == "iceberg":
        writer = frame.writeTo(table).using("iceberg")
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()
        return current_snapshot(spark, table, fmt)
    snapshot_id = write_version(frame, table, fmt, partition_by=partition_by)
    make_current(spark, table, snapshot_id, frame.columns, fmt)
    return snapshot_id


def make_current(
    spark: SparkSession, table: str, snapshot_id: int, columns: Sequence[str], fmt: str = "parquet"
) -> None:
    """Enter a written version into the history of ``table`` and show it."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {check_identifier(table)}__history ({HISTORY_DDL}) USING {fmt}"
    )
    spark.range(1).select(
        F.lit(snapshot_id).alias("snapshot_id"),
        F.current_timestamp().alias("made_current_at"),
        F.lit(True).alias("is_current_ancestor"),
    ).write.insertInto(f"{table}__history")
    point_view(spark, table, version_table(table, snapshot_id), columns)


def write_version(
    frame: DataFrame, table: str, fmt: str = "parquet", *, partition_by: Sequence[str] = ()
) -> int:
    """Write one immutable version table without making it current.

    Ids are microseconds of the clock; a second writer with the same id fails on the table name.
    """
    snapshot_id = time.time_ns() // 1000
    writer = frame.write.format(fmt).options(**WRITE_OPTIONS.get(fmt, {})).partitionBy(*partition_by)
    writer.mode("errorifexists").saveAsTable(version_table(check_identifier(table), snapshot_id))
    return snapshot_id


def point_view(
    spark: SparkSession, view: str, target: str, columns: Sequence[str]
) -> None:
    """Make ``view`` show ``target``: one DDL statement, so readers see the old or the new table."""
    check_identifier(view)
    check_identifier(target)
    picked = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{VERSION_PROPERTY}' = '{target}') "
        f"AS SELECT {picked} FROM {target}"
    )


def version_behind(spark: SparkSession, view: str) -> str:
    """The version table a view shows at this moment."""
    target = table_property(spark, view, VERSION_PROPERTY)
    if target is None:
        raise SnapshotError(f"{view} does not show a version table")
    return target


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {check_identifier(table)}").collect()
    return next((r.value for r in rows if r.key == key), None)


def current_snapshot(spark: SparkSession, table: str, fmt: str = "parquet") -> int:
    """Id of the newest version on the current line of ``table`` (S3)."""
    try:
        newest = (
            history(spark, table, fmt)
            .where("is_current_ancestor")
            .orderBy(F.desc("made_current_at"), F.desc("snapshot_id"))
            .select("snapshot_id")
            .first()
        )
    except Exception as cause:
        raise SnapshotError(f"no history can be read for {table}") from cause
    if newest is None:
        raise SnapshotError(f"{table} has no current snapshot")
    return check_snapshot_id(newest.snapshot_id)


def read_version(
    spark: SparkSession, table: str, snapshot_id: int, fmt: str = "parquet"
) -> DataFrame:
    """Exactly the rows of one version, whatever is current."""
    check_identifier(table)
    check_snapshot_id(snapshot_id)
    try:
        if fmt == "iceberg":
            return spark.read.format(fmt).option("versionAsOf", snapshot_id).load(table)
        return spark.table(version_table(table, snapshot_id))
    except Exception as cause:
        raise SnapshotError(f"snapshot {snapshot_id} of {table} cannot be read") from cause


def check_snapshot_id(value: object) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise SnapshotError(f"{value!r} is not a positive snapshot id")
    return value


