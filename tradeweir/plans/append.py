"""Batch append of classified rows to the isolated quality table (K3, K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeweir.contracts import BRONZE_15, TableRoles, ensure_table, require_table


def ensure_smoke_table(
    spark: SparkSession, table: str, roles: TableRoles, fmt: str = "parquet"
) -> None:
    """Create the isolated 15-column table if absent and insist on its schema."""
    ensure_table(spark, roles.require("smoke", table), BRONZE_15, fmt)


def append_classified(classified: DataFrame, table: str, roles: TableRoles) -> None:
    """Append after three checks: the table's role, the frame's contract, the table's contract."""
    roles.require("smoke", table)
    BRONZE_15.require(classified, "classified frame")
    require_table(classified.sparkSession, table, BRONZE_15)
    classified.write.insertInto(table)
