"""Additive migration of Bronze from 13 to 15 columns."""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import SparkSession

from tradeweir.contracts import QUALITY, BronzeState, TableRoles, bronze_state
from tradeweir.errors import ContractError


class MigrationResult(str, Enum):
    MIGRATED = "MIGRATED"
    ALREADY_MIGRATED = "ALREADY_MIGRATED"


@dataclass(frozen=True)
class MigrationReport:
    table: str
    before: BronzeState
    after: BronzeState
    result: MigrationResult


def table_state(spark: SparkSession, table: str, roles: TableRoles) -> BronzeState:
    """State of the Bronze table itself; never changes it."""
    roles.require("bronze", table)
    return bronze_state(spark.table(table).schema)


def add_columns_sql(table: str) -> str:
    return f"ALTER TABLE {table} ADD COLUMNS ({QUALITY.ddl})"


def migrate_bronze(spark: SparkSession, table: str, roles: TableRoles) -> MigrationReport:
    """Add the two quality columns if they are absent. Old rows read null there: not evaluated.

    Metadata only: no row is rewritten. Any other schema is refused before a statement runs.
    """
    before = table_state(spark, table, roles)
    if before is BronzeState.QUALITY:
        return MigrationReport(table, before, before, MigrationResult.ALREADY_MIGRATED)
    if before is BronzeState.INCOMPATIBLE:
        raise ContractError(f"{table} has neither the 13 nor the 15 Bronze columns")
    spark.sql(add_columns_sql(table))
    spark.catalog.refreshTable(table)
    after = table_state(spark, table, roles)
    if after is not BronzeState.QUALITY:
        raise ContractError(f"{table} is {after.value} after the migration")
    return MigrationReport(table, before, after, MigrationResult.MIGRATED)
