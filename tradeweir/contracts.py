"""Table contracts, identifier and role guards.

A contract is an ordered list of column names and types. Nullability is never part of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, fields
from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tradeweir.errors import ContractError, IdentifierError, RoleError

MONEY = "decimal(38,18)"
DATA_TYPES = {
    "string": StringType(),
    "binary": BinaryType(),
    "boolean": BooleanType(),
    "int": IntegerType(),
    "bigint": LongType(),
    MONEY: DecimalType(38, 18),
    "timestamp": TimestampType(),
    "array<string>": ArrayType(StringType()),
}


@dataclass(frozen=True)
class Contract:
    """Named, ordered columns that a frame or a table has to match exactly."""

    name: str
    types: dict[str, str]

    @property
    def columns(self) -> list[str]:
        return list(self.types)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.types.items())

    @property
    def schema(self) -> StructType:
        return StructType([StructField(n, DATA_TYPES[kind]) for n, kind in self.types.items()])

    def matches(self, schema: StructType) -> bool:
        return _shape(schema) == list(self.types.items())

    def require(self, frame: DataFrame, what: str = "frame") -> DataFrame:
        """Return ``frame`` unchanged, or say which columns are wrong."""
        if not self.matches(frame.schema):
            difference = _difference(_shape(frame.schema), list(self.types.items()))
            raise ContractError(f"{what} breaks contract {self.name}: {difference}")
        return frame

    def require_names(self, frame: DataFrame, what: str = "frame") -> DataFrame:
        """Like :meth:`require`, for names and their order only."""
        if frame.columns != self.columns:
            raise ContractError(
                f"{what} breaks contract {self.name}: "
                f"columns are {frame.columns}, expected {self.columns}"
            )
        return frame


# Column names, order and types of the data model.
KAFKA_RECORD = Contract(
    "KAFKA_RECORD",
    {
        "key": "binary",
        "value": "binary",
        "topic": "string",
        "partition": "int",
        "offset": "bigint",
        "timestamp": "timestamp",
    },
)
TRADE_EVENT = Contract(
    "TRADE_EVENT",
    {
        "exchange": "string",
        "symbol": "string",
        "trade_id": "string",
        "price": "string",
        "quantity": "string",
        "event_time_ms": "bigint",
        "ingested_at_ms": "bigint",
    },
)
BRONZE_13 = Contract(
    "BRONZE_13",
    {
        "exchange": "string",
        "symbol": "string",
        "trade_id": "string",
        "price": MONEY,
        "quantity": MONEY,
        "event_time_ms": "bigint",
        "ingested_at_ms": "bigint",
        "kafka_key": "string",
        "kafka_topic": "string",
        "kafka_partition": "int",
        "kafka_offset": "bigint",
        "kafka_timestamp": "timestamp",
        "raw_json": "string",
    },
)
QUALITY = Contract("QUALITY", {"is_valid": "boolean", "validation_errors": "array<string>"})
BRONZE_15 = Contract("BRONZE_15", BRONZE_13.types | QUALITY.types)
SILVER_12 = Contract(
    "SILVER_12",
    {
        "exchange": "string",
        "symbol": "string",
        "trade_id": "string",
        "price": MONEY,
        "quantity": MONEY,
        "notional": MONEY,
        "event_time": "timestamp",
        "ingested_at": "timestamp",
        "latency_ms": "bigint",
        "kafka_topic": "string",
        "kafka_partition": "int",
        "kafka_offset": "bigint",
    },
)
# Sort key of the serving copy. It clusters rows; it does not make them unique.
SERVING_SORT_KEY = (
    "exchange",
    "symbol",
    "event_time",
    "trade_id",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
)
SERVING_PARTITION = "event_month"


class BronzeState(str, Enum):
    """Where a Bronze table stands on the way from 13 to 15 columns."""

    LEGACY = "LEGACY_13_COLUMN"
    QUALITY = "QUALITY_15_COLUMN"
    INCOMPATIBLE = "INCOMPATIBLE"


def bronze_state(schema: StructType) -> BronzeState:
    if BRONZE_13.matches(schema):
        return BronzeState.LEGACY
    if BRONZE_15.matches(schema):
        return BronzeState.QUALITY
    return BronzeState.INCOMPATIBLE


@dataclass(frozen=True)
class TableRoles:
    """Which table each job may touch (C6). Override the names per deployment."""

    bronze: str = "trades.bronze"
    silver: str = "trades.silver"
    smoke: str = "trades.bronze_smoke"
    serving: str = "trades.serving"
    staging: str = "trades.serving_staging"

    def __post_init__(self) -> None:
        names = [check_identifier(getattr(self, f.name)) for f in fields(self)]
        if len(set(names)) != len(names):
            raise RoleError(f"every role needs a table of its own: {names}")

    def require(self, role: str, table: str) -> str:
        """Return ``table`` if it plays ``role``; reject it before any SQL runs."""
        allowed = getattr(self, role)
        if check_identifier(table) != allowed:
            raise RoleError(f"the {role} role belongs to {allowed}, not to {table}")
        return table


def check_identifier(name: str, max_parts: int = 3) -> str:
    """Accept one to ``max_parts`` dotted words of letters, digits and underscores."""
    parts = name.split(".")
    if len(parts) > max_parts or not all(re.fullmatch(r"[^\W\d]\w*", part) for part in parts):
        raise IdentifierError(
            f"{name!r} is not a plain identifier of one to {max_parts} dotted words"
        )
    return name


def create_table_sql(
    table: str,
    contract: Contract,
    fmt: str = "parquet",
    *,
    partition: str | None = None,
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a contract (K6); ``partition`` adds one STRING column."""
    columns = [contract.ddl]
    tail = ""
    if partition is not None:
        columns.append(f"{check_identifier(partition, 1)} string")
        tail = f" PARTITIONED BY ({partition})"
    return (
        f"CREATE TABLE IF NOT EXISTS {check_identifier(table)} "
        f"({', '.join(columns)}) USING {check_identifier(fmt, 1)}{tail}"
    )


def ensure_table(
    spark: SparkSession, table: str, contract: Contract, fmt: str = "parquet"
) -> DataFrame:
    """Create namespace and table if absent, then insist on the contract."""
    namespace = check_identifier(table).rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    spark.sql(create_table_sql(table, contract, fmt))
    return require_table(spark, table, contract)


def require_table(spark: SparkSession, table: str, contract: Contract) -> DataFrame:
    """Scan an existing table that has to match ``contract``."""
    check_identifier(table)
    if not spark.catalog.tableExists(table):
        raise ContractError(f"table {table} does not exist")
    return contract.require(spark.table(table), f"table {table}")


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def _difference(have: list[tuple[str, str]], want: list[tuple[str, str]]) -> str:
    lost = _words(pair for pair in want if pair not in have)
    extra = _words(pair for pair in have if pair not in want)
    if not lost and not extra:
        return "column order differs"
    return f"missing or retyped [{lost}], unexpected [{extra}]"


def _words(pairs: Iterable[tuple[str, str]]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in pairs)
