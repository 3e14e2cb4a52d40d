"""Literal rows used by several tests."""

import json
from datetime import datetime, timezone
from decimal import Decimal

from tradeweir.contracts import BRONZE_15, KAFKA_RECORD, SILVER_12

EVENT = {
    "exchange": "northex",
    "symbol": "ACMEUR",
    "trade_id": "7001",
    "price": "417.25",
    "quantity": "2.75",
    "event_time_ms": 1718000000250,
    "ingested_at_ms": 1718000000700,
}
RECORD = {
    "key": b"northex:ACMEUR",
    "topic": "market.trades.raw",
    "partition": 5,
    "offset": 9001,
    "timestamp": datetime(2024, 6, 10, 8, 30, tzinfo=timezone.utc),
}
NOON = datetime(2026, 1, 1, tzinfo=timezone.utc)
SILVER = {
    "exchange": "northex",
    "symbol": "ACMEUR",
    "trade_id": "1",
    "price": Decimal(2),
    "quantity": Decimal(3),
    "notional": Decimal(6),
    "event_time": NOON,
    "ingested_at": NOON,
    "latency_ms": -1000,
    "kafka_topic": "market.trades.raw",
    "kafka_partition": 0,
    "kafka_offset": 1,
}


def event_json(**changes):
    return json.dumps({**EVENT, **changes})


def kafka_rows(spark, *changes):
    """One Kafka record per dict of changes; ``value`` may be text, bytes or None."""
    rows = []
    for change in changes:
        row = {"value": event_json(), **RECORD, **change}
        if isinstance(row["value"], str):
            row["value"] = row["value"].encode()
        rows.append(tuple(row[c] for c in KAFKA_RECORD.columns))
    return spark.createDataFrame(rows, KAFKA_RECORD.schema)


def silver_rows(spark, *changes):
    rows = [tuple({**SILVER, **change}[c] for c in SILVER_12.columns) for change in changes]
    return spark.createDataFrame(rows, SILVER_12.schema)


def bronze_rows(spark, *changes):
    base = {
        "exchange": "northex",
        "symbol": "ACMEUR",
        "trade_id": "0",
        "price": Decimal("2.5"),
        "quantity": Decimal(4),
        "event_time_ms": 1000,
        "ingested_at_ms": 2500,
        "kafka_key": "northex:ACMEUR",
        "kafka_topic": "market.trades.raw",
        "kafka_partition": 0,
        "kafka_offset": 1,
        "kafka_timestamp": NOON,
        "raw_json": "{}",
        "is_valid": True,
        "validation_errors": [],
    }
    rows = [tuple({**base, **change}[c] for c in BRONZE_15.columns) for change in changes]
    return spark.createDataFrame(rows, BRONZE_15.schema)
