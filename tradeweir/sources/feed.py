"""Deterministic Kafka-shaped feeds derived from the test tables.

Prices, quantities, times and a fixed pattern of broken records come from the rows themselves, so
a feed grows with its table and can be rebuilt in plain SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweir.sources.tables import filled_splits, scan_parquet

TOPIC = "market.trades.raw"

# Rows of one part of a table that is dealt out, so that parts become more and not larger as the table grows.
PART_ROWS = 1 << 20

# Records whose number is divisible by one of these primes are broken in one way;
# the first match wins.
BREAKAGE = {
    "malformed": 97,
    "null_value": 89,
    "bad_price": 83,
    "blank_symbol": 79,
    "no_event_time": 73,
    "negative_price": 71,
}

# Further faults, so that every label and the odd kinds of payload occur.
ALL_BREAKAGE = BREAKAGE | {
    "blank_exchange": 67,
    "no_trade_id": 61,
    "no_price": 59,
    "no_quantity": 53,
    "bad_quantity": 47,
    "zero_event_time": 43,
    "no_ingested_at": 41,
    "negative_ingested_at": 37,
    "null_topic": 31,
    "null_partition": 29,
    "null_offset": 23,
    "array": 101,
    "scalar": 103,
    "empty_object": 107,
    "wrong_type": 109,
    "nested": 113,
    "three_at_once": 127,
}


def event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as unbroken trade columns, one per row, with a running ``record_no``."""
    events = scan_parquet(spark, f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("record_no"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time_ms"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
        "event_type",
        F.col("value").cast("decimal(18,2)").cast("string").alias("price"),
        F.get_json_object("props", "$.k").alias("k"),
    )
    # Odd records get eight more digits, so that products need more than six decimals.
    digits = F.lpad(F.expr("(record_no * 7919) % 100000000").cast("string"), 8, "0")
    quantity = F.when(F.expr("record_no % 2 = 0"), F.col("k")).otherwise(
        F.concat("k", F.lit("."), digits)
    )
    return events.select(
        "record_no",
        F.lit("synth").alias("exchange"),
        F.col("event_type").alias("symbol"),
        F.col("record_no").cast("string").alias("trade_id"),
        "price",
        quantity.alias("quantity"),
        "event_time_ms",
        F.expr("event_time_ms + (record_no * 37) % 500 - 50").alias("ingested_at_ms"),
        "kafka_timestamp",
        F.expr("int(record_no % 4)").alias("kafka_partition"),
        F.expr("record_no div 4").alias("kafka_offset"),
    )


def lineitem_trades(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """``lineitem`` as trade columns: the larger feed, with repeated business keys.

    A table of one row group is one task's scan. ``parts`` deals the rows of a table out first if fewer splits than that
    hold rows, as records that come from many files or partitions would be: over ``parts`` tasks, or more if those would
    get over ``PART_ROWS`` rows each. A table of more splits is scanned in splits of bounded size and not shuffled.

    Rows are dealt by their place in the file, which no value makes uneven and which needs no sort, as a round robin does
    to be repeatable. What is dealt are the numbers; texts are made of them afterwards.
    """
    scan = scan_parquet(spark, f"{sf_dir}/lineitem.parquet")
    items = scan.select(
        "l_orderkey",
        "l_linenumber",
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
        F.col("l_shipdate").cast("timestamp").alias("kafka_timestamp"),
        F.expr("l_partkey % 86400000").alias("ms_of_day"),
        F.expr("l_suppkey % 1000 - 100").alias("delay"),
        F.col("_metadata.row_index").alias("row"),
    )
    if parts is not None and filled_splits(scan) < parts:
        dealt = max(parts, math.ceil(scan.count() / PART_ROWS))
        items = items.withColumn("part", F.expr(f"int(row % {dealt})")).drop("row").repartitionById(dealt, "part")
    return items.select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("record_no"),
        F.lit("bulk").alias("exchange"),
        "symbol",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trade_id"),
        F.col("price").cast("string").alias("price"),
        F.col("quantity").cast("string").alias("quantity"),
        (F.unix_millis("kafka_timestamp") + F.col("ms_of_day")).alias("event_time_ms"),
        (F.unix_millis("kafka_timestamp") + F.expr("ms_of_day + delay")).alias("ingested_at_ms"),
        "kafka_timestamp",
        F.expr("int(l_orderkey % 16)").alias("kafka_partition"),
        F.expr("l_orderkey div 16 * 8 + l_linenumber").alias("kafka_offset"),
    )


def as_kafka_records(trades: DataFrame, breakage: dict[str, int] | None = None) -> DataFrame:
    """Write trade columns as Kafka records, breaking some of them (pass ``{}`` for none)."""
    primes = BREAKAGE if breakage is None else breakage
    fault = F.lit(None).cast("string")
    for name, prime in reversed(primes.items()):
        fault = F.when(F.col("record_no") % prime == 0, F.lit(name)).otherwise(fault)
    faulty = trades.withColumn("fault", fault)
    nothing = F.lit(None)
    fields = {
        "exchange": {"blank_exchange": F.lit("")},
        "symbol": {"blank_symbol": F.lit("   "), "three_at_once": F.lit(" ")},
        "trade_id": {"no_trade_id": nothing},
        "price": {"bad_price": F.lit("not-a-decimal"), "negative_price": F.lit("-1"), "no_price": nothing, "three_at_once": F.lit("0")},
        "quantity": {"no_quantity": nothing, "bad_quantity": F.lit("1,5"), "three_at_once": F.lit("-0.5")},
        "event_time_ms": {"no_event_time": nothing, "zero_event_time": F.lit(0).cast("long")},
        "ingested_at_ms": {"no_ingested_at": nothing, "negative_ingested_at": F.lit(-5).cast("long")},
    }
    body = F.to_json(F.struct(*[_with_faults(primes, F.col(c), own).alias(c) for c, own in fields.items()]))
    # A field of another type and an object in place of a number leave well-formed JSON; arrays and scalars are no trades.
    whole = {
        "malformed": F.lit("{not-json"),
        "null_value": nothing,
        "array": F.concat(F.lit("["), body, F.lit("]")),
        "scalar": F.lit("42"),
        "empty_object": F.lit("{}"),
        "wrong_type": F.regexp_replace(body, '"event_time_ms":[0-9]+', '"event_time_ms":"soon"'),
        "nested": F.regexp_replace(body, '"ingested_at_ms":[0-9]+', '"ingested_at_ms":{"at":1}'),
    }
    transport = {
        "topic": _with_faults(primes, F.lit(TOPIC), {"null_topic": nothing}),
        "partition": _with_faults(primes, F.col("kafka_partition"), {"null_partition": nothing}),
        "offset": _with_faults(primes, F.col("kafka_offset"), {"null_offset": nothing}),
    }
    return faulty.select(
        F.concat_ws(":", "exchange", "symbol").cast("binary").alias("key"),
        _with_faults(primes, body, whole).cast("binary").alias("value"),
        *[value.alias(name) for name, value in transport.items()],
        F.col("kafka_timestamp").alias("timestamp"),
    )


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` feed with its broken records."""
    return as_kafka_records(event_trades(spark, sf_dir))


def bulk_feed(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """The ``lineitem`` feed with its broken records."""
    return as_kafka_records(lineitem_trades(spark, sf_dir, parts))


def fault_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` feed with every kind of fault."""
    return as_kafka_records(event_trades(spark, sf_dir), ALL_BREAKAGE)


def _with_faults(primes: dict[str, int], value: Column, replacements: dict[str, Column]) -> Column:
    """``value``, or what a fault in use puts in its place (null: no fault)."""
    for fault, replacement in replacements.items():
        if fault in primes:
            value = F.when(F.col("fault") == fault, replacement).otherwise(value)
    return value
