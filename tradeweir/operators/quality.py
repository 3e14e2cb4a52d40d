"""Raw record -> Bronze: typed parsing and ordered quality labels.

Classification keeps every row. A rule set has *gates* and *field rules*. The first broken gate
gives its one label and ends the check; behind the gates every broken field rule adds its label,
in declared order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweir.contracts import BRONZE_13, MONEY, QUALITY, TRADE_EVENT
from tradeweir.functions.text import opens_object


@dataclass(frozen=True)
class Rule:
    """``label`` is reported where the SQL condition ``broken`` is true (null counts as false)."""

    label: str
    broken: str


def missing_text(column: str) -> str:
    """Null, empty, or nothing but U+0020 blanks (V1). Tabs and NBSP count as content."""
    return f"length(trim(coalesce({column}, ''))) = 0"


# The eighteen labels in the order they are reported.
TRADE_GATES = (
    Rule("NULL_RAW_JSON", "raw_json IS NULL"),
    Rule("MALFORMED_JSON", "NOT well_formed"),
)
TRADE_FIELD_RULES = (
    Rule("MISSING_EXCHANGE", missing_text("event.exchange")),
    Rule("MISSING_SYMBOL", missing_text("event.symbol")),
    Rule("MISSING_TRADE_ID", missing_text("event.trade_id")),
    Rule("MISSING_PRICE", "event.price IS NULL"),
    Rule("INVALID_PRICE", "event.price IS NOT NULL AND price IS NULL"),
    Rule("NON_POSITIVE_PRICE", "price <= 0"),
    Rule("MISSING_QUANTITY", "event.quantity IS NULL"),
    Rule("INVALID_QUANTITY", "event.quantity IS NOT NULL AND quantity IS NULL"),
    Rule("NON_POSITIVE_QUANTITY", "quantity <= 0"),
    Rule("MISSING_EVENT_TIME", "event.event_time_ms IS NULL"),
    Rule("NON_POSITIVE_EVENT_TIME", "event.event_time_ms <= 0"),
    Rule("MISSING_INGESTED_AT", "event.ingested_at_ms IS NULL"),
    Rule("NON_POSITIVE_INGESTED_AT", "event.ingested_at_ms <= 0"),
    Rule("MISSING_KAFKA_TOPIC", missing_text("kafka_topic")),
    Rule("MISSING_KAFKA_PARTITION", "kafka_partition IS NULL"),
    Rule("MISSING_KAFKA_OFFSET", "kafka_offset IS NULL"),
)


def broken_labels(gates: Sequence[Rule], field_rules: Sequence[Rule]) -> Column:
    """Array of the labels a row earns; empty for a clean row.

    Written without lambdas so that it stays inside generated code.
    """
    checks = [F.when(F.expr(r.broken), F.lit(r.label)).otherwise(F.lit("")) for r in field_rules]
    labels = F.array_remove(F.array(*checks), F.lit(""))
    for gate in reversed(gates):
        labels = F.when(F.expr(gate.broken), F.array(F.lit(gate.label))).otherwise(labels)
    return labels.cast("array<string>")


def kafka_envelope(records: DataFrame) -> DataFrame:
    """Decode key and value as UTF-8 text and prefix the transport columns."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("raw_json"),
    )


def parse_trades(records: DataFrame) -> DataFrame:
    """Typed parse into the 13 Bronze columns (F2). A bad decimal fails the job."""
    parsed = kafka_envelope(records).withColumn("event", F.from_json("raw_json", TRADE_EVENT.ddl))
    money = {name: F.col(f"event.{name}").cast(MONEY) for name in ("price", "quantity")}
    return parsed.select(*_bronze_columns(money))


def classify(records: DataFrame) -> DataFrame:
    """Every raw record with its labels, in the 15 Bronze columns.

    The payload is parsed once. Spark's parser keeps the text of a record it could not fully
    convert in ``bad_text``; a second, schema-free parse decides whether such a record is broken
    JSON or merely has a field of another type, and so runs for those records only. An object
    must open the payload: arrays and scalars are not trade events.
    """
    event = F.from_json(
        "raw_json",
        f"{TRADE_EVENT.ddl}, bad_text STRING",
        {"columnNameOfCorruptRecord": "bad_text"},
    )
    # A filter on the result may be pushed below a projection, which would parse again to
    # evaluate it. Nothing is pushed below a generator, so the parse is emitted by one.
    parsed = kafka_envelope(records).select("*", F.explode(F.array(event)).alias("event"))
    typed = parsed.select(
        "*",
        F.expr(
            f"{opens_object('raw_json')} AND (event.bad_text IS NULL"
            " OR from_json(raw_json, 'MAP<STRING, STRING>') IS NOT NULL)"
        ).alias("well_formed"),
        F.col("event.price").try_cast(MONEY).alias("price"),
        F.col("event.quantity").try_cast(MONEY).alias("quantity"),
    )
    labelled = typed.withColumn(
        "validation_errors", broken_labels(TRADE_GATES, TRADE_FIELD_RULES)
    )
    money = {name: F.col(name) for name in ("price", "quantity")}
    return labelled.select(
        *_bronze_columns(money),
        (F.size("validation_errors") == 0).alias("is_valid"),
        "validation_errors",
    )


def label_counts(bronze: DataFrame) -> DataFrame:
    """How many rows carry each label."""
    return (
        bronze.select(F.explode("validation_errors").alias("label"))
        .groupBy("label")
        .agg(F.count("*").alias("row_count"))
    )


def validity_summary(bronze: DataFrame) -> DataFrame:
    """Rows per validity state: valid, invalid, and not evaluated."""
    state = (
        F.when(F.col("is_valid"), "valid")
        .when(~F.col("is_valid"), "invalid")
        .otherwise("not_evaluated")
    )
    return bronze.groupBy(state.alias("state")).agg(F.count("*").alias("row_count"))


def as_not_evaluated(legacy: DataFrame) -> DataFrame:
    """13-column rows as the migrated table shows them: both quality columns null."""
    BRONZE_13.require(legacy, "legacy rows")
    return legacy.select(
        "*", *[F.lit(None).cast(kind).alias(name) for name, kind in QUALITY.types.items()]
    )


def _bronze_columns(money: dict[str, Column]) -> list[Column]:
    """The 13 columns in contract order: transport as is, the rest from ``event`` or ``money``."""
    sources = {name: F.col(name) for name in BRONZE_13.columns}
    sources |= {name: F.col(f"event.{name}") for name in TRADE_EVENT.columns}
    return [source.alias(name) for name, source in (sources | money).items()]
