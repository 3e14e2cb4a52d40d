"""Exchange messages -> trade events -> Kafka records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweir.contracts import TRADE_EVENT
from tradeweir.errors import PipelineError
from tradeweir.functions.text import opens_object

# The exchange's short field names inside "data", and what they are called here.
ENVELOPE_FIELDS = {
    "s": "symbol",
    "t": "trade_id",
    "p": "price",
    "q": "quantity",
    "T": "event_time_ms",
}

_UNICODE_BLANKS = r"(?U)^\s+|\s+$"
_TEXT_FIELDS = ("exchange", "symbol", "trade_id")
_POSITIVE_DECIMALS = ("price", "quantity")
_POSITIVE_MILLIS = ("event_time_ms", "ingested_at_ms")


def normalise_envelope(
    messages: DataFrame,
    text: str = "message",
    ingested_at_ms: str = "ingested_at_ms",
    *,
    exchange: str,
    strict: bool = True,
) -> DataFrame:
    """Captured combined-stream messages as trade event columns.

    ``strict`` fails the job on text that is no object, lacks ``data``, or lacks one of its fields;
    otherwise such values are null.
    """
    # "data" has both a "t" and a "T": map keys tell them apart whatever the session's case rule
    # is, where struct fields would be ambiguous.
    parsed = F.from_json(text, "data MAP<STRING, STRING>").getField("data")
    data = F.when(F.expr(opens_object(text)), parsed)
    opened = messages.select("*", F.explode(F.array(data)).alias("data"))
    present = F.lit(True)
    for short in ENVELOPE_FIELDS:
        present = present & F.col("data").getItem(short).isNotNull()
    fields = []
    for short, name in ENVELOPE_FIELDS.items():
        value = F.col("data").getItem(short)
        if name == "event_time_ms":
            value = value.try_cast("bigint")
        if strict:
            complaint = F.raise_error(F.concat(F.lit("not a trade message: "), F.col(text)))
            value = F.when(present & value.isNotNull(), value).otherwise(complaint)
        fields.append(value.alias(name))
    return opened.select(
        F.lit(exchange).alias("exchange"), *fields, F.col(ingested_at_ms).alias("ingested_at_ms")
    )


def check_events(events: DataFrame, *, strict: bool = False) -> DataFrame:
    """Trade events with stripped text and the names of the fields that break the model (R2).

    Text must hold more than white space (any Unicode kind), decimals and times must be positive.
    ``strict`` fails the job on the first broken event instead of listing ``problems``.
    """
    stripped = events.withColumns(
        {name: F.regexp_replace(name, _UNICODE_BLANKS, "") for name in _TEXT_FIELDS}
    )
    good = {name: F.length(name) > 0 for name in _TEXT_FIELDS}
    good |= {name: F.col(name).try_cast("decimal(38,18)") > 0 for name in _POSITIVE_DECIMALS}
    good |= {name: F.col(name) > 0 for name in _POSITIVE_MILLIS}
    marks = [F.when(good[n], F.lit("")).otherwise(F.lit(n)) for n in TRADE_EVENT.columns]
    checked = stripped.withColumn("problems", F.array_remove(F.array(*marks), F.lit("")))
    if not strict:
        return checked
    complaint = F.raise_error(
        F.concat(F.lit("broken trade event fields: "), F.array_join("problems", ", "))
    )
    kept = [
        F.when(F.size("problems") == 0, F.col(n)).otherwise(complaint).alias(n)
        for n in TRADE_EVENT.columns
    ]
    return checked.select(*kept)


def encode_for_kafka(events: DataFrame) -> DataFrame:
    """Key ``exchange:symbol`` and a JSON value in declared field order.

    Prices and quantities are written as JSON strings: text columns unchanged, decimal columns
    without their padding zeros.
    """
    kinds = dict(events.dtypes)
    fields: list[Column] = []
    for name, kind in TRADE_EVENT.types.items():
        value = F.col(name)
        if kinds[name].startswith("decimal"):
            value = F.regexp_replace(value.cast("string"), r"(\.\d*?)0+$", "$1")
            value = F.regexp_replace(value, r"\.$", "")
        fields.append(value.cast(kind).alias(name))
    return events.select(
        F.concat("exchange", F.lit(":"), "symbol").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def allow_symbols(events: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Keep the listed symbols (R4); an empty list is a configuration error."""
    if not symbols:
        raise PipelineError("the symbol list needs at least one symbol")
    return events.where(F.col("symbol").isin(list(symbols)))


def stamp_arrival(messages: DataFrame) -> DataFrame:
    """Add the arrival time in epoch milliseconds, one value per batch or micro-batch."""
    return messages.withColumn("ingested_at_ms", F.unix_millis(F.current_timestamp()))
