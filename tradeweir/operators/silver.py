"""Bronze -> Silver: valid rows, exact notional, UTC times, signed latency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweir.contracts import BRONZE_15
from tradeweir.functions.money import exact_product, rounded_product

NOTIONAL_MODES = {"exact": exact_product, "reference": rounded_product}


def build_silver(bronze: DataFrame, notional_mode: str = "exact") -> DataFrame:
    """Project the valid rows of a 15-column Bronze frame to the 12 Silver columns.

    Rows with a false or null ``is_valid`` are dropped. Nothing is deduplicated or regrouped, so
    this is a filter and a projection without any shuffle. ``notional_mode`` is ``"exact"``, or
    ``"reference"`` for the product rounded to six decimals.
    """
    BRONZE_15.require_names(bronze, "Bronze input")
    product = NOTIONAL_MODES[notional_mode]
    return bronze.where("is_valid = true").select(
        "exchange",
        "symbol",
        "trade_id",
        "price",
        "quantity",
        product(F.col("price"), F.col("quantity")).alias("notional"),
        F.timestamp_millis("event_time_ms").alias("event_time"),
        F.timestamp_millis("ingested_at_ms").alias("ingested_at"),
        F.expr("ingested_at_ms - event_time_ms").alias("latency_ms"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
    )
