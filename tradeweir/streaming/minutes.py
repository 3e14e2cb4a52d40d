"""Per-minute metrics of a Silver stream with late rows (E5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeweir.operators.metrics import notional_volume, trade_count

def minute_metrics(silver: DataFrame, late_by: str = "2 minutes") -> DataFrame:
    """Trades, volume and latest price per symbol and minute.

    A minute is final once the watermark has passed its end; rows of final minutes are late: dropped by
    a stream and kept by a batch. State holds open minutes only.
    """
    newest = F.max(F.struct("event_time", "kafka_partition", "kafka_offset", "price")).alias("newest")
    return (
        silver.withWatermark("event_time", late_by)
        .groupBy("symbol", F.window("event_time", "1 minute").alias("span"))
        .agg(trade_count(), notional_volume(), newest)
        .select(
            "symbol",
            F.col("span.start").alias("minute"),
            "trade_count",
            "notional_volume",
            F.col("newest.price").alias("latest_price"),
        )
    )


def start_minutes(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    late_by: str = "2 minutes",
    *,
    fmt: str = "parquet",
    available_now: bool = False,
) -> StreamingQuery:
    """Append final minutes to a folder. ``observe`` counts the rows that came in, as ``minutes_in``."""
    counted = silver.observe("minutes_in", F.count("*").alias("row_count"))
    writer = minute_metrics(counted, late_by).writeStream.format(fmt).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def open_minutes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The minutes that a stopped stream still holds open, as far as they are known.

    Read from the state that the checkpoint keeps, so no row has to be made up to push the watermark. Nothing is
    changed: a restart goes on with the same minutes. Together with the final minutes these are all rows that were not late.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.symbol").alias("symbol"),
        F.col("key.window.start").alias("minute"),
        F.col("value.count").alias("trade_count"),
        F.col("value.sum").alias("notional_volume"),
        F.col("value.max.price").alias("latest_price"),
    )
