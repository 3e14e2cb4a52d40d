"""Streaming removal of repeated trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tradeweir.errors import PipelineError
from tradeweir.operators.audit import BUSINESS_KEY


def dedup_stream(silver: DataFrame, within: str, keys: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    """The first row of each business key; repeats that come while the key is remembered are dropped.

    A key is remembered until the watermark, the greatest event time so far less ``within``, has passed
    its row by ``within`` again, so state holds the keys of a bounded stretch of time. Rows behind the
    watermark are dropped as late, repeats or not, and a key that comes back after it was forgotten with a later
    event time is a new trade. Both are counted in the progress (:mod:`tradeweir.streaming.progress`). State is
    dealt by the whole key, so a hot symbol spreads over all partitions.
    """
    if not keys:
        raise PipelineError("deduplication needs at least one key column")
    if not silver.isStreaming:
        raise PipelineError("a batch is deduplicated by dedup_by_key")
    return silver.withWatermark("event_time", within).dropDuplicatesWithinWatermark(list(keys))


def start_dedup(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    within: str,
    keys: Sequence[str] = BUSINESS_KEY,
    *,
    fmt: str = "parquet",
    available_now: bool = False,
) -> StreamingQuery:
    """Append the first rows of each key to a folder."""
    writer = dedup_stream(silver, within, keys).writeStream.format(fmt).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
