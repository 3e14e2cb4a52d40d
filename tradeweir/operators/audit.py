"""Follow-up checks on Bronze and Silver rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeweir.errors import PipelineError

BUSINESS_KEY = ("exchange", "symbol", "trade_id")
# 2**13 offsets share a bucket, and as many buckets share a block. Distinct offsets of a bucket are
# held together and the buckets of a block meet in one window, so this bounds both.
OFFSET_BUCKET_BITS = 13


def quarantine(bronze: DataFrame) -> DataFrame:
    """The rows found invalid, with all audit columns (E1). Unevaluated rows are not invalid."""
    return bronze.where("is_valid = false")


def dedup_by_key(silver: DataFrame, keys: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    """One row per business key: the earliest, by event time and transport position.

    Opt-in; no core step drops duplicates. A grouped minimum reduces repeated keys before the
    shuffle, so a key that repeats without end costs no more than any other.
    """
    if not keys:
        raise PipelineError("deduplication needs at least one key column")
    order = ["event_time", "kafka_topic", "kafka_partition", "kafka_offset"]
    rest = [c for c in silver.columns if c not in order and c not in keys]
    first = F.min(F.struct(*[c for c in order if c not in keys], *rest)).alias("first")
    picked = silver.groupBy(*keys).agg(first)
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"first.{c}").alias(c) for c in silver.columns]
    )


def offset_gaps(rows: DataFrame) -> DataFrame:
    """Missing offset ranges between the first and last offset of each topic partition.

    Offsets are collected in buckets of fixed width, mostly before the shuffle because a Kafka
    partition is read in order. Gaps inside a bucket are found in place. The ends of neighbouring
    buckets are compared within blocks of buckets, and then the ends of neighbouring blocks, so
    that no window has to see a whole Kafka partition.
    """
    at = ["kafka_topic", "kafka_partition"]
    buckets = (
        rows.where(F.col("kafka_offset").isNotNull())
        .groupBy(*at, F.shiftright("kafka_offset", OFFSET_BUCKET_BITS).alias("bucket"))
        .agg(F.sort_array(F.collect_set("kafka_offset")).alias("seen"))
    )
    neighbours = F.arrays_zip(
        F.expr("slice(seen, 1, size(seen) - 1)").alias("after"),
        F.expr("slice(seen, 2, size(seen))").alias("until"),
    )
    inside = buckets.select(*at, F.inline(neighbours).alias("after", "until"))
    ends = buckets.select(
        *at,
        "bucket",
        F.shiftright("bucket", OFFSET_BUCKET_BITS).alias("block"),
        F.element_at("seen", 1).alias("first"),
        F.element_at("seen", -1).alias("last"),
    )
    blocks = ends.groupBy(*at, "block").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    )
    gaps = inside.union(_steps(ends, [*at, "block"], "bucket")).union(_steps(blocks, at, "block"))
    return gaps.where("until > after + 1").select(
        *at,
        F.expr("after + 1").alias("first_missing"),
        F.expr("until - 1").alias("last_missing"),
        F.expr("until - after - 1").alias("missing"),
    )


def _steps(ranges: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """From the end of each range to the start of the next one in its group."""
    before = F.lag("last").over(Window.partitionBy(*group).orderBy(order))
    return ranges.select(
        "kafka_topic", "kafka_partition", before.alias("after"), F.col("first").alias("until")
    )


def freshness(silver: DataFrame, now: datetime | None = None) -> DataFrame:
    """Newest event per symbol and its age in milliseconds at ``now``, a UTC moment, or at query time."""
    at = F.current_timestamp() if now is None else F.lit(f"{now:%Y-%m-%dT%H:%M:%S.%f}Z").cast("timestamp")
    age = F.unix_millis(at) - F.unix_millis(F.max("event_time"))
    return silver.groupBy("symbol").agg(
        F.max("event_time").alias("newest_event"), age.alias("age_ms")
    )
