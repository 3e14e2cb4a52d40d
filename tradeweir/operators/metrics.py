"""Dashboard metrics over Silver rows.

Volumes are exact decimal sums. The latest price of a context belongs to the greatest
``(event_time, kafka_partition, kafka_offset)``; should two rows share that identity, the higher
price is taken so that the answer never depends on row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweir.contracts import SERVING_PARTITION
from tradeweir.errors import PipelineError
from tradeweir.functions.text import month_key

# Values of one coarse bucket of the exact median: at most 2**20 distinct ones per context.
MEDIAN_BUCKET_BITS = 20


def trade_count() -> Column:
    return F.count("*").alias("trade_count")


def notional_volume() -> Column:
    return F.sum("notional").cast("decimal(38,18)").alias("notional_volume")


def latest_price() -> Column:
    """Aggregate for the latest price of a group (M3)."""
    newest = F.max(F.struct("event_time", "kafka_partition", "kafka_offset", "price"))
    return newest.getField("price").alias("latest_price")


def minute_of(moment: str = "event_time") -> Column:
    return F.date_trunc("minute", moment).alias("minute")


def select_trades(
    silver: DataFrame,
    *,
    symbols: Sequence[str] | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Dashboard filters: a symbol set and the half-open event-time range [start, end) (M9).

    On a frame with the serving partition column the range is also turned into a month range, so
    that Spark can skip partitions. Naive datetimes are UTC.
    """
    if symbols is not None:
        if not symbols:
            raise PipelineError("the symbol filter needs at least one symbol")
        silver = silver.where(F.col("symbol").isin(list(symbols)))
    paged = SERVING_PARTITION in silver.columns
    if start is not None:
        silver = silver.where(F.col("event_time") >= _instant(start))
        if paged:
            silver = silver.where(F.col(SERVING_PARTITION) >= f"{_utc(start):%Y%m}")
    if end is not None:
        silver = silver.where(F.col("event_time") < _instant(end))
        if paged:
            last = _utc(end) - timedelta(microseconds=1)
            silver = silver.where(F.col(SERVING_PARTITION) <= f"{last:%Y%m}")
    return silver


def kpi_row(silver: DataFrame) -> DataFrame:
    """One row: trade count, notional volume, latest price, median latency."""
    return context_kpis(silver, [])


def context_kpis(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The four KPIs of every group of ``keys``.

    Two reads: one for count, volume and latest price, whose groups are reduced before the
    shuffle, and one of ``keys`` and ``latency_ms`` alone for the exact median.
    """
    totals = silver.groupBy(*keys).agg(trade_count(), notional_volume(), latest_price())
    medians = median_latency(silver, keys)
    # Each side has one row per group, so grouping their union joins them: null-safe, without a
    # join, and the same with no keys at all.
    both = totals.unionByName(medians, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in both.columns if c not in keys])


def median_latency(
    silver: DataFrame, keys: Sequence[str], *, approximate: bool = False
) -> DataFrame:
    """Median latency of every group of ``keys`` (M4): exact, or a cheaper approximation."""
    if approximate:
        middle = F.percentile_approx("latency_ms", 0.5).cast("double")
        return silver.groupBy(*keys).agg(middle.alias("median_latency_ms"))
    counted = silver.groupBy(*keys, "latency_ms").agg(F.count("*").alias("n"))
    return weighted_median(counted, keys, "latency_ms", "n").withColumnRenamed(
        "median", "median_latency_ms"
    )


def symbol_latest_price(silver: DataFrame) -> DataFrame:
    """Latest price of each symbol (M3)."""
    return silver.groupBy("symbol").agg(latest_price())


def symbol_comparison(silver: DataFrame) -> DataFrame:
    """Trades and volume of each symbol."""
    return silver.groupBy("symbol").agg(trade_count(), notional_volume())


def trades_per_minute(silver: DataFrame) -> DataFrame:
    """Trades of every minute that has any (M5)."""
    return silver.groupBy(minute_of()).agg(trade_count())


def notional_per_minute(silver: DataFrame) -> DataFrame:
    """Volume of every symbol and minute (M6)."""
    return silver.groupBy("symbol", minute_of()).agg(notional_volume())


def price_over_time(silver: DataFrame) -> DataFrame:
    """Latest price of every symbol and minute (M7)."""
    return silver.groupBy("symbol", minute_of()).agg(latest_price())


def latency_over_time(silver: DataFrame) -> DataFrame:
    """Exact median latency of every minute (M8)."""
    return median_latency(silver.withColumn("minute", minute_of()), ["minute"])


def latency_histogram(silver: DataFrame, width_ms: int = 50) -> DataFrame:
    """Trades per latency bucket ``[bucket_start, bucket_start + width_ms)``, signed (M8)."""
    if width_ms <= 0:
        raise PipelineError("the bucket width must be positive")
    start = F.col("latency_ms") - F.pmod("latency_ms", F.lit(width_ms))
    return silver.groupBy(start.cast("bigint").alias("bucket_start")).agg(trade_count())


def weighted_median(
    counted: DataFrame, keys: Sequence[str], value: str, weight: str
) -> DataFrame:
    """Exact median of ``value`` (BIGINT) per group of ``keys``, given how often each value occurs.

    ``counted`` holds one row per group and value. Values are counted in coarse buckets first; only
    the one or two buckets that hold the middle ranks are then looked at value by value. So a group
    of any size is never held in one place: a window sees its coarse buckets, or one bucket.
    Even-sized groups get the mean of the two middle values. Null values are ignored.
    """
    known = counted.where(F.col(value).isNotNull()).select(
        *keys,
        F.col(value).alias("_value"),
        F.col(weight).alias("_weight"),
        F.shiftright(value, MEDIAN_BUCKET_BITS).alias("_bucket"),
    )
    near_keys = [*[f"_near_{k}" for k in keys], "_near_bucket"]
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    middle = (
        known.groupBy(*keys, "_bucket")
        .agg(F.sum("_weight").alias("_inside"))
        .select(
            "*",
            F.coalesce(F.sum("_inside").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_inside").over(group).alias("_total"),
        )
        # Middle ranks, counted from 0; they are equal in groups of odd size.
        .withColumn("_low", F.expr("(_total - 1) div 2"))
        .withColumn("_high", F.expr("_total div 2"))
        .where("_before <= _high AND _before + _inside > _low")
        .select(
            *[F.col(c).alias(n) for c, n in zip([*keys, "_bucket"], near_keys)],
            "_before",
            "_low",
            "_high",
        )
    )
    # Null-safe equality adds no filter to one side, so both read the same shuffled counts.
    on = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip([*keys, "_bucket"], near_keys)]
    near = known.join(middle, _all(on))
    within = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = near.withColumn("_upto", F.col("_before") + F.sum("_weight").over(within))

    def at(rank: str) -> Column:
        holds = F.expr(f"{rank} >= _upto - _weight AND {rank} < _upto")
        return F.max(F.when(holds, F.col("_value")))

    median = (at("_low") + at("_high")).cast("double") / 2
    return ranked.groupBy(*keys).agg(median.alias("median"))


def with_event_month(silver: DataFrame) -> DataFrame:
    """Add the serving partition column."""
    return silver.withColumn(SERVING_PARTITION, month_key(F.col("event_time")))


def _all(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def _utc(moment: datetime) -> datetime:
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def _instant(moment: datetime) -> Column:
    """A timestamp literal that does not depend on the zone of the driver process."""
    return F.lit(f"{_utc(moment):%Y-%m-%dT%H:%M:%S.%f}Z").cast("timestamp")
