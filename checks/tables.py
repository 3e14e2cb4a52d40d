"""Bronze and Silver tables of a feed, written once per session as a deployment would have them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeweir.contracts import BRONZE_15, SILVER_12
from tradeweir.operators.quality import classify
from tradeweir.operators.silver import build_silver
from tradeweir.session import require_runtime, scratch_folder
from tradeweir.sources.feed import bulk_feed, raw_feed
from tradeweir.sources.kafka import file_batch

# Parts of the larger feed, as an archive has many files, unless its table is scanned in at least as many splits.
FILES = 8
FEEDS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "events": raw_feed,
    "lineitem": lambda spark, sf_dir: bulk_feed(spark, sf_dir, FILES),
}
_written: dict[tuple, str] = {}


def records(spark: SparkSession, sf_dir: str, feed: str = "events") -> DataFrame:
    """Raw Kafka records of a feed, computed from its table."""
    return FEEDS[feed](require_runtime(spark), sf_dir)


def stored_records(spark: SparkSession, sf_dir: str, feed: str = "events") -> DataFrame:
    """Raw Kafka records of a feed as an archive on disk."""
    path = _stored(spark, ("records", sf_dir, feed), lambda: records(spark, sf_dir, feed))
    return file_batch(spark, path)


def bronze(spark: SparkSession, sf_dir: str, feed: str = "events") -> DataFrame:
    path = _stored(spark, ("bronze", sf_dir, feed), lambda: classify(records(spark, sf_dir, feed)))
    return spark.read.schema(BRONZE_15.schema).parquet(path)


def silver_rows(spark: SparkSession, sf_dir: str, feed: str = "events") -> DataFrame:
    """Silver rows of a feed for a query that stores them itself: classified on the way, unless they are stored already."""
    if (spark.sparkContext.applicationId, "silver", sf_dir, feed, "exact") in _written:
        return silver(spark, sf_dir, feed)
    return build_silver(classify(records(spark, sf_dir, feed)))


def silver(
    spark: SparkSession, sf_dir: str, feed: str = "events", mode: str = "exact"
) -> DataFrame:
    path = _stored(
        spark,
        ("silver", sf_dir, feed, mode),
        lambda: build_silver(bronze(spark, sf_dir, feed), mode),
    )
    return spark.read.schema(SILVER_12.schema).parquet(path)


def _stored(spark: SparkSession, what: tuple, build: Callable[[], DataFrame]) -> str:
    require_runtime(spark)
    key = (spark.sparkContext.applicationId, *what)
    if key not in _written:
        path = scratch_folder(spark, what[0])
        build().write.parquet(path)
        _written[key] = path
    return _written[key]
