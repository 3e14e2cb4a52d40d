"""Kafka-shaped records, as a stream or a batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tradeweir.contracts import KAFKA_RECORD


def kafka_options(
    bootstrap_servers: str, topic: str, starting_offsets: str | None = None
) -> dict[str, str]:
    """Subscribe to one topic. Without ``starting_offsets`` the connector's default applies."""
    options = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic}
    if starting_offsets is not None:
        options["startingOffsets"] = starting_offsets
    return options


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw records of a topic as a stream. Needs the Spark Kafka connector on the class path.

    ``extra`` takes further connector options such as ``maxOffsetsPerTrigger`` or
    ``minPartitions``, which splits a hot Kafka partition over several tasks.
    """
    options = kafka_options(bootstrap_servers, topic, starting_offsets)
    return spark.readStream.format("kafka").options(**options, **(extra or {})).load()


def kafka_source(
    bootstrap_servers: str, topic: str, extra: Mapping[str, str] | None = None
) -> Callable[[SparkSession, str | None], DataFrame]:
    """How a stream job opens a topic once its gates have passed."""
    return lambda spark, starting: kafka_stream(spark, bootstrap_servers, topic, starting, extra)


def file_source(path: str, fmt: str = "parquet") -> Callable[[SparkSession, str | None], DataFrame]:
    """How a stream job opens a folder of archived records, all of which it takes."""
    return lambda spark, starting: file_stream(spark, path, fmt)


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Archived Kafka records in a folder as a stream: each file is taken up once."""
    reader = spark.readStream.format(fmt).schema(KAFKA_RECORD.schema)
    return reader.options(**(options or {})).load(path)


def file_batch(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Archived Kafka records in a folder as a batch."""
    return spark.read.format(fmt).schema(KAFKA_RECORD.schema).load(path)


def static_records(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """A handful of literal Kafka records, for tests and replays by hand."""
    return spark.createDataFrame(rows, KAFKA_RECORD.schema)
