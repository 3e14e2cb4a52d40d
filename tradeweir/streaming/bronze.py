"""Bronze stream: schema gate -> source -> classify -> append sink."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tradeweir.contracts import BRONZE_15, TableRoles, require_table
from tradeweir.errors import CheckpointEpochError
from tradeweir.operators.quality import TRADE_FIELD_RULES, TRADE_GATES, classify, parse_trades

# Opens the raw records; the argument is where a first start begins, or null on a restart.
OpenSource = Callable[[SparkSession, "str | None"], DataFrame]
FIRST_OFFSETS = "latest"
LABELS = tuple(rule.label for rule in (*TRADE_GATES, *TRADE_FIELD_RULES))
COUNTS = "bronze_labels"


def check_epoch(location: str, retired: Iterable[str] = ()) -> str:
    """Reject exactly the checkpoint paths that earlier epochs have left (T4). Needs no session."""
    if not location:
        raise CheckpointEpochError("a stream needs a checkpoint location")
    if location in set(retired):
        raise CheckpointEpochError(f"{location} belongs to a retired Bronze epoch")
    return location


def start_append(
    frame: DataFrame,
    table: str,
    checkpoint: str,
    *,
    fmt: str = "iceberg",
    name: str | None = None,
    processing_time: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to an existing table (K1).

    ``processing_time`` sets a fixed trigger; left blank, Spark's default applies (T7).
    ``available_now`` takes what is there and ends.
    """
    writer = frame.writeStream.format(fmt).outputMode("append")
    writer = _named(writer.option("checkpointLocation", checkpoint), name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time and processing_time.strip():
        writer = writer.trigger(processingTime=processing_time)
    return writer.toTable(table)


def run_bronze_stream(
    spark: SparkSession,
    open_source: OpenSource,
    table: str,
    checkpoint: str,
    roles: TableRoles,
    *,
    fmt: str = "iceberg",
    retired: Iterable[str] = (),
    first_offsets: str = FIRST_OFFSETS,
    **options,
) -> StreamingQuery:
    """Classify raw records into Bronze, every record once.

    The epoch of the checkpoint, the table's role and its exact schema are checked first and in
    that order (T4, C6, T5); nothing is created or altered, and the source is not opened before all three hold.
    A first start begins at ``first_offsets``; a restart with the same checkpoint goes on where the last run
    ended, whatever the source would begin with (T2, T3). Each batch counts its rows and labels in its
    progress, under ``COUNTS``.
    """
    check_epoch(checkpoint, retired)
    roles.require("bronze", table)
    require_table(spark, table, BRONZE_15)
    records = open_source(spark, None if has_offsets(spark, checkpoint) else first_offsets)
    return start_append(count_labels(classify(records)), table, checkpoint, fmt=fmt, **options)


def has_offsets(spark: SparkSession, checkpoint: str) -> bool:
    """Has a stream with this checkpoint planned a batch before?"""
    try:
        return not spark.read.format("binaryFile").load(f"{checkpoint}/offsets").select("path").isEmpty()
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def count_labels(bronze: DataFrame) -> DataFrame:
    """The same rows; a query over them observes rows, valid rows and rows with each label."""
    each = [F.count_if(F.array_contains("validation_errors", label)).alias(label) for label in LABELS]
    return bronze.observe(COUNTS, F.count("*").alias("rows"), F.count_if("is_valid").alias("valid"), *each)


def start_console(records: DataFrame, name: str | None = None) -> StreamingQuery:
    """Print parsed trades of a stream in full width (K2)."""
    writer = parse_trades(records).writeStream.format("console").outputMode("append")
    return _named(writer.option("truncate", "false"), name).start()


def run_until(query: StreamingQuery, stop: threading.Event, poll_seconds: float = 1.0) -> None:
    """Wait for the query to end by itself or for ``stop``, then stop it.

    The query's own failure is what the caller sees, even if stopping fails as well. Stop the
    session only after this returns.
    """
    failure: BaseException | None = None
    try:
        while not stop.is_set() and not query.awaitTermination(poll_seconds):
            pass
    except BaseException as error:
        failure = error
        raise
    finally:
        try:
            query.stop()
        except Exception as secondary:
            if failure is None:
                raise
            failure.add_note(f"stopping the query failed too: {secondary!r}")


def _named(writer: DataStreamWriter, name: str | None) -> DataStreamWriter:
    return writer if name is None else writer.queryName(name)
