"""Read-only description of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweir.contracts import check_identifier
from tradeweir.errors import PipelineError
from tradeweir.sources.snapshots import history, version_behind

# Metadata tables of an Iceberg table and the order in which they are listed.
ICEBERG_LISTINGS = {
    "snapshots": "committed_at DESC, snapshot_id DESC",
    "history": "made_current_at DESC, snapshot_id DESC",
    "files": "file_path",
    "partitions": "partition",
}


def inspection_sql(table: str, max_rows: int | None = None) -> dict[str, str]:
    """The eleven read-only statements that describe an Iceberg table."""
    check_identifier(table)
    if max_rows is not None and max_rows <= 0:
        raise PipelineError("the number of listed rows must be positive")
    statements = {
        "identity": f"DESCRIBE EXTENDED {table}",
        "schema": f"DESCRIBE {table}",
        "row_count": f"SELECT count(*) AS row_count FROM {table}",
    }
    cut = "" if max_rows is None else f" LIMIT {max_rows}"
    for part, order in ICEBERG_LISTINGS.items():
        # An unpartitioned table lists one row of totals, without a partition column to sort by.
        tail = "" if part == "partitions" else f" ORDER BY {order}"
        statements[f"{part}_count"] = f"SELECT count(*) AS row_count FROM {table}.{part}"
        statements[part] = f"SELECT * FROM {table}.{part}{tail}{cut}"
    return statements


def inspect_table(
    spark: SparkSession,
    table: str,
    fmt: str = "parquet",
    max_rows: int | None = None,
    *,
    rows_per_file: bool = True,
) -> dict[str, DataFrame]:
    """Sections in reading order: identity, schema, row count, snapshots, history, files, partitions.

    Listings are whole unless ``max_rows`` is given, each next to a section with the full count. Without Iceberg
    the files are listed by name and size, and history comes from the version convention, if used. Rows of
    files and partitions are counted by scans that read no data column; ``rows_per_file=False`` leaves the count of each file
    out, and then no row is looked at for them.
    """
    statements = inspection_sql(table, max_rows)
    if fmt == "iceberg":
        sections = {name: spark.sql(text) for name, text in statements.items()}
        listed = sections["partitions"]
        if "partition" in listed.columns:
            sections["partitions"] = _first(
                spark.table(f"{table}.partitions").orderBy("partition"), max_rows
            )
        return sections
    sections = {
        name: spark.sql(statements[name]) for name in ("identity", "schema", "row_count")
    }
    listings = {}
    if spark.catalog.tableExists(f"{table}__history"):
        versions = history(spark, table)
        newest_first = (F.desc("made_current_at"), F.desc("snapshot_id"))
        listings["snapshots"] = (versions.select("snapshot_id", "made_current_at"), newest_first)
        listings["history"] = (versions, newest_first)
    stored = _stored_table(spark, table)
    files = listed_files(spark, stored)
    if rows_per_file:
        counted = spark.table(stored).groupBy("_metadata.file_path").agg(F.count("*").alias("row_count"))
        files = files.join(counted, "file_path", "left").na.fill(0, ["row_count"])
    listings["files"] = (files, (F.asc("file_path"),))
    by = [c.name for c in spark.catalog.listColumns(stored) if c.isPartition]
    if by:
        parts = spark.table(stored).groupBy(*by).agg(F.count("*").alias("row_count"))
        listings["partitions"] = (parts, tuple(F.asc(c) for c in by))
    for name, (frame, order) in listings.items():
        sections[f"{name}_count"] = frame.agg(F.count("*").alias("row_count"))
        sections[name] = _first(frame.orderBy(*order), max_rows)
    return sections


def listed_files(spark: SparkSession, table: str) -> DataFrame:
    """Path, size and partition folder of each data file of a stored table. Files are listed, not opened."""
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {check_identifier(table)}").collect()
    location = next(r.data_type for r in reversed(details) if r.col_name == "Location")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
    found = reader.load(location).select(F.col("path").alias("file_path"), F.col("length").alias("file_size"))
    return found.withColumn("folder", F.regexp_extract("file_path", "/((?:[^/]+=[^/]+/)*)[^/]+$", 1))


def _first(frame: DataFrame, max_rows: int | None) -> DataFrame:
    return frame if max_rows is None else frame.limit(max_rows)


def partition_note(spark: SparkSession, table: str) -> str:
    """``partitioned``, ``unpartitioned``, or ``empty`` for a table without rows."""
    check_identifier(table)
    if not spark.table(table).head(1):
        return "empty"
    columns = spark.catalog.listColumns(_stored_table(spark, table))
    return "partitioned" if any(c.isPartition for c in columns) else "unpartitioned"


def _stored_table(spark: SparkSession, table: str) -> str:
    """The table with the files: behind a versioned name stands its current version."""
    is_view = spark.catalog.getTable(table).tableType == "VIEW"
    return version_behind(spark, table) if is_view else table
