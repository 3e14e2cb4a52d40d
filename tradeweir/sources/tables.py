"""Scans of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A plain scan; how many splits it has is up to ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(path)


def filled_splits(scan: DataFrame) -> int:
    """How many splits of a file scan hold rows: those that a row group falls into. No column is read."""
    return scan.select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
