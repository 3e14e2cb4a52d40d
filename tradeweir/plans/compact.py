"""Rewrite many small files as few large ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tradeweir.contracts import check_identifier
from tradeweir.errors import PipelineError
from tradeweir.plans.inspect import listed_files
from tradeweir.sources.snapshots import (
    commit_version,
    current_snapshot,
    make_current,
    read_version,
    version_table,
    write_version,
)

TARGET_BYTES = 256 << 20


def compaction_plan(spark: SparkSession, stored: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Per folder of a stored table: files, bytes, and how many files of ``target_bytes`` would hold them.

    Sizes come from the file listing; nothing is read.
    """
    if target_bytes <= 0:
        raise PipelineError("the target size of files must be positive")
    wanted = F.greatest(F.lit(1), F.ceil(F.sum("file_size") / target_bytes)).cast("int")
    per_folder = listed_files(spark, stored).groupBy("folder").agg(
        F.count("*").alias("files"), F.sum("file_size").alias("bytes"), wanted.alias("target_files")
    )
    return per_folder.withColumn("small", F.col("files") > F.col("target_files"))


def compact(
    spark: SparkSession,
    table: str,
    fmt: str = "parquet",
    *,
    target_bytes: int = TARGET_BYTES,
    sort_by: Sequence[str] = (),
) -> int:
    """Commit the current version of ``table`` again in files of about ``target_bytes``; returns the new id.

    Partitioning is kept, and rows are sorted by ``sort_by`` inside each file. A table whose folders hold no more files than
    they need is left alone, and its present id is returned. Versions never change, so a rewrite is of the
    whole table. A folder of any size is dealt out over its files by row, so a hot partition is many tasks.

    Rows in another order take other space, often less, so that a rewrite may need fewer files than the bytes before it told. It
    is then rewritten in turn, until its own bytes need its files; only the last rewrite becomes current, the others are dropped.
    """
    current = current_snapshot(spark, table, fmt)
    rows = read_version(spark, table, current, fmt)
    if fmt != "parquet":
        return commit_version(rows.hint("rebalance"), table, fmt)
    by = [c.name for c in spark.catalog.listColumns(version_table(check_identifier(table), current)) if c.isPartition]
    newest, found = current, _whole(spark, version_table(table, current), target_bytes)
    fewer = True
    while found.small and fewer:
        spread = _spread(spark, version_table(table, newest), target_bytes, found.target_files, by, sort_by)
        try:
            rewritten = write_version(spread, table, fmt, partition_by=by)
        finally:
            if newest != current:
                spark.sql(f"DROP TABLE {version_table(table, newest)}")
        before, newest, found = found, rewritten, _whole(spark, version_table(table, rewritten), target_bytes)
        # A session that bounds the rows of a file gets no fewer files, however often they are written.
        fewer = found.files < before.files
    if newest != current:
        make_current(spark, table, newest, rows.columns, fmt)
    return newest


def _whole(spark: SparkSession, stored: str, target_bytes: int) -> Row:
    """All folders of a plan as one row: is one small, and how many files there are and should be."""
    plan = compaction_plan(spark, stored, target_bytes)
    return plan.agg(F.max("small").alias("small"), *[F.sum(c).alias(c) for c in ("files", "target_files")]).first()


def _spread(
    spark: SparkSession, stored: str, target_bytes: int, files: int, by: Sequence[str], sort_by: Sequence[str]
) -> DataFrame:
    """Rows of a stored table with a task for each of the files that its folders need, sorted as they are to be written."""
    rows = spark.table(stored)
    if by:
        # The folders' files are numbered through, so that no two of them share a task.
        ahead = Window.orderBy("folder").rowsBetween(Window.unboundedPreceding, -1)
        numbered = compaction_plan(spark, stored, target_bytes).select(
            F.col("folder").alias("_folder"), "target_files", F.coalesce(F.sum("target_files").over(ahead), F.lit(0)).alias("_first")
        )
        folder = F.concat(*[p for c in by for p in (F.lit(f"{c}="), F.col(c).cast("string"), F.lit("/"))])
        row = F.xxhash64(*[c for c in rows.columns if c not in by])
        listed = F.col("_first") + F.pmod(row, F.col("target_files").cast("long"))
        number = F.coalesce(listed, F.pmod(F.xxhash64(*by), F.lit(files).cast("long"))).cast("int")
        sized = rows.withColumn("_folder", folder).join(F.broadcast(numbered), "_folder", "left").withColumn("_file", number)
        spread = sized.repartitionById(int(files), "_file").select(*rows.columns)
    elif sort_by:
        spread = rows.repartitionByRange(int(files), *sort_by)
    else:
        spread = rows.repartition(int(files))
    return spread.sortWithinPartitions(*by, *sort_by) if by or sort_by else spread
