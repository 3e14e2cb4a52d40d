"""Proof that files are sorted as they say (K8, P5)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unsorted_files(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Paths of the Parquet files behind ``rows`` that hold a row smaller, by ``key``, than the row before it.

    A scan reads the key columns alone. Its tasks get rows in file order, so neighbours are compared in place and no row is
    shuffled: what leaves a task is a line for each piece of a file, with its first and last key and whether it is in order.
    Pieces of a file that different tasks read are then compared end to end. Nulls come first.
    """
    place = rows.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row"), *key)
    kinds = {f.name: f.dataType.simpleString() for f in place.schema}
    ends = [f"{end}_{c} {kinds[c]}" for end in ("first", "last") for c in key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch) == 0:
                continue
            path = batch.column(0)
            starts = [0, *(i + 1 for i in pc.indices_nonzero(pc.not_equal(path[1:], path[:-1])).to_pylist()), len(batch)]
            pieces = [piece(batch.slice(a, b - a)) for a, b in zip(starts, starts[1:], strict=False)]
            yield pa.RecordBatch.from_pylist(pieces, pa.schema([pa.field(n, t) for n, t in fields(batch)]))

    def fields(batch: pa.RecordBatch) -> list[tuple[str, pa.DataType]]:
        types = [batch.schema.field(c).type for c in key]
        named = [(f"{end}_{c}", t) for end in ("first", "last") for c, t in zip(key, types, strict=True)]
        return [("file_path", pa.string()), ("row", pa.int64()), ("sorted", pa.bool_()), *named]

    def piece(part: pa.RecordBatch) -> dict:
        columns = [part.column(part.schema.get_field_index(c)) for c in key]
        out = {"file_path": part.column(0)[0].as_py(), "row": part.column(1)[0].as_py(), "sorted": in_order(columns)}
        for end, at in (("first", 0), ("last", len(part) - 1)):
            out |= {f"{end}_{c}": column[at].as_py() for c, column in zip(key, columns, strict=True)}
        return out

    def in_order(columns: Sequence[pa.Array]) -> bool:
        """Is every row at least as large as the one before, column by column?"""
        n = len(columns[0]) - 1
        open_, fine = pa.array([True] * n, pa.bool_()), pa.array([True] * n, pa.bool_())
        for column in columns:
            before, after = column[:-1], column[1:]
            equal = pc.or_(pc.fill_null(pc.equal(before, after), False), pc.and_(pc.is_null(before), pc.is_null(after)))
            less = pc.or_(pc.fill_null(pc.less(before, after), False), pc.and_(pc.is_null(before), pc.is_valid(after)))
            fine = pc.and_(fine, pc.or_(pc.invert(open_), pc.or_(less, equal)))
            open_ = pc.and_(open_, equal)
        return bool(pc.all(fine).as_py()) if n else True

    pieces = place.mapInArrow(run, f"file_path string, row long, sorted boolean, {', '.join(ends)}")
    first, last = (F.struct(*[F.col(f"{end}_{c}").alias(c) for c in key]) for end in ("first", "last"))
    before = F.lag(last).over(Window.partitionBy("file_path").orderBy("row"))
    joined = pieces.select("file_path", (F.col("sorted") & F.coalesce(before <= first, F.lit(True))).alias("sorted"))
    return joined.groupBy("file_path").agg(F.min("sorted").alias("sorted")).where("NOT sorted").select("file_path")
