"""Counts that describe a dataset: nulls, rows, symbols, differences."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweir.contracts import SILVER_12
from tradeweir.errors import CopyMismatchError, NullsFoundError, PipelineError



def null_counts(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of nulls in every column, in one aggregate (A1)."""
    return frame.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns or frame.columns]
    )


def rows_per_symbol(frame: DataFrame) -> DataFrame:
    """Rows of each symbol, by symbol (A3, O2)."""
    return frame.groupBy("symbol").agg(F.count("*").alias("row_count")).orderBy("symbol")


def row_and_symbol_counts(frame: DataFrame) -> DataFrame:
    """One row: total rows and exact distinct symbols (A2, A4), from one small grouping."""
    per_symbol = frame.groupBy("symbol").agg(F.count("*").alias("n"))
    return per_symbol.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count("*").alias("distinct_symbols"),
    )


@dataclass(frozen=True)
class SourceProfile:
    """What one pinned dataset holds. Only ``shown`` is cut to a display cap; nothing else is."""

    row_count: int
    distinct_symbols: int
    null_counts: dict[str, int]
    shown: tuple[tuple[str, int], ...]
    omitted_symbols: int

    def require_no_nulls(self) -> SourceProfile:
        _refuse_nulls(self.null_counts)
        return self


def symbol_profile(frame: DataFrame) -> DataFrame:
    """Per symbol: rows and nulls of each Silver column. The base of every other count here."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in SILVER_12.columns]
    return frame.groupBy("symbol").agg(F.count("*").alias("row_count"), *nulls)


def source_profile(frame: DataFrame, shown_symbols: int | None = None) -> SourceProfile:
    """Nulls, rows and symbols of a Silver-shaped frame from one scan of it.

    All symbols are listed, or the first ``shown_symbols`` if the caller wants a short report.
    """
    if shown_symbols is not None and shown_symbols <= 0:
        raise PipelineError("the number of symbols to show must be positive")
    SILVER_12.require(frame, "profiled frame")
    per_symbol = symbol_profile(frame).persist()  # one row per symbol
    try:
        sums = [
            F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(c) for c in SILVER_12.columns
        ]
        totals = per_symbol.agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
            F.count("*").alias("symbols"),
            *sums,
        ).first()
        head = per_symbol.orderBy("symbol").select("symbol", "row_count")
        head = head if shown_symbols is None else head.limit(shown_symbols)
        shown = tuple((r.symbol, r.row_count) for r in head.collect())
    finally:
        per_symbol.unpersist()
    return SourceProfile(
        row_count=totals["rows"],
        distinct_symbols=totals["symbols"],
        null_counts={c: totals[c] for c in SILVER_12.columns},
        shown=shown,
        omitted_symbols=totals["symbols"] - len(shown),
    )


def count_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of each symbol on both sides (J1); a symbol absent from one side counts 0 there.

    Both sides go through one aggregate instead of a full outer join, which would have to sort;
    grouping also treats a null symbol as a value.
    """
    sides = _tagged(left.select("symbol"), right.select("symbol"))
    return sides.groupBy("symbol").agg(
        F.count_if("from_left").alias("left_rows"),
        F.count_if(~F.col("from_left")).alias("right_rows"),
        (F.count_if("from_left") == F.count_if(~F.col("from_left"))).alias("same"),
    )


def require_same_profile(left: DataFrame, right: DataFrame) -> int:
    """The common row count of two Silver frames without nulls and with the same rows per symbol.

    Nulls are reported first, then total rows, then the symbol sets, then rows per symbol (P2). All
    of it comes from one aggregate over both frames, so each is scanned once.
    """
    for side in (left, right):
        SILVER_12.require(side, "compared frame")
    on_left = F.col("from_left")
    nulls = [
        F.count_if(F.col(c).isNull() & (on_left if side == "left" else ~on_left)).alias(f"{side}_{c}")
        for side in ("left", "right")
        for c in SILVER_12.columns
    ]
    per_symbol = _tagged(left, right).groupBy(F.col("symbol").alias("group_symbol")).agg(
        F.count_if(on_left).alias("left_rows"), F.count_if(~on_left).alias("right_rows"), *nulls
    )
    found = per_symbol.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in per_symbol.columns[1:]],
        F.count_if(F.expr("left_rows = 0 OR right_rows = 0")).alias("one_sided"),
        F.count_if(F.expr("left_rows <> right_rows")).alias("different"),
    ).first()
    for side in ("left", "right"):
        _refuse_nulls({c: found[f"{side}_{c}"] for c in SILVER_12.columns}, f"{side} side: ")
    if found.left_rows != found.right_rows:
        raise CopyMismatchError(f"row counts differ: {found.left_rows} and {found.right_rows}")
    if found.one_sided:
        raise CopyMismatchError(f"{found.one_sided} symbols occur on one side only")
    if found.different:
        raise CopyMismatchError(f"{found.different} symbols have different row counts")
    return found.left_rows


def _refuse_nulls(counts: dict[str, int], where: str = "") -> None:
    bad = [f"{name}={count}" for name, count in counts.items() if count]
    if bad:
        raise NullsFoundError(f"{where}required columns hold nulls: " + ", ".join(bad))


def _tagged(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.withColumn("from_left", F.lit(True)).union(
        right.withColumn("from_left", F.lit(False))
    )
