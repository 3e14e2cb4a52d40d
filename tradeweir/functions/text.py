"""String, JSON and hash expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeweir.contracts import SILVER_12

# Fixed value: timestamps are written as UTC text cut to milliseconds.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def iso_millis(moment: Column) -> Column:
    """Timestamp as UTC text with three fractional digits (V8). The session zone must be UTC."""
    return F.date_format(moment, ISO_MILLIS)


def opens_object(column: str) -> str:
    """SQL condition: the first JSON character of a text is an opening brace."""
    # The common case is decided by one byte; the pattern covers leading JSON white space.
    return rf"(startswith({column}, '{{') OR {column} RLIKE '^[ \\t\\r\\n]*\\{{')"


def month_key(moment: Column) -> Column:
    """Serving partition of a timestamp, such as ``202401``."""
    return F.date_format(moment, "yyyyMM")


def canonical_silver_json() -> Column:
    """One Silver row as JSON text: declared order, fixed scale, UTC milliseconds, nulls kept.

    Scale-18 decimals print all 18 digits under ANSI, so equal values always give equal text
    (F10, V3).
    """
    texts = []
    for name, kind in SILVER_12.types.items():
        value = F.col(name)
        text = iso_millis(value) if kind == "timestamp" else value.cast(kind).cast("string")
        texts.append(text.alias(name))
    return F.to_json(F.struct(*texts), {"ignoreNullFields": "false"})


def length_prefixed(*values: Column) -> Column:
    """``len:text`` pieces joined without separator, so no two lists encode alike."""
    pieces: list[Column] = []
    for value in values:
        text = value.cast("string")
        pieces += [F.length(text).cast("string"), F.lit(":"), text]
    return F.concat(*pieces)
