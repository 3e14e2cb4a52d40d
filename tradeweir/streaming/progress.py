"""What a stream's own progress says of its batches: late rows, repeats, rows held in state."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class BatchCounts:
    """One micro-batch. ``late`` counts what came behind the watermark, ``repeats`` known keys."""

    batch_id: int
    rows_in: int
    late: int
    repeats: int
    state_rows: int
    watermark: str | None


def batch_counts(query: StreamingQuery) -> list[BatchCounts]:
    """Counts of the batches that the query still remembers, oldest first.

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates``; a job that runs for long
    passes each event of a ``StreamingQueryListener`` to :func:`counts_of` instead. An aggregate
    counts late groups rather than late rows, because rows are summed before they meet its state.
    """
    return [counts_of(progress) for progress in query.recentProgress]


def counts_of(progress) -> BatchCounts:
    states = progress.stateOperators
    return BatchCounts(
        batch_id=progress.batchId,
        rows_in=progress.numInputRows,
        late=sum(s.numRowsDroppedByWatermark for s in states),
        repeats=sum(s.customMetrics.get("numDroppedDuplicateRows", 0) for s in states),
        state_rows=sum(s.numRowsTotal for s in states),
        watermark=progress.eventTime.get("watermark"),
    )


def observed_totals(query: StreamingQuery, name: str) -> dict[str, int]:
    """Sums over all remembered batches of the counts that ``observe(name, ...)`` takes."""
    return _sums(p.observedMetrics[name].asDict() for p in query.recentProgress if name in p.observedMetrics)


def _sums(rows: Iterable[dict[str, int]]) -> dict[str, int]:
    total: dict[str, int] = {}
    for row in rows:
        for key, value in row.items():
            total[key] = total.get(key, 0) + (value or 0)
    return total
