import random
import statistics
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest

from tests.rows import NOON, silver_rows
from tradeweir.errors import PipelineError
from tradeweir.operators import metrics

SECOND = timedelta(seconds=1)


def _trades(spark, *rows):
    names = ("symbol", "event_time", "kafka_partition", "kafka_offset", "price", "latency_ms")
    return silver_rows(spark, *[dict(zip(names, r)) for r in rows])


def test_latest_price_order(spark):
    frame = _trades(
        spark,
        ("A", NOON, 0, 5, Decimal(1), 0),
        ("A", NOON + SECOND, 0, 1, Decimal(2), 0),
        ("A", NOON + SECOND, 1, 0, Decimal(3), 0),
        ("A", NOON + SECOND, 1, 0, Decimal("2.5"), 0),
        ("B", NOON, 3, 9, Decimal(7), 0),
    )
    found = {r.symbol: r.latest_price for r in metrics.symbol_latest_price(frame).collect()}
    assert found == {"A": Decimal(3), "B": Decimal(7)}


@pytest.mark.parametrize("bits", [0, 3, 20])
def test_median_by_brute_force(spark, bits, monkeypatch):
    """Narrow buckets force the middle ranks of a group into different buckets."""
    monkeypatch.setattr(metrics, "MEDIAN_BUCKET_BITS", bits)
    rng = random.Random(bits)
    values = {}
    for group in range(12):
        size = rng.choice([1, 2, 3, 50, 51])
        spread = rng.choice([2, 100, 10**12])
        values[None if group == 0 else f"g{group}"] = [
            rng.randint(-spread, spread) for _ in range(size)
        ]
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("g1", None)]
    frame = spark.createDataFrame(rows, "symbol string, latency_ms bigint")
    found = {r.symbol: r.median_latency_ms for r in metrics.median_latency(frame, ["symbol"]).collect()}
    assert found == {k: float(statistics.median(v)) for k, v in values.items()}
    whole = metrics.median_latency(frame, []).first().median_latency_ms
    assert whole == float(statistics.median([v for vs in values.values() for v in vs]))


def test_approximate_median(spark):
    frame = spark.createDataFrame([("A", n) for n in range(101)], "symbol string, latency_ms bigint")
    row = metrics.median_latency(frame, ["symbol"], approximate=True).first()
    assert row == ("A", 50.0)


def test_kpis_of_nothing(spark):
    row = metrics.kpi_row(silver_rows(spark)).first()
    assert row == (0, None, None, None)


def test_kpi_row(spark):
    frame = _trades(
        spark,
        ("A", NOON, 0, 1, Decimal(1), -5),
        ("A", NOON + SECOND, 0, 2, Decimal(2), 10),
        ("B", NOON, 0, 3, Decimal(9), 40),
        (None, NOON, 0, 4, Decimal(9), 41),
    )
    assert metrics.kpi_row(frame).first() == (4, Decimal(24), Decimal(2), 25.0)
    by_symbol = {r.symbol: tuple(r)[1:] for r in metrics.context_kpis(frame, ["symbol"]).collect()}
    assert by_symbol == {
        "A": (2, Decimal(12), Decimal(2), 2.5),
        "B": (1, Decimal(6), Decimal(9), 40.0),
        None: (1, Decimal(6), Decimal(9), 41.0),
    }


def test_minutes_and_histogram(spark):
    frame = _trades(
        spark,
        ("A", NOON, 0, 1, Decimal(1), -1),
        ("A", NOON + 59 * SECOND, 0, 2, Decimal(2), 0),
        ("A", NOON + 60 * SECOND, 0, 3, Decimal(3), 49),
        ("B", NOON + 61 * SECOND, 0, 4, Decimal(4), 50),
    )
    counts = sorted((r.minute.minute, r.trade_count) for r in metrics.trades_per_minute(frame).collect())
    assert counts == [(0, 2), (1, 2)]
    prices = sorted(
        (r.symbol, r.minute.minute, r.latest_price) for r in metrics.price_over_time(frame).collect()
    )
    assert prices == [("A", 0, 2), ("A", 1, 3), ("B", 1, 4)]
    medians = sorted(
        (r.minute.minute, r.median_latency_ms) for r in metrics.latency_over_time(frame).collect()
    )
    assert medians == [(0, -0.5), (1, 49.5)]
    bars = sorted((r.bucket_start, r.trade_count) for r in metrics.latency_histogram(frame).collect())
    assert bars == [(-50, 1), (0, 2), (50, 1)]
    with pytest.raises(PipelineError):
        metrics.latency_histogram(frame, 0)


def test_filter_is_half_open(spark):
    frame = _trades(
        spark,
        ("A", NOON - SECOND, 0, 1, Decimal(1), 0),
        ("A", NOON, 0, 2, Decimal(1), 0),
        ("B", NOON, 0, 3, Decimal(1), 0),
        ("A", NOON + SECOND, 0, 4, Decimal(1), 0),
    )
    kept = metrics.select_trades(frame, symbols=["A"], start=NOON, end=NOON + SECOND)
    assert [r.kafka_offset for r in kept.collect()] == [2]
    east = timezone(timedelta(hours=2))
    same = metrics.select_trades(frame, start=NOON.astimezone(east), end=datetime(2026, 1, 1, 0, 0, 1))
    assert sorted(r.kafka_offset for r in same.collect()) == [2, 3]
    with pytest.raises(PipelineError):
        metrics.select_trades(frame, symbols=[])


def test_time_filter_skips_month_folders(spark, tmp_path):
    path = str(tmp_path / "served")
    months = [datetime(2025, m, 1, tzinfo=timezone.utc) for m in range(1, 13)]
    rows = _trades(spark, *[("A", m, 0, 1, Decimal(1), 0) for m in months])
    metrics.with_event_month(rows).write.partitionBy("event_month").parquet(path)
    served = spark.read.schema(metrics.with_event_month(rows).schema).parquet(path)
    chosen = metrics.select_trades(
        served, start=datetime(2025, 3, 1), end=datetime(2025, 5, 1)
    )
    assert chosen.count() == 2
    files = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in files
    assert {f.split("event_month=")[1][:6] for f in _read_files(chosen)} == {"202503", "202504"}


def _read_files(frame):
    return [r[0] for r in frame.select("_metadata.file_path").distinct().collect()]


def test_kpis_use_no_cross_join_and_read_the_counts_once(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver_rows(spark, {}, {"symbol": "ETH"}).write.parquet(path)
    for keys in ([], ["symbol"]):
        frame = metrics.context_kpis(spark.read.parquet(path), keys)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        assert "ReusedExchange" in final
        assert final.count("FileScan") == 2


def test_hot_symbol(spark):
    """A symbol with a third of all rows, against plain Python."""
    rng = random.Random(3)
    rows = []
    for n in range(1500):
        symbol = "HOT" if n % 3 == 0 else f"S{n}"
        rows.append((symbol, NOON + n * SECOND, 0, n, Decimal(n + 1), rng.randint(-5, 900)))
    found = {r.symbol: r for r in metrics.context_kpis(_trades(spark, *rows), ["symbol"]).collect()}
    hot = [r for r in rows if r[0] == "HOT"]
    assert len(found) == 1001
    assert found["HOT"].trade_count == 500
    assert found["HOT"].latest_price == hot[-1][4]
    assert found["HOT"].median_latency_ms == statistics.median(r[5] for r in hot)
