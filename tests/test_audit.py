import random

import pytest

from tests.rows import NOON, bronze_rows, silver_rows
from tradeweir.errors import PipelineError
from tradeweir.operators import audit


def _gaps(frame):
    return sorted((r.kafka_partition, r.first_missing, r.last_missing, r.missing)
                  for r in audit.offset_gaps(frame).collect())


@pytest.mark.parametrize("bits", [1, 4, 13])
def test_gaps_by_brute_force(spark, bits, monkeypatch):
    monkeypatch.setattr(audit, "OFFSET_BUCKET_BITS", bits)
    rng = random.Random(bits)
    offsets = {
        0: [o for o in range(300) if rng.random() < 0.7] * 2,
        1: rng.sample(range(-500, 100_000), 40),
        2: [2**62, 2**62 + 1, 2**62 + 5],
        3: [7],
    }
    expected = []
    for partition, seen in offsets.items():
        ordered = sorted(set(seen))
        for a, b in zip(ordered, ordered[1:]):
            if b > a + 1:
                expected.append((partition, a + 1, b - 1, b - a - 1))
    rows = [("t", p, o) for p, seen in offsets.items() for o in seen]
    frame = spark.createDataFrame(
        [*rows, ("t", 0, None)], "kafka_topic string, kafka_partition int, kafka_offset bigint"
    )
    assert _gaps(frame) == sorted(expected)


def test_dedup_keeps_the_earliest(spark):
    frame = silver_rows(
        spark,
        {"kafka_offset": 9},
        {"kafka_offset": 4},
        {"kafka_offset": 1, "event_time": NOON.replace(year=2027)},
        {"trade_id": "2"},
    )
    kept = audit.dedup_by_key(frame)
    assert kept.columns == frame.columns
    assert sorted((r.trade_id, r.kafka_offset) for r in kept.collect()) == [("1", 4), ("2", 1)]
    with pytest.raises(PipelineError):
        audit.dedup_by_key(frame, [])


def test_dedup_per_source_position(spark):
    frame = silver_rows(spark, {}, {}, {"trade_id": "2"})
    keys = ("kafka_topic", "kafka_partition", "kafka_offset")
    kept = audit.dedup_by_key(frame, keys).collect()
    assert [r.trade_id for r in kept] == ["1"]


def test_quarantine_leaves_unevaluated_rows(spark):
    frame = bronze_rows(spark, {}, {"is_valid": False, "trade_id": "x"}, {"is_valid": None})
    assert [r.trade_id for r in audit.quarantine(frame).collect()] == ["x"]


def test_freshness(spark):
    row = audit.freshness(silver_rows(spark, {}, {"event_time": NOON.replace(year=2025)})).first()
    assert row.newest_event.year == 2026 and row.age_ms > 0
