import hashlib
import inspect
import json
from datetime import datetime, timezone
from decimal import Decimal

import pytest

from tests.rows import silver_rows
from tradeweir.errors import CopyMismatchError, PipelineError
from tradeweir.operators.fingerprint import (
    _compared,
    canonical_rows,
    compare_rows,
    except_all_diff,
    multiset_diff,
    require_same_rows,
    row_hash_counts,
    stream_fingerprint,
    tree_fingerprint,
)

NOTHING = hashlib.sha256(b"").hexdigest()


def _tree(frame, **shape):
    return tree_fingerprint(frame, **shape).first().fingerprint


def _many(spark, numbers):
    return silver_rows(spark, *[{"trade_id": str(n), "kafka_offset": n} for n in numbers])


def test_canonical_text(spark):
    moment = datetime(2026, 1, 1, 0, 0, 0, 123456, tzinfo=timezone.utc)
    frame = silver_rows(
        spark,
        {"price": Decimal(-2), "event_time": moment, "latency_ms": -(2**63), "symbol": 'a"|b'},
        {"symbol": None, "kafka_partition": 2**31 - 1, "notional": Decimal("0")},
    )
    first, second = (r.canonical_row for r in canonical_rows(frame).collect())
    assert '"price":"-2.000000000000000000"' in first
    assert '"event_time":"2026-01-01T00:00:00.123Z"' in first
    assert f'"latency_ms":"{-(2**63)}"' in first and json.loads(first)["symbol"] == 'a"|b'
    assert '"symbol":null' in second and '"kafka_partition":"2147483647"' in second
    assert '"notional":"0.000000000000000000"' in second
    assert list(json.loads(first)) == frame.columns


def test_fields_do_not_run_together(spark):
    frame = silver_rows(
        spark, {"symbol": "a|b", "trade_id": "c"}, {"symbol": "a", "trade_id": "b|c"}
    )
    assert row_hash_counts(frame).count() == 2


def test_multiplicity_is_counted(spark):
    found = row_hash_counts(silver_rows(spark, {}, {}, {"trade_id": "2"})).collect()
    assert sorted(r.multiplicity for r in found) == [1, 2]
    assert all(len(r.row_hash) == 64 and r.row_hash == r.row_hash.lower() for r in found)


@pytest.mark.parametrize("digest", [_tree, stream_fingerprint])
def test_order_free_and_duplicate_sensitive(spark, digest):
    base = digest(_many(spark, range(40)))
    assert digest(_many(spark, reversed(range(40))).repartition(5)) == base
    assert digest(_many(spark, [*range(40), 7])) != base
    assert digest(_many(spark, range(39))) != base
    assert digest(_many(spark, [])) == NOTHING


def test_stream_digest_by_hand(spark):
    frame = _many(spark, [1, 2, 2, 3])
    pairs = sorted((r.row_hash, r.multiplicity) for r in row_hash_counts(frame).collect())
    text = "".join(f"64:{h}{len(str(n))}:{n}" for h, n in pairs)
    assert stream_fingerprint(frame) == hashlib.sha256(text.encode()).hexdigest()
    with pytest.raises(PipelineError):
        stream_fingerprint(frame, max_pairs=2)


def test_stream_digest_has_no_limit_of_its_own(spark):
    assert inspect.signature(stream_fingerprint).parameters["max_pairs"].default is None
    frame = _many(spark, range(50))
    assert stream_fingerprint(frame) == stream_fingerprint(frame, max_pairs=50)


@pytest.mark.parametrize(("leaf", "fan"), [(6, 3), (1, 3), (2, 1), (5, 2)])
def test_tree_digest_by_hand(spark, leaf, fan):
    frame = _many(spark, [*range(200), *range(50)])
    level = {}
    for r in row_hash_counts(frame).collect():
        text = f"64:{r.row_hash}{len(str(r.multiplicity))}:{r.multiplicity}"
        level.setdefault(r.row_hash[:leaf], []).append(text)
    digits = leaf
    while True:
        digests = {
            p: hashlib.sha256("".join(sorted(parts)).encode()).hexdigest()
            for p, parts in level.items()
        }
        if digits == 0:
            break
        digits = max(0, digits - fan)
        level = {}
        for p, d in digests.items():
            level.setdefault(p[:digits], []).append(p + d)
    assert _tree(frame, leaf_digits=leaf, fan_digits=fan) == digests[""]


def test_differences_are_found(spark):
    left = silver_rows(spark, {}, {}, {"trade_id": "2"})
    right = silver_rows(spark, {}, {"trade_id": "2"}, {"trade_id": "3"})
    found = sorted((r.left_count, r.right_count) for r in multiset_diff(left, right).collect())
    assert found == [(0, 1), (2, 1)]
    sides = sorted((r.side, r.trade_id) for r in except_all_diff(left, right).collect())
    assert sides == [("left", "1"), ("right", "3")]


def test_last_decimal_digit_matters(spark):
    left = silver_rows(spark, {})
    right = silver_rows(spark, {"price": Decimal("2.000000000000000001")})
    with pytest.raises(CopyMismatchError):
        require_same_rows(left, right)
    assert require_same_rows(left, silver_rows(spark, {})) == _tree(left)


def test_two_sided_trees_equal_single_ones(spark):
    left, right = _many(spark, [*range(300), 5]), _many(spark, range(250, 600))
    with pytest.raises(CopyMismatchError) as caught:
        require_same_rows(left, right)
    assert _tree(left) in str(caught.value) and _tree(right) in str(caught.value)
    same = _many(spark, [5, *reversed(range(300))])
    assert require_same_rows(left, same) == _tree(left)
    assert require_same_rows(_many(spark, []), _many(spark, [])) == NOTHING
    with pytest.raises(CopyMismatchError, match=NOTHING):
        require_same_rows(left, _many(spark, []))


def test_a_comparison_shuffles_rows_once(spark):
    left, right = _many(spark, range(300)), _many(spark, [*range(300), 7, 7])
    compared = _compared(left, right)
    plan = compared._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange SinglePartition") == 1
    found = compare_rows(left, right)
    assert (found.left, found.right) == (_tree(left), _tree(right))
    assert (found.left_rows, found.right_rows, found.null_columns) == (300, 302, ())
