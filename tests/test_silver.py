import random
from decimal import Decimal, getcontext

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.rows import bronze_rows
from tradeweir.contracts import BRONZE_13, SILVER_12
from tradeweir.errors import ContractError
from tradeweir.functions.money import (
    exact_product,
    product_problem,
    rounded_product,
    try_exact_product,
    unfit_notionals,
)
from tradeweir.operators.silver import build_silver

getcontext().prec = 80
PAIR = "price decimal(38,18), quantity decimal(38,18)"


def _pairs(spark, *pairs):
    return spark.createDataFrame([tuple(Decimal(x) for x in p) for p in pairs], PAIR)


def _product(frame, product):
    return frame.select("*", product(F.col("price"), F.col("quantity")).alias("x"))


def test_projection(spark):
    row = build_silver(bronze_rows(spark, {})).first()
    assert (row.notional, row.latency_ms) == (Decimal(10), 1500)
    assert row.event_time.timestamp() == 1.0 and row.ingested_at.timestamp() == 2.5
    SILVER_12.require(build_silver(bronze_rows(spark, {})))


def test_signed_latency(spark):
    row = build_silver(bronze_rows(spark, {"event_time_ms": 2500, "ingested_at_ms": 2438})).first()
    assert row.latency_ms == -62


def test_only_true_rows_and_no_dedup(spark):
    frame = bronze_rows(
        spark, {}, {}, {"is_valid": False, "trade_id": "1"}, {"is_valid": None, "trade_id": "2"}
    )
    assert [r.trade_id for r in build_silver(frame).collect()] == ["0", "0"]


def test_other_columns_are_rejected(spark):
    with pytest.raises(ContractError):
        build_silver(bronze_rows(spark, {}).select(*BRONZE_13.columns))
    with pytest.raises(KeyError):
        build_silver(bronze_rows(spark, {}), "nearly")


EXACT = [
    ("68250.12345678", "0.00012345"),
    ("1.123456789", "1"),
    ("0.0000005", "1"),
    ("0.000000000000000001", "1"),
    ("123456789012345.123456789012345678", "1"),
    ("2.5", "4"),
    ("0.000000001", "0.000000001"),
    ("99999999999", "99999"),
    ("-2.5", "1.1234567891"),
    ("-0.1234567891", "-3.5"),
    ("999999999999.99999999", "0.00000001"),
    ("0", "0"),
    ("1000000000000000000", "1"),
    ("200000000000000000", "0.5"),
    ("99999999999999999999.999999999999999999", "1"),
    ("99999999999999999999.999999999999999999", "-1"),
    ("99999999999999999999", "0.000000000000000001"),
    ("12345678901234567890.123456789012345678", "8"),
    ("0.000000001", "99999999999999999999"),
    ("1234567890.123456789", "1234567890.123456789"),
]


def test_exact_product_equals_big_integers(spark):
    rows = _product(_pairs(spark, *EXACT), exact_product).collect()
    assert [r.x for r in rows] == [r.price * r.quantity for r in rows]


def test_random_products(spark):
    rng = random.Random(11)

    def number(whole, decimals):
        return f"{rng.randrange(10 ** rng.randint(0, whole))}.{rng.randrange(10**decimals):0{decimals}}"

    pairs = []
    for _ in range(1500):
        decimals = rng.randint(1, 17)
        pairs.append((number(10, decimals), number(6, 18 - decimals)))
    rows = _product(_pairs(spark, *pairs), exact_product).collect()
    assert [r.x for r in rows] == [r.price * r.quantity for r in rows]


@pytest.mark.parametrize(
    ("pair", "message"),
    [
        (("0.1234567891", "0.123456789"), "NOTIONAL_SCALE"),
        (("99999999999999999999.999999999999999999", "2"), "NUMERIC_VALUE_OUT_OF_RANGE"),
        (("10000000000", "10000000000"), "NUMERIC_VALUE_OUT_OF_RANGE"),
    ],
)
def test_product_that_cannot_be_held_fails(spark, pair, message):
    with pytest.raises(PySparkException, match=message):
        _product(_pairs(spark, pair), exact_product).collect()


def test_rounded_product_has_six_decimals_and_fails_on_overflow(spark):
    rows = _product(
        _pairs(spark, EXACT[0], ("0.0000005", "1"), ("0.0000004", "1")), rounded_product
    ).collect()
    assert [r.x for r in rows] == [Decimal("8.425478"), Decimal("0.000001"), Decimal(0)]
    with pytest.raises(PySparkException):
        big = _pairs(spark, ("99999999999999999999.999999999999999999", "2"))
        _product(big, rounded_product).collect()


def test_null_operands_give_null(spark):
    frame = spark.createDataFrame([(None, Decimal(1)), (Decimal(1), None)], PAIR)
    assert [r.x for r in _product(frame, exact_product).collect()] == [None, None]


def test_scan_is_pruned_and_filtered(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze_rows(spark, {}, {"is_valid": False}).write.parquet(path)
    plan = build_silver(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_valid,true)" in plan
    assert "raw_json" not in plan and "validation_errors" not in plan
    assert "Exchange" not in plan


def test_wide_products_against_big_integers(spark):
    rng = random.Random(4)

    def number():
        whole, decimals = rng.randint(0, 20), rng.randint(0, 18)
        value = Decimal(rng.randrange(10**whole)) + Decimal(rng.randrange(10**decimals)) / 10**decimals
        return value * rng.choice([1, 1, -1])

    frame = _pairs(spark, *[(number(), number()) for _ in range(1500)])
    operands = (F.col("price"), F.col("quantity"))
    rows = frame.select("*", try_exact_product(*operands).alias("x"), product_problem(*operands).alias("why")).collect()
    seen = set()
    for r in rows:
        product = r.price * r.quantity
        why = "NOTIONAL_SCALE" if (product * 10**18) % 1 else "NUMERIC_VALUE_OUT_OF_RANGE" if abs(product) >= 10**20 else None
        assert (r.x, r.why) == (None if why else product, why)
        seen.add(why)
    assert len(seen) == 3


def test_rows_that_a_rebuild_would_fail_on(spark):
    frame = bronze_rows(
        spark,
        {"trade_id": "fits", "price": Decimal(10**18), "quantity": Decimal(1)},
        {"trade_id": "large", "price": Decimal(10**18), "quantity": Decimal(1000)},
        {"trade_id": "fine", "price": Decimal("0.0000000001"), "quantity": Decimal("0.0000000001")},
        {"trade_id": "refused", "price": Decimal(10**18), "quantity": Decimal(1000), "is_valid": False},
        {"trade_id": "none", "price": None},
    )
    assert {r.trade_id: r.problem for r in unfit_notionals(frame).collect()} == {
        "large": "NUMERIC_VALUE_OUT_OF_RANGE",
        "fine": "NOTIONAL_SCALE",
    }
    rebuilt = build_silver(frame.where("trade_id NOT IN ('large', 'fine')")).collect()
    assert {r.trade_id: r.notional for r in rebuilt} == {"fits": Decimal(10**18), "none": None}
    with pytest.raises(PySparkException, match="NOTIONAL_SCALE: no exact product of 0.0000000001"):
        build_silver(frame.where("trade_id = 'fine'")).collect()
