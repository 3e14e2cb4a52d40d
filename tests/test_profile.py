import pytest

from tests.rows import silver_rows
from tradeweir.contracts import SILVER_12
from tradeweir.errors import CopyMismatchError, NullsFoundError, PipelineError
from tradeweir.operators.profile import (
    count_diff,
    null_counts,
    require_same_profile,
    row_and_symbol_counts,
    rows_per_symbol,
    source_profile,
)


def _symbols(spark, *names):
    return silver_rows(spark, *[{"symbol": n} for n in names])


@pytest.mark.parametrize("column", SILVER_12.columns)
def test_each_null_is_named(spark, column):
    frame = silver_rows(spark, {}, {column: None})
    assert null_counts(frame).first()[column] == 1
    with pytest.raises(NullsFoundError, match=f"{column}=1$"):
        source_profile(frame).require_no_nulls()


def test_null_report_keeps_column_order(spark):
    frame = silver_rows(spark, {"price": None}, {"exchange": None})
    with pytest.raises(NullsFoundError, match="exchange=1, price=1"):
        source_profile(frame).require_no_nulls()


def test_summary_and_display_cap(spark):
    profile = source_profile(_symbols(spark, "SOL", "BTC", "BTC", "ETH"), 2).require_no_nulls()
    assert (profile.row_count, profile.distinct_symbols) == (4, 3)
    assert profile.shown == (("BTC", 2), ("ETH", 1)) and profile.omitted_symbols == 1
    with pytest.raises(PipelineError):
        source_profile(_symbols(spark, "A"), 0)


def test_empty_frame(spark):
    profile = source_profile(_symbols(spark)).require_no_nulls()
    assert (profile.row_count, profile.distinct_symbols, profile.shown) == (0, 0, ())
    assert row_and_symbol_counts(_symbols(spark)).first() == (0, 0)


def test_rows_per_symbol_is_ordered(spark):
    assert rows_per_symbol(_symbols(spark, "B", "A", "B")).collect() == [("A", 1), ("B", 2)]


def test_count_diff(spark):
    left, right = _symbols(spark, "A", "A", None, "C"), _symbols(spark, "A", "B", None)
    found = {r.symbol: (r.left_rows, r.right_rows, r.same) for r in count_diff(left, right).collect()}
    assert found == {
        "A": (2, 1, False),
        "B": (0, 1, False),
        "C": (1, 0, False),
        None: (1, 1, True),
    }


def test_first_difference_wins(spark):
    base = _symbols(spark, "A", "A", "B")
    assert require_same_profile(base, _symbols(spark, "B", "A", "A")) == 3
    with pytest.raises(NullsFoundError, match="right side: .*price=1$"):
        require_same_profile(base, silver_rows(spark, {"price": None}))
    for other, text in (
        (_symbols(spark, "A", "A"), "row counts"),
        (_symbols(spark, "A", "A", "C"), "one side only"),
        (_symbols(spark, "A", "B", "B"), "different row counts"),
    ):
        with pytest.raises(CopyMismatchError, match=text):
            require_same_profile(base, other)


def test_one_scan_without_global_exchange_of_rows(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver_rows(spark, {}).write.parquet(path)
    frame = rows_per_symbol(spark.read.parquet(path))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<symbol:string>" in plan
