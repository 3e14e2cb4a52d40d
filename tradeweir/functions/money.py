"""Exact decimal products (V6).

Spark types ``decimal(38,18) * decimal(38,18)`` as ``decimal(38,6)`` and rounds. The exact
product below never does: it is returned whole if it fits ``decimal(38,18)``, or it fails.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweir.contracts import BRONZE_15, MONEY

# decimal(19,8) * decimal(17,8) is typed decimal(37,16): wide enough for exchange quotes, computed
# without rounding, and never beyond 20 whole digits. Rows that do not fit take the slower product by parts.
QUOTE_TYPE = "decimal(19,8)"
SIZE_TYPE = "decimal(17,8)"
UNITS = 10**18  # smallest steps of the money type in one
NO_SCALE = "NOTIONAL_SCALE"
NO_RANGE = "NUMERIC_VALUE_OUT_OF_RANGE"


def rounded_product(price: Column, quantity: Column) -> Column:
    """The plain product: Spark rounds it to 6 decimals before the cast back."""
    return (price * quantity).cast(MONEY)


def exact_product(price: Column, quantity: Column) -> Column:
    """``price * quantity`` as ``decimal(38,18)``, exact or an error."""

    def insist(found: Column) -> Column:
        refuse = F.raise_error(F.concat(found["problem"], F.lit(": no exact product of "), price.cast("string"), F.lit(" and "), quantity.cast("string")))
        return F.when(found["problem"].isNull(), found["product"]).otherwise(refuse.cast(MONEY))

    return _product(price, quantity, _let(_by_parts(price, quantity), insist))


def try_exact_product(price: Column, quantity: Column) -> Column:
    """The exact product where it fits, else null."""
    return _product(price, quantity, _by_parts(price, quantity)["product"])


def product_problem(price: Column, quantity: Column) -> Column:
    """Why there is no exact product: more decimals or more whole digits than the type has; null if there is one."""
    known = price.isNotNull() & quantity.isNotNull()
    return F.when(known & ~_fits(price, quantity), _by_parts(price, quantity)["problem"])


def unfit_notionals(bronze: DataFrame) -> DataFrame:
    """The valid Bronze rows that a rebuild in exact mode would fail on, each with its ``problem``."""
    BRONZE_15.require_names(bronze, "Bronze input")
    problem = product_problem(F.col("price"), F.col("quantity"))
    return bronze.where("is_valid = true").withColumn("problem", problem).where("problem IS NOT NULL")


def _fits(price: Column, quantity: Column) -> Column:
    """Do both operands fit the types whose product Spark computes whole?"""
    return F.coalesce((price.try_cast(QUOTE_TYPE) == price) & (quantity.try_cast(SIZE_TYPE) == quantity), F.lit(False))


def _product(price: Column, quantity: Column, by_parts: Column) -> Column:
    quick = (price.try_cast(QUOTE_TYPE) * quantity.try_cast(SIZE_TYPE)).cast(MONEY)
    return (
        F.when(price.isNull() | quantity.isNull(), F.lit(None).cast(MONEY))
        .when(_fits(price, quantity), quick)
        .otherwise(by_parts)
    )


def _by_parts(price: Column, quantity: Column) -> Column:
    """The product and its problem, one of them null.

    Both operands are cut into whole numbers of ones and of smallest steps. Of the four partial products only the
    one of steps with steps can have a remainder, which would be a 19th decimal; its quotient is carried.
    Sums and products of ``decimal(38,0)`` lose nothing, and what is too large for that type, where they are null, is too
    large for the result. Each intermediate value is bound once, so the rare slow way stays out of generated code.
    """
    one = F.lit(UNITS).cast("decimal(19,0)")

    def combine(cut: Column) -> Column:
        tiny = cut["steps_a"] * cut["steps_b"]  # below 10**36
        crossed = F.try_add(
            (cut["ones_a"] * cut["steps_b"]).cast("decimal(38,0)"), (cut["steps_a"] * cut["ones_b"]).cast("decimal(38,0)")
        )
        whole = F.try_multiply(F.try_multiply(cut["ones_a"], cut["ones_b"]), one)
        return F.struct(tiny.alias("tiny"), F.try_add(crossed, whole).alias("rest"))

    def carry(sums: Column) -> Column:
        over = sums["tiny"] % one
        carried = ((sums["tiny"] - over).cast("decimal(36,0)") / one).cast("decimal(38,0)")
        return F.struct(over.alias("over"), F.try_add(sums["rest"], carried).cast("string").alias("steps"))

    def write(found: Column) -> Column:
        digits = F.lpad(found["steps"], F.greatest(F.lit(19), F.length(found["steps"])), "0")
        text = F.concat(F.left(digits, F.length(digits) - 18), F.lit("."), F.right(digits, F.lit(18)))
        minus = F.when((price < 0) != (quantity < 0), "-").otherwise("")
        problem = F.when(found["over"] != 0, NO_SCALE).when(found["steps"].isNull(), NO_RANGE)
        return F.struct(
            F.when(problem.isNull(), F.concat(minus, text).cast(MONEY)).alias("product"), problem.alias("problem")
        )

    cut = F.struct(*_ones_and_steps(price, "a"), *_ones_and_steps(quantity, "b"))
    return _let(_let(_let(cut, combine), carry), write)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _ones_and_steps(value: Column, name: str) -> list[Column]:
    """The size of a number of the money type, which is written with all its 18 decimals, cut at the point."""
    text = F.ltrim(value.cast("string"), F.lit("-"))
    ones, steps = F.substring_index(text, ".", 1), F.substring_index(text, ".", -1)
    return [ones.cast("decimal(20,0)").alias(f"ones_{name}"), steps.cast("decimal(18,0)").alias(f"steps_{name}")]
