"""Aggregate expressions shared by the stress modules.

All of them have partial (map-side) forms, and all numeric ones keep
fixed-width buffers, so Spark plans hash aggregation for them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(c: str) -> Column:
    """Sum that skips missing values and is 0 when there is nothing to add."""
    return F.expr(f"coalesce(sum({c}), 0.0D)")


#: Exact sums have limbs of LIMB_BITS bits, the lowest in units of 2 ** LOWEST_BIT.
LIMB_BITS, LOWEST_BIT, LIMBS = 24, -96, 7


def exact_total(c: str) -> str:
    """SQL: sum whose bits do not depend on the order of the rows; 0 when there is nothing to add.

    A number is cut at fixed places into whole multiples of powers of two, its
    limbs.  They are added up as whole numbers, which is exact in any order for
    up to 2 ** 39 rows (an overflow is an error), and put together once per
    group.  What lies beyond 2 ** 71 is added as multiples of 2 ** 72, exact up
    to 2 ** 125; NaN and infinities come through there.  Below 2 ** -96 each number
    is rounded for itself.  All buffers are numbers: hash aggregation with
    partial sums.
    """
    def multiples(bit: int) -> str:
        return f"rint(({c}) * {2.0 ** -bit!r}D)"

    step, top = 2.0 ** LIMB_BITS, LOWEST_BIT + LIMB_BITS * LIMBS
    limbs = [
        f"coalesce(sum(try_cast({multiples(bit)} - {multiples(bit + LIMB_BITS)} * {step!r}D AS BIGINT)), 0L) * {2.0 ** bit!r}D"
        for bit in range(LOWEST_BIT, top, LIMB_BITS)
    ]
    beyond = f"coalesce(sum({multiples(top)} * {2.0 ** top!r}D), 0.0D)"
    return f"({' + '.join([*limbs, beyond])})"


def uniform(c: str) -> Column:
    """The value when every row has it, NULL when rows differ or some lack it."""
    return F.expr(f"if(count({c}) = count(1) AND min({c}) = max({c}), min({c}), NULL)")


def dominant(category: str, amount: str) -> Column:
    """Category with the largest amount, the alphabetically first on a tie.

    Expects one row per category, i.e. amounts already summed.
    """
    return F.expr(f"min_by({category}, struct(-{amount}, coalesce({category}, 'nan')))")


def weighted_step(weighted: Column, weight: Column, tolerance: float) -> Column:
    """Weighted credit quality step, rounded up; 0 when the weights cancel out."""
    return F.when(weight != 0, F.ceil(weighted / weight - F.lit(tolerance))).otherwise(
        F.lit(0).cast("bigint")
    )
