"""Sums and means that do not depend on the order of rows.

Doubles added in another order give another last digit, which rounding can turn into another
cent. Here every value counts with six decimals, as a decimal; decimals add up exactly, in
whatever order and however often partial sums are merged. Means are divided and rounded half
up on whole numbers and only then become doubles.

Nulls, NaN, infinities and values of 10^22 or more count neither in sums nor in means; a sum
or mean of no value is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 6
VALUE_TYPE = f"decimal(28,{SCALE})"
#: Sums of ``VALUE_TYPE``: what partial states and stores hold.
SUM_TYPE = f"decimal(38,{SCALE})"


def value(col) -> Column:
    return (F.col(col) if isinstance(col, str) else col).try_cast(VALUE_TYPE)


def total(col) -> Column:
    """Exact sum (aggregate), also of partial sums."""
    return F.sum(value(col))


def merged(col) -> Column:
    """Sum of partial sums (aggregate)."""
    return F.sum(col).cast(SUM_TYPE)


def count(col) -> Column:
    """Number of values in ``total`` (aggregate)."""
    return F.count(value(col))


def rounded(sum_col, decimals: int = 2) -> Column:
    """A sum rounded half up, as a double."""
    s = F.col(sum_col) if isinstance(sum_col, str) else sum_col
    return F.round(s, decimals).cast("double")


def rounded_mean(sum_col, count_col, decimals: int | None = 2) -> Column:
    """Sum / count rounded half up, as a double; ``decimals=None`` leaves it unrounded."""
    s = F.col(sum_col) if isinstance(sum_col, str) else sum_col
    n = F.col(count_col) if isinstance(count_col, str) else count_col
    if decimals is None:
        return F.when(n > 0, s.cast("double") / n)
    unit = 10 ** decimals
    whole = F.call_function("div", F.abs(s) * F.lit(2 * unit) + n, n * 2)
    return F.when(n > 0, F.when(s < 0, -whole).otherwise(whole) / F.lit(float(unit)))


def mean(col, decimals: int | None = 2) -> Column:
    """Rounded mean (aggregate)."""
    return rounded_mean(total(col), count(col), decimals)
