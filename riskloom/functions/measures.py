"""Aggregate building blocks.

Money is summed as whole cents: a long sum is exact in any order, so a result does not depend on how
rows were spread over tasks, and it stays on the cheapest aggregation path. Amounts must carry at most
two decimals, which the cleaning step and the streams' silver step guarantee.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def finite(value: Column | str) -> Column:
    """The value; null for NaN and the infinite ones."""
    return F.when(F.abs(_col(value)) < F.lit(float("inf")), _col(value))


def cents(amount: Column | str) -> Column:
    """Whole cents; null for what is no amount: NaN, an infinite value, or more than a long can hold."""
    return F.rint(_col(amount) * 100).try_cast("long")


def volume(amount: Column | str) -> Column:
    """Exact sum of money; null when no amount is present or the sum is beyond a long."""
    return F.try_sum(cents(amount)) / F.lit(100.0)


def mean_amount(amount: Column | str, digits: int = 2) -> Column:
    c = cents(amount)
    return F.round(F.try_divide(F.try_sum(c).cast("double"), 100.0 * F.count(c)), digits)


def mean(value: Column | str, digits: int = 2) -> Column:
    return F.round(F.avg(_col(value)), digits)


def rows() -> Column:
    return F.count(F.lit(1))


def rows_where(condition: Column) -> Column:
    """Number of rows where the condition holds; null counts as not."""
    return F.count_if(condition)


def volume_where(condition: Column, amount: Column | str) -> Column:
    """Exact sum of money over matching rows. It is 0 when none matches, and null only where every row
    of the group matches without an amount."""
    return F.try_sum(F.when(condition, cents(amount)).otherwise(F.lit(0))) / F.lit(100.0)


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.try_divide(part, whole) * 100, digits)


def fraction(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(F.try_divide(part, whole), digits)
