from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL, not an error, when the denominator is 0."""
    return F.try_divide(numerator, denominator)


def to_cents(value: Column) -> Column:
    """Two decimals, halves to the even neighbour."""
    return F.bround(value, 2)


def or_zero(total: Column) -> Column:
    """A sum over nothing but NULLs counts as 0 in the reports."""
    return F.coalesce(total, F.lit(0.0))
