"""Sums of money that do not depend on the order of the rows.

Amounts are stored as doubles with two decimals. They are added up as whole cents in a long:
exact, any order gives the same total, and the aggregation stays in generated code, which a
wide decimal would leave.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """Whole cents, rounded beyond two decimals; null for NaN, infinities and what no long holds."""
    return F.rint(F.when(~F.isnan(amount), amount) * 100).try_cast("long")


def amount(total_cents: Column) -> Column:
    return total_cents / F.lit(100.0)


def total(value: Column) -> Column:
    """Exact sum of an amount column, as a double."""
    return amount(F.sum(cents(value)))
