"""Exact, partition-independent aggregates and ratios.

Floating-point sums depend on the order rows arrive in, which differs between runs
on a cluster.  The helpers here keep the summation in integers (or wide decimals) and
divide once at the end, so a result is the same for any partitioning and equals the
same expression in another SQL engine bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as a decimal with 12 places, which keeps every digit of an amount up to
# 10^26, and rounded once, at output, to MONEY_DIGITS places.
MONEY_TYPE = "decimal(38,12)"
MONEY_DIGITS = 8


def money(amount: Column) -> Column:
    """An amount as an exact decimal; NULL for what is no finite amount (the load rule
    ``value_violations`` reports those)."""
    return amount.try_cast(MONEY_TYPE)


def money_out(total: Column) -> Column:
    """A decimal total back as a double, rounded."""
    return F.round(total.cast("double"), MONEY_DIGITS)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of an integral column whose rows count ``weight`` times: exact decimal sums,
    one division.  NULL values are skipped; a group without a value gives NULL."""
    total = F.sum((value.cast("decimal(20,0)") * weight.cast("decimal(18,0)")).cast("decimal(38,0)"))
    return total.cast("double") / F.sum(F.when(value.isNotNull(), weight))


def ratio_mean(numerator_sum: Column, denominator_sum: Column) -> Column:
    """``numerator / denominator`` of two already-summed integer columns; NULL when
    the denominator is 0 or NULL."""
    return numerator_sum.cast("double") / F.nullif(denominator_sum, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """``part * 100.0 / whole`` in double arithmetic; NULL when whole is 0."""
    return part.cast("double") * F.lit(100.0) / F.nullif(whole, F.lit(0)).cast("double")


def _floor_div(a: Column, b: Column) -> Column:
    """Floor division of non-negative integers by positive integers, exact."""
    return F.call_function("div", a, b)


def percent_rounded(part: Column, whole: Column, digits: int = 2) -> Column:
    """``ROUND(part * 100.0 / whole, digits)`` on exact numbers, half away from zero.

    Computed on integers: floor((2 * 100 * 10^d * part + whole) / (2 * whole)) / 10^d,
    which is exact decimal rounding of the rational part/whole for 0 <= part, whole > 0.
    Rounding the double instead would disagree at exact halves.
    """
    scale = 10 ** digits
    a = part.cast("decimal(30,0)") * F.lit(2 * 100 * scale) + whole
    b = whole.cast("decimal(30,0)") * F.lit(2)
    return _floor_div(a, b).cast("double") / F.lit(float(scale))
