"""Amount, ratio and weight expressions.

Amounts stay DECIMAL, so sums are exact and do not depend on row order.
Ratios are DOUBLE, and null whenever the denominator is null or zero.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

RATIO = "double"


def fx_convert(amount: str | Column, rate: str | Column = "fx_rate") -> Column:
    """Native amount times base-per-native rate; null when either is missing."""
    a = F.col(amount) if isinstance(amount, str) else amount
    r = F.col(rate) if isinstance(rate, str) else rate
    return a * r


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast(RATIO), denominator.cast(RATIO))


def allocation_share(pct: Column) -> Column:
    """Percent 0..100 as a share; a missing percentage means the whole."""
    whole = F.lit(1).cast("decimal(8,4)")
    return F.coalesce((pct * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(8,4)"), whole)


def exact(amount: Column, kind: str) -> Column:
    """``amount`` as a decimal type; an amount that does not fit stops the job.

    With ANSI mode off a cast gives null instead, which sums would skip.
    """
    fitted = amount.try_cast(kind)
    lost = amount.isNotNull() & fitted.isNull()
    return F.when(lost, F.raise_error(F.lit(f"an amount does not fit {kind}")).cast(kind)
                  ).otherwise(fitted)


def sum_when(condition: Column, amount: Column) -> Column:
    """Sum of the matching amounts; null, not zero, when none match."""
    return F.sum(F.when(condition, amount))
