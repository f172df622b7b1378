"""Money and ratio expressions.

Sums are taken over DECIMAL so that they do not depend on the order in which
partitions arrive; ratios are rounded half-even to two places, as Python does.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def minor_to_major(amount: Column) -> Column:
    """Minor units (cents, paise) to major units."""
    return (amount.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def whole_units(amount: Column) -> Column:
    """Amount cut to whole units for display."""
    return amount.cast("bigint")


def pct2(part: Column, whole: Column) -> Column:
    """part as a percentage of whole, two decimals, 0 where there is no whole."""
    part, whole = part.cast("double"), whole.cast("double")
    return F.when(whole != 0, F.bround(part / whole * 100, 2)).otherwise(F.lit(0.0))


def rate2(part: Column, whole: Column) -> Column:
    """As pct2, multiplying before dividing."""
    part, whole = part.cast("double"), whole.cast("double")
    return F.when(whole != 0, F.bround(part * 100 / whole, 2)).otherwise(F.lit(0.0))


def avg2(total: Column, n: Column) -> Column:
    """Average of a DECIMAL sum, two decimals, 0 where there is nothing to average.

    Divided as DECIMAL, so that a tie at the third place is seen as one.
    """
    exact = F.try_divide(total.cast("decimal(24,2)"), n.cast("decimal(12,0)"))
    return F.coalesce(F.bround(exact, 2), F.lit(0)).cast("double")


def format_amount(amount: Column) -> Column:
    """Whole amount with grouped thousands; missing is ``0``."""
    return F.coalesce(F.format_number(amount.cast("bigint"), 0), F.lit("0"))
