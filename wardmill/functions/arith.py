"""Rounding and division rules shared by all plans.

Ratios are computed on decimals and rounded half away from zero. Averages are sum / count of the
non-null values: ``avg`` on a decimal keeps only four extra digits, so rounding it rounds twice.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY_SUM = "decimal(24,2)"
WHOLE = "decimal(20,0)"


def money_mean(total: Column, n: Column, scale: int = 2) -> Column:
    return F.round(total.cast(MONEY_SUM) / F.nullif(n.cast(WHOLE), F.lit(0)), scale)


def whole_mean(total: Column, n: Column, scale: int = 1) -> Column:
    return F.round(total.cast(WHOLE) / F.nullif(n.cast(WHOLE), F.lit(0)), scale)


def share_pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """100 * part / whole for counts; NULL when there is no whole."""
    return F.round(part.cast(WHOLE) * 100 / F.nullif(whole.cast(WHOLE), F.lit(0)), scale)


def growth_pct(current: Column, previous: Column, scale: int = 2) -> Column:
    return F.round((current - previous) * 100 / F.nullif(previous, F.lit(0)), scale)


def divide_or_zero(a: Column, b: Column) -> Column:
    """Quotient as double; 0 when it is undefined or blank."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def clip(value: Column, low: int, high: int) -> Column:
    """NULL stays NULL (``greatest``/``least`` alone would return the bound)."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))
