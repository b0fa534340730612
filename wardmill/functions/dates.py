"""Calendar expressions; "now" is always a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(c: str | Column) -> Column:
    return F.trunc(_col(c), "MONTH")


def quarter_of(c: str | Column) -> Column:
    return F.trunc(_col(c), "QUARTER")


def weekday_num(c: str | Column) -> Column:
    """Sunday = 0."""
    return (F.dayofweek(_col(c)) - 1).cast("int")


def weekday_name(number: str | Column) -> Column:
    """English day name, without blank padding, of a weekday number (2 January 2000 was a Sunday)."""
    return F.date_format(F.date_add(F.lit(dt.date(2000, 1, 2)), _col(number)), "EEEE")


def quarter_number(later: str | Column, earlier: str | Column) -> Column:
    """Quarters passed, counted from 1: the same quarter is 1."""
    return (F.floor(F.months_between(_col(later), _col(earlier)) / 3) + 1).cast("bigint")
