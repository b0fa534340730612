"""Keep-first by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def keep_first(df: DataFrame, keys: list[str], order_by: list[str] | None = None, copies: str | None = None) -> DataFrame:
    """First row per key in the given order, NULL first; remaining columns break ties. ``copies`` names
    a column for the number of rows the key had.

    The row is the minimum of a struct, which Spark aggregates inside every input partition before
    the shuffle: a key that holds a large part of the table sends one row per task. Rows that come from
    files and are to be kept in file order need the scan's ``position`` as ``order_by``.
    """
    order_by = order_by or []
    rest = [*order_by, *[c for c in df.columns if c not in keys and c not in order_by]]
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"), *counted)
    return first.select(
        *[c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns], *([copies] if copies else [])
    )
