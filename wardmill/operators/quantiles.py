"""Exact percentile of a money column by group, with bounded state.

``percentile`` keeps every distinct value of a group in one task. Here a first pass counts rows per
group and value bucket, the bucket that holds the wanted positions is found, and a second pass
counts the distinct cents inside that bucket only. A bucket spans ``BUCKET`` cents, so both counts
are bounded by the value range and not by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET = 1_000_000
MOST_GROUPS = 10_000


def percentile_cont(df: DataFrame, group: str, value: str, p: float, out: str) -> DataFrame:
    """(group, out): linear interpolation between the two neighbours of position p * (n - 1). ``group``
    is a category column with few values."""
    cents = (F.col(value) * 100).cast("bigint")
    rows = df.where(F.col(value).isNotNull()).select(
        group, cents.alias("_cents"), F.floor(cents / BUCKET).alias("_bucket")
    )
    coarse = rows.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    position = F.lit(p) * (F.col("_all") - 1)
    wanted = (
        coarse.withColumn("_all", F.sum("_n").over(whole))
        .withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        .withColumn("_low", F.floor(position))
        .withColumn("_high", F.ceil(position))
        .withColumn("_weight", position - F.col("_low"))
        .where((F.col("_high") >= F.col("_before")) & (F.col("_low") < F.col("_before") + F.col("_n")))
        .select(group, "_bucket", "_before", "_low", "_high", "_weight")
    )
    # at most two rows per group; more than MOST_GROUPS groups are an error
    few = F.count("*").over(Window.partitionBy()) <= 2 * MOST_GROUPS
    checked = F.when(few, F.col("_before")).otherwise(F.raise_error(F.lit(f"more than {MOST_GROUPS} groups")).cast("bigint"))
    fine = rows.join(F.broadcast(wanted.withColumn("_before", checked)), [group, "_bucket"])
    counted = fine.groupBy(group, "_bucket", "_before", "_low", "_high", "_weight", "_cents").agg(
        F.count(F.lit(1)).alias("_n")
    )
    inside = Window.partitionBy(group, "_bucket").orderBy("_cents").rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("_before") + F.sum("_n").over(inside) - F.col("_n")
    placed = counted.withColumn("_first", first).withColumn("_last", F.col("_first") + F.col("_n") - 1)

    def at(wanted_position: str) -> Column:
        hit = F.col(wanted_position).between(F.col("_first"), F.col("_last"))
        return F.max(F.when(hit, F.col("_cents")))

    low, high = at("_low"), at("_high")
    return placed.groupBy(group).agg(
        ((low + (high - low) * F.max("_weight")) / 100).alias(out)
    )
