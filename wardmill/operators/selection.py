"""Exact median of any numbers, by narrowing the range that holds it.

A double becomes a whole number of 64 bits in the same order. The rows are counted by the first ``STEP`` bits, the
prefix in which a middle row lies is kept, and the rows with that prefix are counted by their next bits, until
no bit is left. A count has at most 2**STEP groups however many rows or distinct values there are, all levels are
one lazy plan, and no task sorts or holds the values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

STEP = 16
_MOST = 0x7FFFFFFFFFFFFFFF
_DOUBLE = "java.lang.Double"


def ordered_bits(value: Column) -> Column:
    """The bits of a double as a long that sorts like it; NaN is above all, and -0.0 is 0.0."""
    number = F.coalesce(value.cast("double"), F.lit(0.0)) + F.lit(0.0)
    bits = F.java_method(F.lit(_DOUBLE), F.lit("doubleToLongBits"), number).cast("bigint")
    return F.when(value.isNotNull(), F.when(bits < 0, bits.bitwiseXOR(F.lit(_MOST))).otherwise(bits))


def from_bits(key: Column) -> Column:
    bits = F.coalesce(F.when(key < 0, key.bitwiseXOR(F.lit(_MOST))).otherwise(key), F.lit(0).cast("bigint"))
    return F.when(key.isNotNull(), F.java_method(F.lit(_DOUBLE), F.lit("longBitsToDouble"), bits).cast("double"))


def median(df: DataFrame, value: Column, out: str) -> DataFrame:
    """One row: the mean of the middle value or of the two middle ones; NULL without a value. Nulls are left out."""
    rows = df.select(ordered_bits(value).alias("key")).where("key is not null")
    shift = 64 - STEP
    counts = rows.groupBy(F.shiftright("key", shift).alias("prefix")).agg(F.count("*").alias("n"))
    every, along = Window.partitionBy(), Window.orderBy("prefix")
    counts = counts.select("prefix", "n", F.sum("n").over(along).alias("upto"), F.sum("n").over(every).alias("all"))
    middle = F.array(F.expr("(all - 1) div 2"), F.expr("all div 2"))
    found = counts.select("*", F.posexplode(middle).alias("which", "place"))
    while True:
        # one row for each of the two middle places
        here = found.where((F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("n")))
        here = here.select("which", F.col("prefix").alias("above"), (F.col("place") - F.col("upto") + F.col("n")).alias("place"))
        if shift == 0:
            return here.select(from_bits(F.col("above")).alias("value")).agg(F.avg("value").alias(out))
        inside = rows.join(F.broadcast(here), F.shiftright("key", shift) == F.col("above"))
        shift -= STEP
        counts = inside.groupBy("which", "place", F.shiftright("key", shift).alias("prefix")).agg(F.count("*").alias("n"))
        found = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("which").orderBy("prefix")))
