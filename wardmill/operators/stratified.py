"""Exact stratified samples: of every class the rows with the smallest hashes, as many as its share asks for.

The hash below which a class has k rows is found by narrowing: count the rows of each prefix of ``STEP`` hex digits,
keep the prefix in which the k-th row lies, and count its longer prefixes. A pass returns one row for each class, and
two or three passes settle any table, so no class is sorted or collected. Equal ids stand or fall together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

STEP = 4
#: A class is a category.
MOST_CLASSES = 1_000


def ordering(id_column: str, seed: int) -> Column:
    """The hash that orders rows: hex digits of the MD5 of id and seed."""
    return F.md5(F.concat_ws(":", F.col(id_column).cast("string"), F.lit(str(seed))))


def cuts(df: DataFrame, label: str, digest: Column, share: tuple[int, int]) -> dict:
    """For every class the text below which its first round(share * rows) digests lie (a half rounds up).

    ``share`` is a ratio of whole numbers. ``df`` is read a few times: pass a stored table. Rows without a
    class are a class of their own.
    """
    sizes = df.groupBy(F.col(label).alias("c")).agg(F.count("*").alias("n")).limit(MOST_CLASSES + 1).collect()
    if len(sizes) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    a, b = share
    return cuts_of(df, label, digest, {r["c"]: (2 * a * r["n"] + b) // (2 * b) for r in sizes})


def cuts_of(df: DataFrame, label: str, digest: Column, want: dict) -> dict:
    """For every class in ``want`` the text below which its first ``want[class]`` digests lie; a class has as many."""
    rows = df.select(F.col(label).alias("c"), digest.alias("d"))
    found = {c: "" for c, k in want.items() if k == 0}
    open_ = {c: ("", k) for c, k in want.items() if k > 0}
    length = 0
    while open_:
        length += STEP
        inside = reduce(
            lambda x, y: x | y, [F.col("c").eqNullSafe(F.lit(c)) & F.startswith("d", F.lit(p)) for c, (p, _) in open_.items()]
        )
        counts = rows.where(inside).groupBy("c", F.substring("d", 1, length).alias("p")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("c").orderBy("p"))  # at most 16**STEP prefixes of a class
        left = reduce(lambda x, c: x.when(F.col("c").eqNullSafe(F.lit(c)), open_[c][1]), open_, F.when(F.lit(False), 0))
        hit = counts.withColumn("upto", upto).where((F.col("upto") >= left) & (F.col("upto") - F.col("n") < left))
        open_now, open_ = open_, {}
        for r in hit.collect():
            c, k = r["c"], open_now[r["c"]][1]
            if r["upto"] == k or length >= 32:
                found[c] = r["p"] + "g"  # above every digest that begins so
            else:
                open_[c] = (r["p"], k - (r["upto"] - r["n"]))
    return found


def chosen(label: str, digest: Column, found: dict) -> Column:
    """Whether a row is in the sample that ``cuts`` describes."""
    start = F.when(F.lit(False), False)
    return F.coalesce(
        reduce(lambda x, c: x.when(F.col(label).eqNullSafe(F.lit(c)), digest < F.lit(found[c])), found, start), F.lit(False)
    )
