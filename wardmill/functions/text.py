"""Report formatting and trigram similarity as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def dollars(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def plain_number(c: Column) -> Column:
    """Shortest decimal text: 16.70 -> 16.7, 16.00 -> 16.0."""
    return c.cast("double").cast("string")


def trigrams(c: Column) -> Column:
    """Set of three-letter pieces of each lower-case word, padded by two blanks before and one after."""
    words = F.filter(F.split(F.lower(c), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    pieces = F.transform(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) + 1),
            lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)),
        ),
    )
    return F.array_distinct(F.flatten(pieces))


def jaccard(a: Column, b: Column) -> Column:
    """Shared / all elements of two sets; 0 when both are empty."""
    return F.coalesce(
        F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0)
    )
