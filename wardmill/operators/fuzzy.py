"""Fuzzy text search by trigram similarity: one text against a column, and two columns against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardmill.functions.text import jaccard, trigrams
from wardmill.session import durable


def search(df: DataFrame, column: str, wanted: str, threshold: float = 0.3) -> DataFrame:
    """Rows whose text resembles ``wanted``: a map-only scan with the similarity as a column."""
    score = jaccard(trigrams(F.col(column)), trigrams(F.lit(wanted)))
    return df.withColumn("similarity", F.round(score, 6)).where(score >= threshold)


#: Sets of more trigrams than this meet on single trigrams, as they have too many triples.
LONGEST = 30
#: Guards comparisons of a product with a whole number.
SLACK = 1e-9


def _sets(df: DataFrame, column: str, side: int) -> DataFrame:
    """(side, text, n_rows, grams) of every distinct text that has trigrams."""
    texts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("text")).agg(F.count("*").alias("n_rows"))
    return texts.select(F.lit(side).alias("side"), "text", "n_rows", trigrams(F.col("text")).alias("grams")).where(F.size("grams") > 0)


def _shared(grams: Column, count: int) -> Column:
    """(at, key) of every choice of ``count`` (1 or 3) trigrams: the place of the last one, and a hash of all."""
    if count == 1:
        return F.transform(grams, lambda x: F.struct(x["at"].alias("at"), F.xxhash64(x["gram"]).alias("key")))
    n = F.size(grams)

    def third(x: Column, y: Column, start: Column) -> Column:
        return F.transform(
            F.slice(grams, start, n), lambda z: F.struct(z["at"].alias("at"), F.xxhash64(x["gram"], y["gram"], z["gram"]).alias("key"))
        )

    return F.flatten(
        F.transform(
            grams,
            lambda x, i: F.flatten(F.transform(F.slice(grams, i + 2, n), lambda y, j: third(x, y, i + j + 3))),
        )
    )


def similar_pairs(left: DataFrame, right: DataFrame, left_column: str, right_column: str, threshold: float = 0.3) -> DataFrame:
    """(left_text, right_text, similarity, left_rows, right_rows): every pair of a distinct text of either side whose
    similarity is at least ``threshold`` (above 0), and how many rows hold each text.

    A set-similarity join. Trigrams are put in one order, those first that fewest pairs share; a trigram of one side
    only is first of all and is never looked up. Two sets that are similar enough share ``least`` trigrams, so if
    ``least`` is 3 or more, the first ``size - least + 3`` trigrams of each hold three that both have: they meet on
    triples, of which there are many even where single trigrams are common. Sets so small that fewer than three shared
    trigrams suffice, and pairs with a set of more than ``LONGEST`` trigrams, meet on single ones. A meeting is
    dropped if the sizes are too unlike, or if even all trigrams from there on would be too few. What is left is judged
    on the full sets. Texts are compared once however many rows hold them; a text without a letter or digit
    resembles nothing.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    spark = left.sparkSession
    both = _sets(left, left_column, 0).union(_sets(right, right_column, 1))
    sets = durable(both.withColumn("id", F.monotonically_increasing_id()).withColumn("size", F.size("grams")))
    smallest = {r["side"]: r["size"] for r in sets.groupBy("side").agg(F.min("size").alias("size")).collect()}  # a row a side
    held = sets.select("side", "id", "size", F.explode("grams").alias("gram"))
    known = held.groupBy("gram").agg((F.count_if(F.col("side") == 0) * F.count_if(F.col("side") == 1)).alias("n"))
    ordered = held.join(known, "gram").groupBy("side", "id", "size").agg(
        F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("order")  # the trigrams of one text
    )
    placed = F.transform("order", lambda g, i: F.struct(i.alias("at"), g["n"].alias("n"), g["gram"].alias("gram")))
    parts = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    index = durable(ordered.select("side", "id", "size", placed.alias("order")).repartition(parts, "id"))

    def least(a: Column, b: Column) -> Column:
        return F.ceil(threshold / (1 + threshold) * (a + b) - SLACK)

    def side(k: int, p: str, count: int) -> DataFrame:
        other = F.greatest(F.ceil(F.col("size") * threshold - SLACK), F.lit(smallest.get(1 - k, 1)))  # least size of a partner
        first = F.col("size") - least(F.col("size"), other) + count
        grams = F.filter("order", lambda g: (g["at"] < first) & (g["n"] > 0))
        found = index.where(F.col("side") == k).select("id", "size", F.explode(_shared(grams, count)).alias("s"))
        found = found.select("s.key", F.col("id").alias(f"{p}_id"), F.col("size").alias(f"{p}_size"), F.col("s.at").alias(f"{p}_at"))
        return found if count == 1 else found.where(F.col(f"{p}_size") <= LONGEST)

    def met(count: int) -> DataFrame:
        wanted = least(F.col("l_size"), F.col("r_size"))
        ahead = F.least(F.col("l_size") - F.col("l_at"), F.col("r_size") - F.col("r_at")) + count - 1
        alike = F.least("l_size", "r_size") >= F.greatest("l_size", "r_size") * threshold - SLACK
        by_three = (wanted >= 3) & (F.greatest("l_size", "r_size") <= LONGEST)
        l, r = (side(k, p, count).repartition(parts, "key") for k, p in ((0, "l"), (1, "r")))
        return l.join(r, "key").where((by_three if count == 3 else ~by_three) & alike & (ahead >= wanted)).select("l_id", "r_id")

    pairs = met(3)
    # single trigrams only where some pair needs them: sizes (of a side) that are long, or small with a small partner
    small = (3 - 1) * (1 + threshold) / threshold + 1
    needs = F.col("size") > LONGEST
    for k in (0, 1):
        needs |= (F.col("side") == k) & (F.col("size") + smallest.get(1 - k, 1) <= small)
    if not index.where(needs).isEmpty():
        pairs = pairs.union(met(1))
    pairs = pairs.distinct()

    def whole(k: int, p: str) -> DataFrame:
        return sets.where(F.col("side") == k).select(*[F.col(c).alias(f"{p}_{c}") for c in ("id", "text", "n_rows", "grams")])

    score: Column = jaccard(F.col("l_grams"), F.col("r_grams"))
    judged = pairs.join(whole(0, "l"), "l_id").join(whole(1, "r"), "r_id").withColumn("score", score)
    return judged.where(F.col("score") >= threshold).select(
        F.col("l_text").alias("left_text"), F.col("r_text").alias("right_text"), F.round("score", 6).alias("similarity"),
        F.col("l_n_rows").alias("left_rows"), F.col("r_n_rows").alias("right_rows"),
    )
