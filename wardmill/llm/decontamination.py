"""Benchmark decontamination with a positional inverted index, in DataFrame functions only.

The index holds postings (term, document, position, words on both sides) of the terms that anchor the
benchmark: of every window of ``WINDOW`` item words the rarest term in the documents. An anchor's postings
are few, so the search begins with the shortest lists. A posting and an anchor that share the term are
offset-adjusted: the words to the left and right are compared along that alignment, and a run of at least
a window (a whole item, if it is shorter) is an exact phrase match. Its words are hit.

Only the benchmark's own terms are broadcast, in blocks of at most ``BLOCK`` item words; a larger benchmark
is searched block by block over the same stored words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardmill.llm.common import id_of, stored

WINDOW = 13
BLOCK = 1_000_000
#: A document is contaminated if one in so many of its words, or more, is hit.
SHARE = 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; none of a null text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def tokenized(docs: DataFrame) -> DataFrame:
    """(doc_id, id, th, n_words, words) of every document. A null doc_id has the largest id."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), id_of().alias("id"), F.xxhash64("text").alias("th"), words(F.col("text")).alias("words")
    ).withColumn("n_words", F.size("words").cast("long"))


def _left(array: str, at: Column) -> Column:
    """The words before a place, the nearest first, at most a window less one."""
    first = F.greatest(at - (WINDOW - 1), F.lit(0))
    return F.reverse(F.slice(array, first + 1, at - first))


def _right(array: str, at: Column) -> Column:
    return F.slice(array, at + 2, F.lit(WINDOW - 1))


def _agree(one: str, other: str) -> Column:
    """How many words two lists have in common from their start."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(WINDOW - 2)),
        F.lit(0),
        lambda n, i: F.when((n == i) & (F.get(F.col(one), i) == F.get(F.col(other), i)), n + 1).otherwise(n),
    )


def postings(tokens: DataFrame, terms: DataFrame, context: bool = False) -> DataFrame:
    """The index of the given terms (a bounded table): term, id, th, at, and the words around if asked for."""
    found = tokens.select("id", "th", "words", F.posexplode("words").alias("at", "term")).join(F.broadcast(terms), "term")
    around = [_left("words", F.col("at")).alias("left"), _right("words", F.col("at")).alias("right")] if context else []
    return found.select("term", "id", "th", "at", *around)


def frequencies(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, times) of the given terms in the documents; terms that do not occur are left out."""
    found = tokens.select(F.explode("words").alias("term")).join(F.broadcast(terms), "term")
    return found.groupBy("term").agg(F.count("*").alias("times"))


def anchors(items: DataFrame, times: DataFrame) -> DataFrame:
    """(item, item_id, n, at, term, item_left, item_right): the rarest term of every window of every item.

    A window with a term that no document has cannot occur and needs no anchor."""
    single = items.select("item", "item_id", "n", "words", F.posexplode("words").alias("at", "term")).join(times, "term", "left")
    span = Window.partitionBy("item").orderBy("at").rowsBetween(0, WINDOW - 1)
    rarest = F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), F.col("at").alias("at"))).over(span)
    begun = single.withColumn("rarest", rarest).where((F.col("at") <= F.col("n") - WINDOW) | (F.col("at") == 0))
    chosen = begun.where("rarest.times > 0").select("item", "item_id", "n", "words", F.col("rarest.at").alias("at")).distinct()
    return chosen.select(
        "item", "item_id", "n", "at", F.get("words", F.col("at")).alias("term"),
        _left("words", F.col("at")).alias("item_left"), _right("words", F.col("at")).alias("item_right"),
    )


def matches(index: DataFrame, anchored: DataFrame) -> DataFrame:
    """(id, th, item_id, first, past): words of documents that match a window of an item along an alignment."""
    met = index.join(F.broadcast(anchored.drop("at")), "term")
    met = met.withColumn("before", _agree("left", "item_left")).withColumn("after", _agree("right", "item_right"))
    met = met.where(F.col("before") + F.col("after") + 1 >= F.least(F.col("n"), F.lit(WINDOW)))
    return met.select(
        "id", "th", "item_id", (F.col("at") - F.col("before")).alias("first"), (F.col("at") + F.col("after") + 1).alias("past")
    )


def near(index: DataFrame, one: str, other: str, within: int) -> DataFrame:
    """(id, th, at, other_at): places where two terms stand at most ``within`` words apart, in any order.

    The places of the second term are met in cells of ``within`` words, the own cell and its neighbours."""
    cell = F.floor(F.col("at") / within)
    left = index.where(F.col("term") == one).select("id", "th", "at", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    right = index.where(F.col("term") == other).select("id", "th", F.col("at").alias("other_at"), cell.alias("cell"))
    apart = F.abs(F.col("at") - F.col("other_at"))
    return left.join(right, ["id", "th", "cell"]).where((apart <= within) & (apart > 0)).select("id", "th", "at", "other_at")


def _covered(spans: str) -> Column:
    """Number of words inside any of the sorted (first, past) spans."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("reach"))
    return F.aggregate(
        spans,
        start,
        lambda s, x: F.struct(
            (s["total"] + F.greatest(x["past"] - F.greatest(x["first"], s["reach"]), F.lit(0))).alias("total"),
            F.greatest(s["reach"], x["past"]).alias("reach"),
        ),
        lambda s: s["total"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) for every row of ``docs``; ``items`` are the sorted ids, as
    strings, of the items with a window that occurs.

    A null text has no words and is clean; an item without words is never found; an item with a null item_id
    hits words but is not listed. Rows repeated in full get the same result; rows with one id but different
    texts are judged each. Empty tables give no rows, or no hits. Other columns are not read.
    """
    tokens = stored(tokenized(docs))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    items = stored(items.where(F.size("words") > 0).withColumn("n", F.size("words")).withColumn("item", F.xxhash64("item_id", "words")))
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks, found = -(-total // block), []
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        terms = part.select(F.explode("words").alias("term")).distinct()
        anchored = stored(anchors(part, stored(frequencies(tokens, terms))))
        index = stored(postings(tokens, anchored.select("term").distinct(), context=True))
        found.append(matches(index, anchored))
    out = tokens.select("doc_id", "id", "th", "n_words")
    if not found:
        return out.select(
            "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.lit(False).alias("contaminated")
        )
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    grouped = hits.groupBy("id", "th").agg(
        F.array_sort(F.collect_set(F.struct("first", "past"))).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    grouped = grouped.select("id", "th", _covered("spans").alias("n_hit"), "items")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.join(grouped, ["id", "th"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
