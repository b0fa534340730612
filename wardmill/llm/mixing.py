"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is a line of words: its documents in order of a hash, cut into blocks of ``BLOCK`` words. The targets
give each source an exact number of blocks, whole passes first and then a part of a pass. A binary tree over
the output shards splits these quotas: at every node the blocks that go left are divided among the sources as a
draw without replacement would, so each shard is a fair sample of the mix and all quotas are met exactly. A
source's blocks are dealt to the shards along a permutation of their numbers, so draws are disjoint and no block
has to be sorted to know where it goes. Inside its shard a block's place follows a hash.

The driver holds one row for each source and its quotas by shard: at most ``MOST_SOURCES`` times ``SHARDS`` numbers.
"""

from __future__ import annotations

import json
import math
import random
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardmill.operators.ranking import running_totals

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
#: A source is taken at most so many times.
REPEATS = 2
BLOCK = 512
SHARDS = 64
#: Sources are a category with a weight each; with more the run fails.
MOST_SOURCES = 10_000
SEED = 20240229


def sized(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as (doc_id, source, size, key): size in words, key a hash that orders a source."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id, source = F.col("doc_id").cast("long"), F.col("source").cast("string")
    return docs.select(
        doc_id.alias("doc_id"),
        source.alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.xxhash64(F.lit(SEED), doc_id, text).alias("key"),
    )


def targets(sizes: list[int], weights: list[int], share: Fraction = SHARE, repeats: int = REPEATS) -> list[Fraction]:
    """``share`` of all sizes by weight; a target stops at ``repeats`` times its source's size and what is over
    goes to the others by weight, until none is above."""
    out, left = [Fraction(0)] * len(sizes), sum(sizes) * share
    free = list(range(len(sizes)))
    while free:
        unit = left / sum(weights[s] for s in free)
        full = [s for s in free if unit * weights[s] > repeats * sizes[s]]
        if not full:
            for s in free:
                out[s] = unit * weights[s]
            break
        for s in full:
            out[s] = Fraction(repeats * sizes[s])
            left -= out[s]
        free = [s for s in free if unit * weights[s] <= repeats * sizes[s]]
    return out


def drawn(rng: random.Random, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement from ``good + bad`` are good.

    By inversion from the mode where the spread is small, else by the normal curve, rounded and held to what is
    possible; either way the counts of a split add up exactly.
    """
    total, low, high = good + bad, max(0, n - bad), min(n, good)
    if low == high:
        return low
    mean = n * good / total
    variance = mean * (bad / total) * ((total - n) / max(total - 1, 1))
    if variance > 10_000:
        return min(max(round(rng.gauss(mean, math.sqrt(variance))), low), high)

    def ways(a: int, b: int) -> float:
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    up = down = math.exp(ways(good, mode) + ways(bad, n - mode) - ways(total, n))
    left = rng.random() - up
    right, below = mode, mode
    while left > 0 and (right < high or below > low):
        if right < high:
            up *= (good - right) * (n - right) / ((right + 1) * (bad - n + right + 1))
            right += 1
            left -= up
            if left <= 0:
                return right
        if below > low:
            down *= below * (bad - n + below) / ((good - below + 1) * (n - below + 1))
            below -= 1
            left -= down
            if left <= 0:
                return below
    return mode


def split(quotas: list[int], shards: int, seed: int = SEED) -> list[list[int]]:
    """For every shard its number of blocks of every source. Shards hold equal numbers of blocks, give or take one."""
    out: list[list[int]] = [[] for _ in range(shards)]
    nodes = [(0, shards, list(quotas))]
    while nodes:
        first, past, held = nodes.pop()
        if past - first == 1:
            out[first] = held
            continue
        middle = (first + past) // 2
        rng = random.Random(f"{seed}:{first}:{past}")
        total = sum(held)
        # blocks of a subtree: those of its shards, of which the first ``total % shards`` hold one more
        to_left = total // (past - first) * (middle - first) + min(total % (past - first), middle - first)
        left, rest = [], total
        for q in held:
            x = drawn(rng, q, rest - q, to_left)
            left.append(x)
            rest -= q
            to_left -= x
        nodes += [(first, middle, left), (middle, past, [q - x for q, x in zip(held, left)])]
    return out


def plan(sources: list[tuple[str | None, int]], shards: int, block: int = BLOCK) -> list[dict]:
    """For every source, in order of code points and null last, what its rows need to know.

    A pass has ``blocks`` blocks; all are whole but the last, which keeps its place at the end of a pass. The
    others are permuted by ``(a b + c) mod (blocks - 1)``. ``passes`` whole passes are taken, then ``some`` blocks
    of another and ``words`` of the next. ``upto`` are the draws up to and with every shard.
    """
    sources = sorted(sources, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    weights = [WEIGHTS[k % len(WEIGHTS)] for k in range(len(sources))]
    out, before = [], 0
    for (name, size), target in zip(sources, targets([n for _, n in sources], weights)):
        rng = random.Random(f"{SEED}:{len(out)}")
        passes, over = divmod(round(target), size) if size else (0, 0)
        blocks = -(-size // block)
        some = min(over // block, max(blocks - 1, 0))
        whole = max(blocks - 1, 1)
        a = next(x for x in iter(lambda: rng.randrange(1, whole + 1), None) if math.gcd(x, whole) == 1)
        out.append(
            {
                "name": name, "size": size, "target": float(target), "before": before, "blocks": blocks, "a": a,
                "c": rng.randrange(whole), "passes": passes, "some": some, "words": over - some * block,
            }
        )
        before += size
    dealt = split([s["passes"] * s["blocks"] + s["some"] + (s["words"] > 0) for s in out], shards)
    for k, s in enumerate(out):
        upto = 0
        s["upto"] = [upto := upto + held[k] for held in dealt]
    return out


def _spans(block: int) -> Column:
    """What the mix takes of a row: array of (pass, block, shard, place, first_word, n_words).

    The row's words are offset .. offset + size - 1 of its source.
    """
    offset, size = F.col("offset"), F.col("size")

    def place(b: Column) -> Column:  # of a block in a pass; products may pass 64 bits
        whole = F.greatest(F.col("s.blocks") - 1, F.lit(1)).cast("decimal(19,0)")
        moved = (F.col("s.a").cast("decimal(19,0)") * b.cast("decimal(19,0)") + F.col("s.c")) % whole
        return F.when(b == F.col("s.blocks") - 1, b).otherwise(moved.cast("long"))

    def span(b: Column, at: Column, n: Column) -> Column:
        rank = place(b)
        draw = n * F.col("s.blocks") + rank
        past = F.least((b + 1) * block, offset + size)
        first = F.greatest(b * block, offset)
        part = F.least(past, b * block + F.col("s.words"))
        end = F.when((n == F.col("s.passes")) & (rank == F.col("s.some")), part).otherwise(past)
        shard = F.size(F.filter("s.upto", lambda u: u <= draw))
        taken = (n < F.col("s.passes")) | ((n == F.col("s.passes")) & (rank <= F.col("s.some")))
        return F.when(
            taken & (end > first),
            F.struct(
                n.cast("int").alias("pass"), b.alias("block"), shard.alias("shard"),
                F.xxhash64(F.lit(SEED), F.col("source"), draw).alias("place"),
                (first - offset).alias("first_word"), (end - first).alias("n_words"),
            ),
        )

    blocks = F.sequence(F.expr(f"offset div {block}"), F.expr(f"(offset + size - 1) div {block}"))
    passes = F.sequence(F.lit(0), F.lit(REPEATS))
    every = F.flatten(F.transform(blocks, lambda b: F.transform(passes, lambda n: span(b, b, n.cast("long")))))
    return F.when(size > 0, F.filter(every, lambda x: x.isNotNull()))


def mix(docs: DataFrame, shards: int = SHARDS, block: int = BLOCK) -> DataFrame:
    """Every row of ``docs`` as (doc_id, source, size, source_size, target, taken, spans).

    taken: the words that the mix takes of the row, repeats counted, never more than ``REPEATS`` times its size.
    spans: the runs of words taken, each with pass, block, output shard, its place there (rows sort by it), first
    word and number of words. Null and empty texts have no words and no spans; rows without a source are a
    source of their own; rows without a doc_id and rows repeated in full count as so many rows. An empty table
    gives no rows. Other columns are not read.
    """
    order = [F.asc_nulls_last("source"), F.asc("key"), F.asc_nulls_first("doc_id"), F.asc("size")]
    placed = running_totals(sized(docs), order, {"upto": F.col("size")})
    totals = placed.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows = plan([(r["source"], r["size"]) for r in totals], shards, block)
    kind = (
        "array<struct<name: string, size: long, target: double, before: long, blocks: long, a: long, c: long, "
        "passes: long, some: long, words: long, upto: array<long>>>"
    )
    known = docs.sparkSession.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), kind)).alias("s"))
    met = placed.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("s.name")))
    met = met.withColumn("offset", F.col("upto") - F.col("size") - F.col("s.before"))
    found = met.withColumn("spans", _spans(block))
    taken = F.aggregate(F.coalesce("spans", F.array()), F.lit(0).cast("long"), lambda n, x: n + x["n_words"])
    return found.select(
        "doc_id", "source", "size", F.col("s.size").alias("source_size"), F.col("s.target").alias("target"),
        taken.alias("taken"), "spans",
    )


def shuffled(mixed: DataFrame) -> DataFrame:
    """The mix itself: (shard, at, doc_id, source, first_word, n_words), at counting the spans of a shard from 0 in
    the order of their places. A shard is what one task writes, so its size is set by the number of shards."""
    spans = mixed.select("doc_id", "source", F.explode("spans").alias("x"))
    inside = Window.partitionBy("x.shard").orderBy("x.place", "x.pass", "x.block", "x.first_word", "doc_id")
    return spans.select(
        "x.shard", (F.row_number().over(inside) - 1).alias("at"), "doc_id", "source", "x.first_word", "x.n_words"
    )
