"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns; its name is a hash of 128 bits of that sequence, so the trie comes
from one grouping and no conversation is held in a task. Subtree totals are sums over trees of any depth: each
round rakes (the leaves give their totals to their parents and go) and compresses (in chains of nodes with one
child, every node that ranks below both neighbours is spliced out). A round is two joins on unique nodes
and a stored table; the live tree shrinks by a constant share of its leaves and chains, so a conversation of
n turns takes about log n rounds. Re-expansion then hands totals back to the spliced nodes by pointer jumping.

No step needs all turns of a conversation, all children of a node or all members of a node in one task: turns
are placed by range partitions, sums and counts are combined before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardmill.llm.common import in_batches, stored
from wardmill.llm.words import frugal

#: Turns whose hashes are combined by one window; longer conversations go block by block.
BLOCK = 1024
#: Ids written into one piece of the list of a node's conversations.
PIECE = 1 << 16
ROOT = bytes(16)
_UP = "bigint"


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, tokens): the turns of every conversation in order, pos from 0, text as two hashes.

    Ordered by turn, null first; rows of equal turn by role and then by the hashes of the row, so that repeated
    rows stand together. A null role or text is empty. Rows without a conv_id belong to no conversation and are
    left out; other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    given = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(text, F.char_length(role), role).alias("b"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "a", "b"]
    ranged = stored(given.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    # Of every range: its first and last conversation. A conversation goes on where the range before ended with it.
    held = ranged.groupBy("range", "conv_id").agg(F.count("*").alias("n"))
    edge = held.groupBy("range").agg(
        F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "n")).alias("last")
    ).select("range", "first", F.col("last.conv_id").alias("last"), F.col("last.n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("last").orderBy("range"))
    before = Window.orderBy("range")  # one row for each range
    shift = edge.withColumn("upto", upto).select(
        "range",
        F.col("first").alias("conv_id"),
        F.when(F.lag("last").over(before) == F.col("first"), F.lag("upto").over(before)).alias("shift"),
    ).where("shift is not null")
    inside = Window.partitionBy("range", "conv_id").orderBy(*order[1:])
    placed = ranged.withColumn("pos", F.row_number().over(inside).cast("long") - 1)
    placed = placed.join(F.broadcast(shift), ["range", "conv_id"], "left")  # at most a row for each range
    return placed.select("conv_id", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "a", "b", "tokens")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c after it took its first turns from conversation c - c % 20, as (conversations, turns).

    The first h = crc32(c) % 4 turns of that conversation come first (all if it has fewer, none if it is
    absent), then the own turns after the first h. Conversations: (conv_id, length). Turns: as ``placed``.
    ``placed`` is read several times: pass a stored table.
    """
    own = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    source = F.col("conv_id") - F.col("conv_id") % 20
    took = F.crc32(F.col("conv_id").cast("string")) % 4
    every = own.select("conv_id", "n", source.alias("source"), took.alias("h"))
    known = own.select(F.col("conv_id").alias("source"), F.col("n").alias("source_n"))
    every = every.join(known, "source", "left").withColumn("m", F.least("h", F.coalesce("source_n", F.lit(0))))
    every = stored(
        every.select(
            "conv_id", "source", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
        )
    )
    heads = placed.where("pos < 3 and conv_id % 20 = 0").withColumnRenamed("conv_id", "source")
    taken = every.join(heads, "source").where("pos < h").select("conv_id", "pos", "a", "b", "tokens")
    rest = placed.join(every.select("conv_id", "h", "m"), "conv_id").where("pos >= h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "a", "b", "tokens")
    return every.select("conv_id", "length"), taken.union(rest)


def _name(a: Column, b: Column) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in (a, b)]))


def prefixes(placed: DataFrame) -> DataFrame:
    """(conv_id, pos, node, parent, tokens): the node that a conversation is at after each of its turns.

    A node's name is the exclusive or of one hash for each turn and its place, block by block: the names inside a
    block in one window, the blocks' own sums in another.
    """
    block = F.floor(F.col("pos") / BLOCK)
    salted = stored(
        placed.select(
            "conv_id", "pos", "tokens", block.alias("block"),
            F.xxhash64("a", "pos").alias("a"), F.xxhash64("b", "pos").alias("b"),
        )
    )
    sums = salted.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("x"), F.bit_xor("b").alias("y"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "conv_id", "block", *[F.bit_xor(c).over(earlier).alias(c) for c in ("x", "y")]
    ).where("block > 0")
    upto = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = salted.select(
        "conv_id", "pos", "tokens", "block", "a", "b", F.bit_xor("a").over(upto).alias("u"), F.bit_xor("b").over(upto).alias("v")
    )
    whole = inside.join(sums, ["conv_id", "block"], "left")
    u, v = (F.col(c).bitwiseXOR(F.coalesce(s, F.lit(0))) for c, s in (("u", "x"), ("v", "y")))
    return whole.select(
        "conv_id", "pos", _name(u, v).alias("node"),
        _name(u.bitwiseXOR(F.col("a")), v.bitwiseXOR(F.col("b"))).alias("parent"), "tokens",
    )


def trie(conversations: DataFrame, steps: DataFrame) -> DataFrame:
    """(node, parent, depth, conv_id, n_convs, tokens, worth): the root, whose parent is null, and every prefix.

    worth is the node's own part of the saved tokens. No conversations, no root.
    """
    inner = steps.groupBy("node").agg(
        F.any_value("parent").alias("parent"), (F.any_value("pos") + 1).alias("depth"),
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.any_value("tokens").alias("tokens"),
    )
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast(_UP).alias("depth"),
        "conv_id", "n_convs", F.lit(0).cast(_UP).alias("tokens"),
    )
    return inner.unionByName(root).withColumn("worth", (F.col("n_convs") - 1) * F.col("tokens"))


def _rank(node: str, depth: str, turn: int) -> Column:
    """Total order of the nodes for one round. By the trailing zeros of the depth first, which halves a chain of
    consecutive depths each round; every second round by a hash alone, for chains of any other depths."""
    d = F.col(depth)
    zeros = F.bit_count(d.bitwiseAND(-d) - 1) if turn % 2 else F.lit(0)
    return F.struct(zeros, F.xxhash64(F.col(node), F.lit(turn)), F.col(node))


def subtree_totals(tree: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """(node, name...): for each name, the sum of its expression over the node and all below it.

    ``tree`` has node, parent (null for a root) and depth. ``sums`` may use ``kids``, the number of children.
    """
    names = list(sums)
    spare = {n: f"over_{n}" for n in names}  # sums of nodes spliced out between a node and its parent
    kids = tree.where("parent is not null").groupBy(F.col("parent").alias("p")).agg(F.count("*").alias("kids"))
    live = tree.join(kids, F.col("node") == F.col("p"), "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
    live = live.select(
        "node", "parent", "depth", (F.col("depth") - 1).alias("parent_depth"), "kids",
        *[e.cast(_UP).alias(n) for n, e in sums.items()],
        *[F.lit(0).cast(_UP).alias(s) for s in spare.values()],
        F.lit(None).cast("binary").alias("gone"), *[F.lit(0).cast(_UP).alias(f"add_{n}") for n in names],
    )
    live = stored(live)
    rounds, turn = [live], 0
    while not live.where("kids > 0").isEmpty():
        turn += 1
        leaf = F.col("kids") == 0
        given = live.where("parent is not null").groupBy(F.col("parent").alias("p")).agg(
            F.count_if(~leaf).alias("left"),
            F.max(F.when(~leaf, F.struct("node", "depth"))).alias("child"),
            *[F.coalesce(F.sum(F.when(leaf, F.col(n) + F.col(spare[n]))), F.lit(0)).alias(f"got_{n}") for n in names],
        )
        raked = live.where("kids > 0").join(given, F.col("node") == F.col("p")).select(
            "node", "parent", "depth", "parent_depth", F.col("left").alias("kids"), F.col("child.node").alias("child"),
            F.col("child.depth").alias("child_depth"),
            *[(F.col(n) + F.col(f"got_{n}")).alias(n) for n in names], *spare.values(),
        )
        # Below both neighbours: never two neighbours at once. The root has no parent and stays.
        me = _rank("node", "depth", turn)
        low = (me < _rank("child", "child_depth", turn)) & (me < _rank("parent", "parent_depth", turn))
        low = (F.col("kids") == 1) & F.col("parent").isNotNull() & low
        raked = raked.withColumn("low", F.coalesce(low, F.lit(False)))
        spliced = raked.where("low").select(
            F.col("child").alias("c"), F.col("node").alias("s"), F.col("parent").alias("s_parent"),
            F.col("parent_depth").alias("s_parent_depth"),
            *[F.col(n).alias(f"s_{n}") for n in names], *[F.col(s).alias(f"s_{s}") for s in spare.values()],
        )
        live = raked.where("not low").join(spliced, F.col("node") == F.col("c"), "left")
        live = stored(
            live.select(
                "node", F.coalesce("s_parent", "parent").alias("parent"), "depth",
                F.coalesce("s_parent_depth", "parent_depth").alias("parent_depth"), "kids", *names,
                *[
                    (F.col(s) + F.coalesce(f"s_{n}", F.lit(0)) + F.coalesce(f"s_{s}", F.lit(0))).alias(s)
                    for n, s in spare.items()
                ],
                F.col("s").alias("gone"),
                *[(F.col(s) + F.coalesce(f"s_{n}", F.lit(0))).alias(f"add_{n}") for n, s in spare.items()],
            )
        )
        rounds.append(live)
    done = reduce(DataFrame.union, [r.where("kids = 0").select("node", *names) for r in rounds])
    links = [
        r.where("gone is not null").select(
            F.col("gone").alias("node"), F.col("node").alias("to"), *[F.col(f"add_{n}").alias(n) for n in names]
        )
        for r in rounds
    ]
    return _expanded(stored(done), stored(reduce(DataFrame.union, links)), names)


def _expanded(done: DataFrame, links: DataFrame, names: list[str]) -> DataFrame:
    """Totals of spliced nodes: their own part and the total of the node they lead to. A link leads to a node
    that stayed at least a round longer, so jumping over it halves the way that is left."""
    parts = [done]
    while not links.isEmpty():
        known = done.select(F.col("node").alias("k"), *[F.col(n).alias(f"k_{n}") for n in names])
        ahead = links.select(F.col("node").alias("j"), F.col("to").alias("j_to"), *[F.col(n).alias(f"j_{n}") for n in names])
        step = links.join(known, F.col("to") == F.col("k"), "left").join(ahead, F.col("to") == F.col("j"), "left")
        step = stored(
            step.select(
                "node", F.when(F.col("k").isNull(), F.col("j_to")).alias("to"),
                *[(F.col(n) + F.coalesce(f"k_{n}", f"j_{n}")).alias(n) for n in names],
            )
        )
        found = step.where("to is null").select("node", *names)
        parts.append(found)
        done = reduce(DataFrame.union, parts)
        links = step.where("to is not null")
    return done


@frugal
def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (node, conv_id) to (node, first, ids): the ids of a node in pieces, comma-joined."""
    node, ids = None, []

    def piece():
        columns = [pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])]
        return pa.RecordBatch.from_arrays(columns, names=["node", "first", "ids"])

    held = []
    for batch in batches:
        for n, c in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (n != node or len(ids) == PIECE):
                held.append(piece())
                ids = []
            node = n
            ids.append(c)
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if ids:
        yield piece()


@frugal
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of (node, first) to (node, ends_sha256), one piece in memory at a time."""
    node, state = None, None
    for batch in batches:
        out = []
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if n == node:
                state.update(b",")
            else:
                if state is not None:
                    out.append((node, state.hexdigest()))
                node, state = n, hashlib.sha256()
            state.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out])], names=["node", "ends_sha256"]
            )
    if state is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"]
        )


def ends(conversations: DataFrame, steps: DataFrame) -> DataFrame:
    """(node, ends_sha256) of every node at which a conversation ends.

    A digest has to run over the ids in order, but each range of ids is written out in a task of its own; the one
    that runs over a node's pieces reads one row for ``PIECE`` ids or each range.
    """
    last = steps.join(
        conversations.where("length > 0").select("conv_id", (F.col("length") - 1).alias("pos")), ["conv_id", "pos"]
    ).select("node", "conv_id")
    last = last.union(conversations.where("length = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    pieces = stored(last).repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = pieces.transform(in_batches, _written, "node binary, first long, ids string")
    ordered = pieces.repartition("node").sortWithinPartitions("node", "first")
    return ordered.transform(in_batches, _digests, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Rebuilt conversations without turns end at the root. An empty table, or one without any conv_id, has no nodes.
    """
    every, steps = rebuilt(stored(turns(conversations)))
    steps = stored(prefixes(steps))
    tree = stored(trie(every, steps))
    totals = subtree_totals(
        tree, {"n_leaves": (F.col("kids") == 0).cast(_UP), "saved_tokens": F.col("worth")}
    )
    parents = tree.select(F.col("node").alias("p"), F.col("conv_id").alias("parent_conv_id"))
    kids = tree.where("parent is not null").groupBy(F.col("parent").alias("k")).agg(F.count("*").alias("n_children"))
    found = tree.join(totals, "node").join(kids, F.col("node") == F.col("k"), "left")
    found = found.join(ends(every, steps), "node", "left").join(parents, F.col("parent") == F.col("p"), "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
