"""Near-duplicate documents by MinHash with tensored banding.

Two documents are linked when the Jaccard similarity of their sets of word shingles is at least
``PERCENT`` / 100. Candidates come from hash tables whose keys are pairs: one of ``SIDE`` keys of a first
collection with one of ``SIDE`` keys of a second, each made of ``ROWS`` minhashes. ``SIDE`` * ``SIDE``
tables of ``2 * ROWS`` minhashes so need ``2 * SIDE * ROWS`` minhashes, not ``SIDE * SIDE * 2 * ROWS``.
A pair at the threshold shares no table with probability ``2 * (1 - 0.75**ROWS)**SIDE`` (1e-4).

A key of either collection that a single set holds can make no shared table, so it is dropped before the
keys are paired. A bucket never becomes all its pairs: its members are compared with its smallest and its
largest member, each first with the one it meets most often; pairs that are then in one component need no
further comparison. Members that a bucket still holds in different components are all compared with each
other, in blocks of ``BLOCK`` by ``BLOCK`` that tasks share out: first by size and by a sketch that bounds
the difference of two sets from below, so that no link fails them. Every link is confirmed on the full sets.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardmill.llm import words
from wardmill.llm.common import in_batches, stored
from wardmill.llm.components import components

SHINGLE = 5
PERCENT = 75
SIDE, ROWS = 18, 3
#: Members of a bucket that are compared with as many others at once, and such pairs looked at together.
BLOCK, PAIRS = 1024, 1 << 17
#: 64-bit words of a sketch.
SKETCH = 16
_U = np.uint64
_rng = np.random.default_rng(75)
_FACTOR = (_rng.integers(1, 2**62, 2 * SIDE * ROWS, dtype=np.int64).astype(_U) << _U(1)) | _U(1)
_SHIFT = _rng.integers(1, 2**62, 2 * SIDE * ROWS, dtype=np.int64).astype(_U)


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, in order of text and hash, and their number by text."""
    rows = len(bounds) - 1
    low = words.LOWER[data]
    start, end, row = words.spans(low, bounds, words.SPACES)
    word = words.span_hashes(low, start, end)
    size = words.counts(row, rows)
    keys, owner = [], []
    gram = words.grams(word, SHINGLE)
    whole = row[: len(gram)] == row[SHINGLE - 1 :] if len(gram) else np.empty(0, bool)
    keys.append(gram[whole])
    owner.append(row[: len(gram)][whole])
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    for n in range(1, SHINGLE):
        short = np.flatnonzero(size == n)
        keys.append(words.grams(word, n)[begin[short]] if len(short) else np.empty(0, _U))
        owner.append(short)
    key, own = np.concatenate(keys), np.concatenate(owner)
    order = np.lexsort((key, own))
    key, own = key[order], own[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
    return key[new], words.counts(own[new], rows)


def collection_keys(keys: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """2 * SIDE keys for each set that begins at ``begin``; the lowest bit tells the collection."""
    out = np.empty((len(begin), 2 * SIDE), _U)
    for k in range(2 * SIDE):
        total = np.full(len(begin), _U(k + 1))
        for f, s in zip(_FACTOR[k * ROWS : (k + 1) * ROWS], _SHIFT[k * ROWS : (k + 1) * ROWS]):
            value = keys * f
            value += s
            total = words.mix(total + np.minimum.reduceat(value, begin))
        out[:, k] = (total & ~_U(1)) | _U(k >= SIDE)
    return out


@words.frugal
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, bounds in words.slices(batch.column("text")):
            keys, size = shingle_sets(data, bounds)
            full = np.flatnonzero(size)
            sums = np.zeros((2, len(size)), _U)
            table = np.empty((0, 2 * SIDE), _U)
            if len(full):
                begin = np.concatenate([[0], np.cumsum(size[full])[:-1]])
                sums[0][full] = np.add.reduceat(words.mix(keys + _U(1)), begin)
                sums[1][full] = np.add.reduceat(words.mix(keys ^ _U(0xA5A5A5A5A5A5A5A5)), begin)
                table = collection_keys(keys, begin)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    pa.array(size),
                    words.signed(sums[0]),
                    words.signed(sums[1]),
                    words.lists(table.reshape(-1).view(np.int64), np.where(size > 0, 2 * SIDE, 0)),
                ],
                names=["doc_id", "n_shingles", "s1", "s2", "keys"],
            )


@words.frugal
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, bounds in words.slices(batch.column("text")):
            keys, size = shingle_sets(data, bounds)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "th")), words.lists(keys.view(np.int64), size)],
                names=["node", "th", "shingles"],
            )


@words.frugal
def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and sketch of every set: for each class of shingles whether their number is odd. Two sets differ
    in at least one shingle of a class that is odd in one of them only."""
    classes = 64 * SKETCH
    for batch in batches:
        held = batch.column("shingles")
        size = held.value_lengths().to_numpy()
        kind = (words.mix(held.flatten().to_numpy().view(_U)) % _U(classes)).astype(np.int64)
        step = max(1, PAIRS // classes)
        end = np.cumsum(size)
        odd = []
        for lo in range(0, len(size), step):
            some = size[lo : lo + step]
            owner = np.repeat(np.arange(len(some)), some)
            place = owner * classes + kind[end[lo] - size[lo] : end[lo] - size[lo] + len(owner)]
            odd.append(np.packbits(np.bincount(place, minlength=len(some) * classes) & 1 == 1).reshape(-1, classes // 8))
        sketch = np.concatenate(odd) if odd else np.empty((0, classes // 8), np.uint8)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(size.astype(np.int64)), pa.array([x.tobytes() for x in sketch], pa.binary())],
            names=["node", "n", "sketch"],
        )


def _possible(group: np.ndarray, side: np.ndarray, node: np.ndarray, part: np.ndarray, n: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The pairs of nodes (2, any) that meet in a group, lie in different components and may be links."""
    past = np.searchsorted(group, group, "right")
    ahead = past - np.arange(len(group)) - 1
    total = np.concatenate([[0], np.cumsum(ahead)])
    out = []
    lo = 0
    while lo < len(group):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + PAIRS, "right")) - 1)
        a = np.repeat(np.arange(lo, hi), ahead[lo:hi])
        b = np.arange(len(a)) - np.repeat(total[lo:hi] - total[lo], ahead[lo:hi]) + a + 1
        # Blocks of one bucket meet across; the pairs inside a block are compared where it meets itself.
        open_ = (part[a] != part[b]) & ((side[a] != side[b]) | (side[a] < 0))
        open_ &= np.minimum(n[a], n[b]) * 100 >= PERCENT * np.maximum(n[a], n[b])
        a, b = a[open_], b[open_]
        apart = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int64)
        # 100 * both >= PERCENT * (all - both) with both <= (all - apart) / 2.
        near = (100 + PERCENT) * (n[a] + n[b] - apart) >= 2 * PERCENT * (n[a] + n[b])
        out.append(np.sort(np.stack([node[a[near]], node[b[near]]]), axis=0))
        lo = hi
    return np.unique(np.concatenate(out, axis=1), axis=1) if out else np.empty((2, 0), np.int64)


@words.frugal
def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates among rows that are in order of their group; a group may reach over batches."""
    names = ["bucket", "i", "j", "side", "node", "component", "n", "sketch"]
    held = None
    for batch in itertools.chain(batches, [None]):
        table = pa.Table.from_batches([b for b in (held, batch) if b is not None]).combine_chunks() if held or batch else None
        if table is None or not table.num_rows:
            continue
        bucket, i, j, side, node, part, n = (table.column(c).to_numpy() for c in names[:-1])
        new = np.ones(len(node), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        # The last group may go on in the next batch.
        stop = len(node) if batch is None else int(np.flatnonzero(new)[-1])
        held = table.slice(stop).to_batches()[0] if stop < len(node) else None
        if stop:
            raw = np.frombuffer(b"".join(table.column("sketch").slice(0, stop).to_pylist()), _U).reshape(-1, SKETCH)
            pairs = _possible(np.cumsum(new)[:stop], side[:stop], node[:stop], part[:stop], n[:stop], raw)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def similar(left: Column, right: Column) -> Column:
    both = F.size(F.array_intersect(left, right))
    return 100 * both >= PERCENT * (F.size(left) + F.size(right) - both)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) pairs that are links, judged on the full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    sizes = F.least(F.size("left"), F.size("right")) * 100 >= PERCENT * F.greatest(F.size("left"), F.size("right"))
    return pairs.join(left, "a").join(right, "b").where(sizes & similar(F.col("left"), F.col("right"))).select("a", "b").distinct()


def _labelled(frame: DataFrame, labels: DataFrame, node: str, out: str) -> DataFrame:
    """Add a node's component; a node without links is its own."""
    by = labels.select(F.col("node").alias(node), F.col("label").alias(out))
    return frame.join(by, node, "left").withColumn(out, F.coalesce(out, node))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    Uses the columns doc_id and text; others are ignored, whatever their names. A null text, or one without
    a word, has no shingles and is its own component. A row with a null doc_id is never linked: its
    component is null and it is kept. Repeated rows have one id, so they get the same component and are both
    kept or both not; rows with one id but different texts
    count as one document where a link names that id. An empty table
    gives an empty result. Texts of any length are read whole.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(
        given.transform(in_batches, _sign, "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>")
    )
    usable = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # Equal sets become one node, named after their smallest document.
    equal = stored(usable.groupBy("s1", "s2").agg(F.min("doc_id").alias("node")))
    members = usable.join(equal, ["s1", "s2"])
    nodes = stored(members.where(F.col("doc_id") == F.col("node")).select("node", "keys"))

    tables = _paired_keys(nodes)
    buckets = stored(
        tables.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    )
    met = tables.join(buckets, "bucket").select(F.explode(F.array("low", "high")).alias("a"), F.col("node").alias("b"))
    stars = stored(
        met.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .groupBy("a", "b").agg(F.count("*").alias("hits"))
    )
    labels = _linked(given, tables, stars)

    # The smallest document of a component is a node, as nodes are named after the smallest of their copies.
    named = _labelled(stored(equal), labels, "node", "component_id").select("s1", "s2", "component_id")
    judged = signed.select("doc_id", "n_shingles", "s1", "s2").join(stored(named), ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return judged.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _paired_keys(nodes: DataFrame) -> DataFrame:
    """(node, bucket): the tensored tables of every node, from keys that at least two nodes hold."""
    single = nodes.select("node", F.explode("keys").alias("key"))
    common = stored(
        single.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    )
    held = single.join(common, "key").groupBy("node").agg(F.collect_set("key").alias("keys"))
    first = F.filter("keys", lambda k: k.bitwiseAND(1) == 0)
    second = F.filter("keys", lambda k: k.bitwiseAND(1) == 1)
    halves = held.select("node", first.alias("first"), second.alias("second"))
    opened = halves.select("node", "second", F.explode("first").alias("one"))
    opened = opened.select("node", "one", F.explode("second").alias("two"))
    return stored(opened.select("node", F.xxhash64("one", "two").alias("bucket")))


def _across(tables: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """The distinct (a, b) that share a bucket, are in different components and can be links."""
    placed = _labelled(tables, labels, "node", "component")
    mixed = stored(
        placed.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count("*").alias("held"))
        .where("c1 < c2").select("bucket", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks"))
    )
    members = _labelled(tables.join(mixed, "bucket"), labels, "node", "component")
    sketches = sets.transform(in_batches, _sketches, "node long, n long, sketch binary").distinct()
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = members.join(sketches, "node").withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side"), "node", "component", "n", "sketch",
    )
    dealt = met.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return dealt.transform(in_batches, _compared, "a long, b long").distinct()


def _linked(given: DataFrame, tables: DataFrame, stars: DataFrame) -> DataFrame:
    """(node, label) from the verified links between candidates."""
    wanted = stored(stars.select(F.col("a").alias("doc_id")).union(stars.select(F.col("b").alias("doc_id"))).distinct())
    sets = stored(
        given.where(F.col("doc_id").isNotNull())
        .join(wanted, "doc_id", "left_semi")
        .select("doc_id", F.xxhash64("text").alias("th"), "text")
        .transform(in_batches, _sets, "node long, th long, shingles array<long>")
        .groupBy("node", "th").agg(F.any_value("shingles").alias("shingles"))  # repeated rows have one set
        .select("node", "shingles")
    )
    best = stars.groupBy("b").agg(F.max(F.struct("hits", (-F.col("a")).alias("minus"))).alias("top"))
    links = stored(_verified(best.select((-F.col("top.minus")).alias("a"), "b"), sets))
    labels = components(links)

    apart = _labelled(_labelled(stars, labels, "a", "ca"), labels, "b", "cb").where("ca <> cb")
    more = stored(_verified(apart.select("a", "b"), sets))
    if not more.isEmpty():
        links = stored(links.union(more))
        labels = components(links)

    # Buckets that still hold several components: all pairs across them.
    more = stored(_verified(stored(_across(tables, labels, sets)), sets))
    return labels if more.isEmpty() else components(stored(links.union(more)))
