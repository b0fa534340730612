"""Prefix trie, centroid clustering and source mixing against brute force, with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from wardmill.llm import centroids, conversation_trie as trie, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple(map(str, r)))


# Conversations

def talk(spark, data):
    schema = "conv_id long, turn long, role string, text string, node string, kids int"
    return spark.createDataFrame([(*r, "x", 1) for r in data], schema)


def nodes_by_hand(data):
    held = defaultdict(list)
    for c, t, role, text in data:
        if c is not None:
            held[c].append(((t is not None, t or 0), role or "", text or ""))
    turns = {c: [(r, x) for _, r, x in sorted(v)] for c, v in held.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    member = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            member[tuple(seq[:d])].append(c)
    kids = Counter(n[:-1] for n in member if n)
    leaves, saved = Counter(), Counter()
    for n, m in member.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(m) - 1) * (len(WORD.findall(n[-1][1])) if n else 0)
            leaves[n[:d]] += not kids[n]
    out = []
    for n, m in member.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(n))
        up = min(member[n[:-1]]) if n else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(n), up, len(m), kids[n], leaves[n], saved[n], digest))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def test_trie_with_odd_rows(spark):
    rnd = random.Random(3)
    data = []
    for c in [*range(-25, 90), 1000, 2001]:
        for t in range(rnd.randrange(1, 6)):
            text = rnd.choice(["hello there", "hello  there", "", "a b c", None, "x" * 9000, "é z"])
            data.append((c, rnd.choice([t, None, 0]) if c % 7 == 0 else t, rnd.choice(["user", "assistant", None]), text))
    data += data[:5]  # repeated rows
    data += [(None, 0, "user", "hello there"), (None, None, None, None)]
    # a long conversation with children along the way
    data += [(400, t, "user", f"step {t}") for t in range(150)]
    data += [(400 + k, t, "user", f"step {t}") for k in (1, 2, 3) for t in range(40 * k)]
    ties = [(5000, 1, "user", "b"), (5000, 1, "assistant", "a")]  # equal turns: by role first
    assert rows(trie.prefix_trie(talk(spark, data + ties))) == nodes_by_hand(data + ties)


def test_trie_of_nothing(spark):
    for data in ([], [(None, 1, "user", "x")]):
        out = trie.prefix_trie(talk(spark, data))
        assert out.count() == 0 and out.columns[0] == "conv_id"


@pytest.mark.parametrize("shape", ["path", "star", "caterpillar", "random", "binary"])
def test_tree_contraction(spark, shape):
    from pyspark.sql import functions as F

    rnd = random.Random(shape)
    n = 120
    parent = {
        "path": lambda k: k - 1,
        "star": lambda k: 0,
        "caterpillar": lambda k: k - 1 - (k % 2 == 0 and k > 1),
        "random": lambda k: rnd.randrange(k),
        "binary": lambda k: (k - 1) // 2,
    }[shape]
    up = [None] + [parent(k) for k in range(1, n)]
    depth = [0] * n
    for k in range(1, n):
        depth[k] = depth[up[k]] + 1
    name = lambda k: None if k is None else k.to_bytes(16, "big")
    tree = spark.createDataFrame([(name(k), name(up[k]), depth[k], k * k) for k in range(n)], "node binary, parent binary, depth long, v long")
    total, ends = [k * k for k in range(n)], [0] * n
    inner = set(up)
    for k in reversed(range(n)):
        ends[k] += k not in inner
        if k:
            total[up[k]] += total[k]
            ends[up[k]] += ends[k]
    found = trie.subtree_totals(tree, {"v": F.col("v"), "ends": (F.col("kids") == 0).cast("long")})
    got = {int.from_bytes(r["node"], "big"): (r["v"], r["ends"]) for r in found.collect()}
    assert got == {k: (total[k], ends[k]) for k in range(n)}


def test_long_lists_of_ends_are_pieced(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    data = [(c, 0, "user", "same") for c in range(100, 130)]
    assert rows(trie.prefix_trie(talk(spark, data))) == nodes_by_hand(data)


def test_long_conversations_go_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    data = [(c, t, "user", f"{t * (c % 3 + 1)}") for c in (20, 21, 22, 23, 24) for t in range(30)]
    assert rows(trie.prefix_trie(talk(spark, data))) == nodes_by_hand(data)


# Centroids

def vectors(spark, data):
    return spark.createDataFrame([(*r, 1, "x") for r in data], "vec_id long, embedding array<double>, cluster int, v string")


def clusters_by_hand(data, clusters=40, rounds=5):
    kept = []
    for i, v in data:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            lim = centroids.LIMIT
            kept.append((i, [math.floor(min(max(256 * x, -lim), lim)) for x in v]))
    key = [(i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept]
    cent = [v for _, _, v in sorted(key)[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cent))
    for _ in range(rounds):
        group = defaultdict(list)
        for _, v in kept:
            group[near(v)[1]].append(v)
        for k, held in group.items():
            cent[k] = [sum(x) // len(held) for x in zip(*held)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    own = Counter()
    for _, k, d in found:
        own[k] += d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    out = [(i, k, d, own[k], sum(own.values()), name[k]) for i, k, d in found]
    return sorted(out, key=lambda r: tuple(map(str, r)))


def test_centroids_with_odd_rows(spark):
    rnd = random.Random(4)
    middle = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    data = [(k, [x + rnd.gauss(0, 0.3) for x in rnd.choice(middle)]) for k in range(150)]
    data += data[:4] + [(200 + k, data[7][1]) for k in range(60)]  # repeated rows, one very common vector
    data += [(300, [0.0] * 64), (301, [1e300] + [0.0] * 63), (302, [-0.001] * 64), (None, [0.5] * 64), (None, [0.5] * 64)]
    data += [(400, None), (401, []), (402, [1.0] * 63), (403, [1.0] * 65), (404, [None] + [1.0] * 63)]
    data += [(405, [math.nan] * 64), (406, [math.inf] + [0.0] * 63)]
    found = centroids.with_inertia(*centroids.cluster(vectors(spark, data).repartition(5)))
    assert rows(found) == clusters_by_hand(data)


def test_few_and_no_vectors(spark):
    few = [(k, [float(k % 2)] * 64) for k in range(5)]
    assert rows(centroids.with_inertia(*centroids.cluster(vectors(spark, few)))) == clusters_by_hand(few)
    none = centroids.with_inertia(*centroids.cluster(vectors(spark, [(1, [1.0])])))
    assert none.count() == 0 and none.columns[-1] == "centroid_sha256"


def test_orchard_finds_the_nearest_and_skips(spark):
    rng = np.random.default_rng(2)
    cent = np.concatenate([rng.integers(-50, 50, (10, 8)) + 1000 * k for k in range(4)]).astype(np.int64)
    data = cent[rng.integers(0, 40, 500)] + rng.integers(-5, 6, (500, 8))
    data[:40] = (cent + cent[::-1]) // 2  # between centroids: ties
    apart = ((data[:, None] - cent[None]) ** 2).sum(axis=2)
    best, distance = centroids.search(data, cent, *centroids.neighbours(cent))
    assert (best == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


# Mixing

def docs(spark, data):
    return spark.createDataFrame([(*r, 1, "x") for r in data], "doc_id long, text string, source string, size int, spans string")


def check_mix(mixed, data):
    found = mixed.collect()
    size = lambda t: len(WORD.findall(t or ""))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["doc_id"], r["size"], r["source"]) for r in found), key=key) == sorted(((d, size(t), s) for d, t, s in data), key=key)
    names = sorted({s for _, _, s in data}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size(t) for _, t, x in data if x == s) for s in names}
    # Targets, share by share, as the contract words it.
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    budget, want = 1.5 * sum(total.values()), {}
    while len(want) < len(names):
        free = [s for s in names if s not in want]
        unit = (budget - sum(want.values())) / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > 2 * total[s]]
        want |= {s: 2 * total[s] for s in over} if over else {s: unit * weight[s] for s in free}
    for r in found:
        assert r["source_size"] == total[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        used = Counter()
        for x in r["spans"] or []:
            assert 0 <= x["first_word"] and x["first_word"] + x["n_words"] <= r["size"] and x["n_words"] > 0
            for w in range(x["first_word"], x["first_word"] + x["n_words"]):
                used[w, x["pass"]] += 1
        assert max(used.values(), default=1) == 1 and sum(used.values()) == r["taken"]
    for s in names:
        assert abs(sum(r["taken"] for r in found if r["source"] == s) - want[s]) <= 1
    return found


def some_docs():
    rnd = random.Random(6)
    data = [(k, "w " * rnd.choice([0, 1, 5, 40, 700]), rnd.choice("abcdefg")) for k in range(300)]
    data += [(1000 + k, "hot words here " * 20, "hot") for k in range(150)]  # a third of all rows
    data += [(2000, "one " * 30000, "long"), (2001, None, "long"), (2002, "", "empty"), (2003, " \t", None)]
    data += [(None, "no id", None), (None, "no id", None), (7, "same id", "a"), (7, "same id", "a"), (2005, "x y", "")]
    return data


def test_mix(spark):
    data = some_docs()
    mixed = mixing.mix(docs(spark, data).repartition(4), shards=8, block=64)
    found = check_mix(mixed, data)
    again = mixing.mix(docs(spark, data).repartition(7), shards=8, block=64)
    key = lambda r: tuple(map(str, r))
    assert sorted(found, key=key) == sorted(again.collect(), key=key)  # reruns agree, however rows are dealt
    out = mixing.shuffled(mixed).collect()
    assert len(out) == sum(len(r["spans"] or []) for r in found)
    by_shard = defaultdict(list)
    blocks = defaultdict(set)
    for r in found:
        for x in r["spans"] or []:
            blocks[x["shard"]].add((r["source"], x["pass"], x["block"]))
    for r in out:
        by_shard[r["shard"]].append(r["at"])
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert sum(map(len, blocks.values())) == len(set().union(*blocks.values()))  # disjoint draws
    counts = [len(blocks[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1


def test_mix_of_little(spark):
    check_mix(mixing.mix(docs(spark, [(1, "", "a"), (2, None, None)])), [(1, "", "a"), (2, None, None)])
    assert mixing.mix(docs(spark, [])).count() == 0
    one = [(1, "a b c", "s")]
    assert check_mix(mixing.mix(docs(spark, one)), one)[0]["taken"] == round(4.5)


def test_splitting_tree():
    quotas = [5, 0, 1000, 70_000, 3 * 10**9]
    for shards in (1, 7, 64):
        dealt = mixing.split(quotas, shards)
        assert [sum(col) for col in zip(*dealt)] == quotas
        sizes = [sum(held) for held in dealt]
        assert max(sizes) - min(sizes) <= 1 and min(min(held) for held in dealt) >= 0
    # Draws follow the hypergeometric distribution.
    rng = random.Random(1)
    got = Counter(mixing.drawn(rng, 6, 10, 7) for _ in range(20000))
    for k in range(7):
        want = math.comb(6, k) * math.comb(10, 7 - k) / math.comb(16, 7)
        assert abs(got[k] / 20000 - want) < 0.015


def test_the_tree_has_no_python_on_its_main_path(spark):
    plan = mixing.mix(docs(spark, some_docs()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", ["op11_conversation_trie", "op12_centroid_clustering", "op13_source_mixing"])
def test_registered_rows(spark, name):
    root = "/root/testdata/sf0.001"
    found = entry.queries()[name](spark, root)
    if name.startswith("op11"):
        data = [tuple(r) for r in spark.read.parquet(f"{root}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert rows(found) == nodes_by_hand(data)
    elif name.startswith("op12"):
        data = [tuple(r) for r in spark.read.parquet(f"{root}/embeddings.parquet").select("vec_id", "embedding").collect()]
        assert rows(found) == clusters_by_hand(data)
    else:
        given = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text", "source")
        check_mix(mixing.mix(given), [tuple(r) for r in given.collect()])
        assert found.columns == ["doc_id", "size", "source_size", "target", "taken"]
