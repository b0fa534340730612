"""Histogram trees against brute force, and exact stratified samples."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardmill import catalog
from wardmill.operators import packed, stratified, trees
from wardmill.plans import model


def derivatives(rows, margin):
    out = []
    for (x, y, w), m in zip(rows, margin):
        p = 1 / (1 + math.exp(-m))
        out.append((x, math.floor((p - y) * w * trees.UNIT + 0.5), math.floor(p * (1 - p) * w * trees.UNIT + 0.5)))
    return out


def best(held, s):
    """The best split of rows (x, g, h) on one feature: (gain, threshold), by trying every value."""
    def score(some):
        g, h = sum(r[1] for r in some) / trees.UNIT, sum(r[2] for r in some) / trees.UNIT
        return g * g / (h + s.penalty)

    out = None
    for x in sorted({r[0] for r in held}):
        left, right = [r for r in held if r[0] <= x], [r for r in held if r[0] > x]
        if min(len(left), len(right)) < s.least_rows or min(sum(r[2] for r in part) for part in (left, right)) / trees.UNIT < s.least_weight:
            continue
        gain = score(left) + score(right) - score(held)
        if gain > trees.LEAST_GAIN and (out is None or gain > out[0]):
            out = gain, x
    return out


def walk(held, node, s, out):
    g, h = sum(r[1] for r in held) / trees.UNIT, sum(r[2] for r in held) / trees.UNIT
    found = best(held, s) if node < 1 << s.depth else None
    out[node] = (found and found[1], -s.rate * g / (h + s.penalty), found[0] if found else 0.0, len(held))
    if found:
        walk([r for r in held if r[0] <= found[1]], 2 * node, s, out)
        walk([r for r in held if r[0] > found[1]], 2 * node + 1, s, out)


def leaf(x, nodes):
    node = 1
    while nodes[node][0] is not None:
        node = 2 * node + (x > nodes[node][0])
    return nodes[node][1]


def test_boosted_splits_equal_brute_force(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(400):
        x = float(rnd.choice([1, 2, 2, 2, 3, 5, 8, 13, 21, 34, 55]))
        y = int(rnd.random() < (0.9 if 3 <= x <= 13 else 0.2))
        rows.append((x, y, 3.0 if y else 1.0))
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id long, x double, y int, w double")
    s = trees.Settings(3, penalty=1.0, least_weight=1.0, rate=0.3)
    fitted = trees.fit_boosted(df.repartition(6), ["x"], "y", F.col("w"), 3, s)
    margin = [0.0] * len(rows)
    for t in range(3):
        want: dict = {}
        walk(derivatives(rows, margin), 1, s, want)
        got = {k: (x, v, g, n) for tree, k, _, x, v, g, n in fitted.nodes if tree == t}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][0] == want[k][0] and got[k][3] == want[k][3]
            assert got[k][1:3] == pytest.approx(want[k][1:3])
        margin = [m + leaf(x, want) for (x, _, _), m in zip(rows, margin)]
    score = {r["id"]: r["p"] for r in df.select("id", trees.probability(fitted).alias("p")).collect()}
    for k, m in enumerate(margin):
        assert score[k] == pytest.approx(1 / (1 + math.exp(-m)))
    again = trees.fit_boosted(df.repartition(3), ["x"], "y", F.col("w"), 3, s)
    assert again.nodes == fitted.nodes


def test_many_values_are_binned_and_missing_ones_go_left(spark):
    rnd = random.Random(9)
    data = [(k, rnd.random(), None if k % 10 == 0 else rnd.random(), 0) for k in range(2000)]
    data = [(k, a, b, int((b or 0.0) > 0.6)) for k, a, b, _ in data]
    df = spark.createDataFrame(data, "id long, a double, b double, y int")
    uppers = trees.bin_uppers(df, ["a", "b"], 16)
    assert [len(u) for u in uppers] == [16, 16] and uppers[0] == sorted(uppers[0])
    a = sorted(r[1] for r in data)
    assert uppers[0][-1] == a[-1] and all(abs(sum(x <= u for x in a) - 125 * (k + 1)) <= 1 for k, u in enumerate(uppers[0]))
    fitted = trees.fit_boosted(df, ["a", "b"], "y", F.lit(1.0), 2, trees.Settings(2, penalty=1.0, least_weight=1.0, rate=0.5), 16)
    assert fitted.nodes[0][2] == 1  # by b
    table = trees.node_table(fitted, spark).collect()
    assert table[0].feature == "b" and (table[0].left, table[0].right) == (2, 3)
    rates = df.groupBy(F.col("b").isNull().alias("missing"), "y").agg(F.avg(trees.probability(fitted)).alias("p")).collect()
    assert all(r.p < 0.5 if r.y == 0 else r.p > 0.5 for r in rates)
    imp = {r.feature: r.importance for r in trees.importances(fitted, spark).collect()}
    assert imp["b"] > imp["a"] and sum(imp.values()) == pytest.approx(1.0)


def test_forest_by_hand(spark):
    """Bootstrap counts, features on offer and leaves of a forest, row by row."""
    rnd = random.Random(10)
    data = [(k, float(rnd.randrange(6)), float(rnd.randrange(4)), 0) for k in range(300)]
    data = [(k, a, b, int(rnd.random() < (a + b) / 8)) for k, a, b, _ in data]
    df = spark.createDataFrame(data, "id long, a double, b double, y int")
    s = trees.Settings(2, least_rows=10, choose=1, seed=4)
    fitted = trees.fit_forest(df, ["a", "b"], "y", F.lit(1.0), "id", 5, s)
    shares = [math.exp(-1) * sum(1 / math.factorial(j) for j in range(k)) for k in range(1, 8)]
    for t in range(5):
        bag = []
        for k, a, b, y in data:
            d = int(hashlib.md5(f"4:{t}:{k}".encode()).hexdigest()[:8], 16)
            bag += [((a, b), y)] * sum(d >= int(x * 2**32) for x in shares)
        nodes = {k: (f, x, v, n) for tree, k, f, x, v, _, n in fitted.nodes if tree == t}

        def check(held, node):
            f, x, v, n = nodes[node]
            assert n == len(held) and v == pytest.approx(sum(y for _, y in held) / len(held))
            if node >= 4:
                assert f is None
                return
            offered = trees.chosen_features(t, node, 2, s)[0]
            found = best([(r[offered], -y * trees.UNIT, trees.UNIT) for r, y in held], s)
            assert (f, x) == ((offered, found[1]) if found else (None, None))
            if found:
                check([r for r in held if r[0][f] <= x], 2 * node)
                check([r for r in held if r[0][f] > x], 2 * node + 1)

        check(bag, 1)
    for r in df.select("id", "a", "b", trees.probability(fitted).alias("p")).limit(50).collect():
        total = 0.0
        for t in range(5):
            nodes = {k: (f, x, v) for tree, k, f, x, v, _, _ in fitted.nodes if tree == t}
            node = 1
            while nodes[node][0] is not None:
                node = 2 * node + ((r["a"], r["b"])[nodes[node][0]] > nodes[node][1])
            total += nodes[node][2]
        assert r["p"] == pytest.approx(total / 5)


@pytest.mark.parametrize("count", [3, trees.MOST_COLUMNS + 1])
def test_samples_are_drawn_once(spark, monkeypatch, count):
    """The levels of a forest read how often a tree drew a row; they do not hash the ids again."""
    seen = []
    monkeypatch.setattr(trees, "grow", lambda rows, *_: seen.append(rows) or [])
    df = spark.range(50).selectExpr("id", "double(id) AS x", "int(id % 2) AS y")
    trees.fit_forest(df, ["x"], "y", F.lit(1.0), "id", count, trees.Settings(2, seed=4))
    assert "md5" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    held = {(t, b[0]): n for t, b, n in seen[0].groupBy("tree", "bins").agg(F.sum("n")).collect()}
    want = df.select(F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("t"), "id")
    want = want.withColumn("n", trees.bag("id", F.col("t"), 4)).where("n > 0").collect()
    assert {(r.t, r.id): r.n for r in want} == held  # every row has a bin of its own


def test_bins_are_the_upper_ends_below_a_value(spark):
    nan, inf = float("nan"), float("inf")
    values = [None, nan, inf, -inf, 0.0, -0.0, 1.0, math.nextafter(1.0, 2.0), math.nextafter(1.0, 0.0), 5.0, 7.5, 9.0, -3.0]
    uppers = [[-3.0, 0.0, 1.0, 7.5], [1.0], [], [-inf, 0.0, inf], [1.0, nan], [nan], [inf]]
    df = spark.createDataFrame([(k, v, *[v] * 6) for k, v in enumerate(values)], "id int, " + ", ".join(f"c{k} double" for k in range(7)))
    got = trees._binned(df, [f"c{k}" for k in range(7)], uppers)
    assert got.columns == [*df.columns, "bins"] and "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()

    def below(u, v):  # as Spark compares: NaN is above all numbers
        return v is not None and u == u and (v != v or u < v)

    for r in got.collect():
        assert r.bins == [sum(below(u, values[r.id]) for u in up) for up in uppers], values[r.id]


def test_a_level_is_one_pass_and_the_roots_need_none(spark, monkeypatch):
    rnd = random.Random(12)
    data = [([rnd.randrange(4), rnd.randrange(3)], k % 2) for k in range(200)]
    rows = spark.createDataFrame(data, "bins array<int>, tree int")
    rows = rows.selectExpr("tree", "bins", "bigint((bins[0] - 1) * 1048576) g", "bigint(1048576) h", "bigint(1) n")
    passes = []
    collect = type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: passes.append(1) or collect(df))
    uppers = [[0.0, 1.0, 2.0, 3.0], [0.0, 1.0, 2.0]]
    nodes = trees.grow(rows, [0, 1, 2], uppers, trees.Settings(2, penalty=1.0))
    assert len(passes) == 2 and {t for t, *_ in nodes} == {0, 1}
    assert [n[6] for n in nodes if n[1] == 1] == [100, 100]
    kept = trees.grow(rows, [0, 1], uppers, trees.Settings(2, least_rows=101))  # no split: roots alone
    assert [(t, k, f, n) for t, k, f, *_, n in kept] == [(0, 1, None, 100), (1, 1, None, 100)]
    monkeypatch.undo()
    tree = [n for n in nodes if n[0] == 0]
    got = trees._with_leaf(rows.withColumn("id", F.lit(1)), tree, uppers, 2).select("bins", "leaf")
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    by_node = {k: (f, x, v) for _, k, f, x, v, _, _ in tree}
    for bins, value in got.collect():
        node = 1
        while by_node[node][0] is not None:
            node = 2 * node + (bins[by_node[node][0]] > by_node[node][1])
        assert value == by_node[node][2]


def test_features_and_bags_are_spread():
    s = trees.Settings(2, choose=2, seed=1)
    seen = Counter(f for t in range(50) for f in trees.chosen_features(t, 1, 7, s))
    assert len(seen) == 7 and all(5 <= n <= 30 for n in seen.values())


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, x double, y int")
    fitted = trees.fit_boosted(df, ["x"], "y", F.lit(1.0), 2, trees.Settings(2, penalty=1.0))
    assert fitted.nodes == []


def test_newton_boosting_learns(spark):
    rnd = random.Random(5)
    columns = ", ".join(f"{c} double" for c in model.FEATURES)
    data = []
    for k in range(2000):
        x = [rnd.random() for _ in model.FEATURES]
        data.append((k, int(rnd.random() < 0.1 + 0.8 * (x[6] > 0.5)), *x))
    df = spark.createDataFrame(data, f"appointment_id long, no_show int, {columns}").cache()
    train, test = model.split(df)
    for fitted in (model.newton_boosted(train, rounds=5, depth=2, rate=0.3, bins=16), model.bagged_forest(train, count=8, depth=4, bins=16)):
        row = model.evaluate(model.scored(fitted, test), "x").first()
        assert row.roc_auc > 0.8
        assert trees.importances(fitted, spark).first().feature == "prior_no_show_rate"


def test_scores_come_from_all_rounds_in_full_depth(spark, clinic, monkeypatch):
    """The query that scores grows the 200 trees of the job, not a few small ones."""
    asked = []

    def fit(df, features, label, weight, count, settings, bins):
        asked.append((count, settings.depth, settings.rate, bins))
        return trees.Ensemble(features, settings.depth, count, mean=False)

    monkeypatch.setattr(trees, "fit_boosted", fit)
    catalog.BUILDERS["ml_boosted_scores"](clinic)
    assert asked == [(200, 6, 0.05, 64)]


def test_blocks_and_checkpoints_leave_the_trees_alone(spark, monkeypatch):
    rnd = random.Random(13)
    data = [(k, rnd.random(), None if k % 7 == 0 else float(rnd.randrange(9)), float("nan") if k % 11 == 0 else rnd.random()) for k in range(3000)]
    data = [(*r, int(rnd.random() < 0.1 + 0.5 * r[1] + 0.3 * ((r[2] or 0) > 5))) for r in data]
    df = spark.createDataFrame(data, "id long, a double, b double, c double, y int")
    s = trees.Settings(3, penalty=1.0, least_weight=1.0, rate=0.3)
    weight = F.when(F.col("y") == 1, 2.5).otherwise(1.0)
    whole = trees.fit_boosted(df, ["a", "b", "c"], "y", weight, 6, s, 16)
    assert {n[0] for n in whole.nodes} == set(range(6))
    monkeypatch.setattr(packed, "ROWS_OF_A_BLOCK", 100)
    monkeypatch.setattr(packed, "MOST_PARTS", 1)
    monkeypatch.setattr(packed, "TREES_BETWEEN_CHECKPOINTS", 2)
    parts = []
    monkeypatch.setattr(packed, "_added", lambda rdd, add=packed._added: parts.append(rdd.getNumPartitions()) or add(rdd))
    assert trees.fit_boosted(df.repartition(8), ["a", "b", "c"], "y", weight, 6, s, 16).nodes == whole.nodes
    assert set(parts) == {spark.sparkContext.defaultParallelism}
    by_row = df.select("id", trees.probability(whole).alias("p"))
    both = trees.with_probability(whole, df, ["id"]).join(by_row, "id").collect()
    assert len(both) == 3000 and all(r.score == pytest.approx(r.p, abs=1e-14) for r in both)


# Exact stratified samples

@pytest.mark.parametrize("share", [(4, 5), (1, 3), (0, 1), (1, 1)])
def test_every_class_gives_its_exact_share(spark, share):
    data = [(k, "big") for k in range(3000)] + [(k, "small") for k in range(5000, 5007)] + [(9000, None), (9001, "one")]
    df = spark.createDataFrame(data, "id long, c string").repartition(5)
    digest = stratified.ordering("id", 42)
    found = df.where(stratified.chosen("c", digest, stratified.cuts(df, "c", digest, share)))
    a, b = share
    want = set()
    for c in {c for _, c in data}:
        ids = sorted((i for i, x in data if x == c), key=lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest())
        want |= set(ids[: (2 * a * len(ids) + b) // (2 * b)])
    assert {r["id"] for r in found.collect()} == want


def test_equal_ids_stay_together(spark):
    df = spark.createDataFrame([(1, "x")] * 10 + [(2, "x")], "id long, c string")
    digest = stratified.ordering("id", 42)
    kept = df.where(stratified.chosen("c", digest, stratified.cuts(df, "c", digest, (1, 2))))
    assert {r["id"] for r in kept.collect()} <= {1, 2} and kept.where("id = 1").count() in (0, 10)


def test_empty_table_has_no_sample(spark):
    df = spark.createDataFrame([], "id long, c string")
    digest = stratified.ordering("id", 42)
    assert stratified.cuts(df, "c", digest, (4, 5)) == {}
    assert df.where(stratified.chosen("c", digest, {})).count() == 0
