"""Second-order boosting, node tables and their attribution, against brute force."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinsignal.operators import attribution
from clinsignal.operators.ensemble import Node, TreeEnsemble, from_spark_gbt
from clinsignal.operators.ledger import load_model, load_serving, record_run
from clinsignal.operators.newton import Settings, bin_floors, train_newton
from clinsignal.operators.scoring import gbt_pipeline, log_odds, score, train_gbt
from clinsignal.session import scratch_path

COLS = ["a", "b", "c"]


def made_rows(n=400, seed=1, missing=0.1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = rng.randrange(12), rng.choice([0.5, 1.5, 2.5]), rng.randrange(5)
        y = int(rng.random() < 1 / (1 + math.exp(-(0.4 * a - 2 + (b > 1) - 0.5 * c))))
        rows.append([None if rng.random() < missing else float(v) for v in (a, b, c)] + [y])
    return rows


def brute_newton(rows, s):
    """Literal boosting: every node, feature, threshold and side for missing values."""
    x = [r[:-1] for r in rows]
    y = [r[-1] for r in rows]
    margin = [s.base] * len(rows)
    trees = []
    for _ in range(s.rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g, h = [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p]
        nodes = {}

        def grow(node, at, depth):
            ga, ha = sum(g[i] for i in at), sum(h[i] for i in at)
            best = None
            if depth < s.max_depth:
                for f in range(len(x[0])):
                    values = sorted({x[i][f] for i in at if x[i][f] is not None})
                    for low in values[1:]:
                        for left_missing in (True, False):
                            left = [i for i in at if (x[i][f] is None and left_missing) or (x[i][f] is not None and x[i][f] < low)]
                            gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                            if hl < s.min_child_weight or ha - hl < s.min_child_weight:
                                continue
                            gain = (gl**2 / (hl + s.l2) + (ga - gl) ** 2 / (ha - hl + s.l2) - ga**2 / (ha + s.l2)) / 2 - s.gamma
                            key = (round(gain, 9), -f, -low, left_missing)
                            if gain > 1e-6 and (best is None or key > best[0]):
                                best = (key, f, low, left_missing, left)
            if best is None:
                nodes[node] = (None, -s.rate * ga / (ha + s.l2))
                for i in at:
                    margin[i] += nodes[node][1]
                return
            _, f, low, left_missing, left = best
            nodes[node] = (f, low, left_missing)
            grow(2 * node, left, depth + 1)
            grow(2 * node + 1, sorted(set(at) - set(left)), depth + 1)

        grow(1, list(range(len(rows))), 0)
        trees.append(nodes)
    return trees, margin


@pytest.mark.parametrize("settings", [Settings(3, 0.3, 3), Settings(2, 0.1, 12, l2=0.5, gamma=0.2, min_child_weight=4.0, base=-0.3)], ids=str)
def test_newton_trees_match_brute_force(spark, settings):
    rows = made_rows()
    df = spark.createDataFrame(rows, "a double, b double, c double, label int").repartition(5)
    model = train_newton(df, COLS, settings=settings)
    trees, margin = brute_newton(rows, settings)
    for t, want in enumerate(trees):
        got = {n.node: n for n in model.nodes if n.tree == t}
        assert set(got) == set(want)
        for k, n in got.items():
            if want[k][0] is None:
                assert n.feature is None and n.value == pytest.approx(want[k][1], abs=1e-9)
            else:
                # a cut between the same rows: bins are of the whole table, the brute force's of the node
                assert n.feature == want[k][0] and n.threshold <= want[k][1] and n.missing_left == want[k][2]
    x = np.array([[np.nan if v is None else v for v in r[:-1]] for r in rows])
    assert np.allclose(model.margins(x), margin, atol=1e-9)


def test_newton_on_edge_tables(spark):
    schema = "a double, b double, c double, label int"
    empty = train_newton(spark.createDataFrame([], schema), COLS, settings=Settings(2, rounds=2))
    assert empty.margins(np.zeros((3, 3))).tolist() == [0, 0, 0]
    same = [(1.0, None, float("nan"), 1)] * 30 + [(1.0, None, float("nan"), None)]
    one = train_newton(spark.createDataFrame(same, schema), COLS, settings=Settings(2, rounds=1))
    # nothing to split: one leaf, -rate * G / (H + l2) with G = -15, H = 7.5
    assert [n.value for n in one.nodes] == [pytest.approx(0.1 * 15 / 8.5)]


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("a"))
    floors = bin_floors(df, "a", 16)
    assert len(floors) == 16 and max(b - a for a, b in zip(floors, floors[1:])) < 5000 / 16 * 1.2
    rows = df.withColumn("label", (F.col("a") > 2500).cast("int"))
    model = train_newton(rows, ["a"], settings=Settings(3, 0.5, 4, max_bins=64))
    hits = model.transform(rows).where(F.col("prediction") == F.col("label")).count()
    assert hits > 4900


def test_registered_trees_score_as_trained(spark):
    df = spark.createDataFrame(made_rows(), "a double, b double, c double, label int")
    model = train_newton(df, COLS, settings=Settings(3, 0.3, 2))
    root = scratch_path(spark, "registry-trees")
    record_run(spark, root, "n", {"depth": 3}, {"auc": 0.5}, model=model)
    loaded = load_model(spark, root, "n", 1)
    assert loaded.nodes == model.nodes and loaded.features == COLS
    assert load_serving(spark, root, "n")[0].base == model.base
    a, b = (sorted(r[0] for r in score(df, m).select("risk_probability").collect()) for m in (model, loaded))
    assert a == b
    assert log_odds(df, model).where("margin is null").count() == 0


def test_spark_trees_keep_their_margins_as_node_table(spark):
    df = spark.createDataFrame(made_rows(missing=0), "a double, b double, c double, label int")
    gbt = train_gbt(df, COLS, max_depth=3, max_iter=5)
    trees = from_spark_gbt(spark, gbt, COLS)
    rows = log_odds(df, gbt).select(*COLS, "margin").collect()
    assert np.allclose(trees.margins(np.array([r[:3] for r in rows])), [r["margin"] for r in rows], atol=1e-9)


def test_equal_rows_train_as_one_weighted_row(spark):
    """Boosting passes over value combinations, not over rows, and finds the same trees."""
    df = spark.createDataFrame(made_rows(missing=0), "a double, b double, c double, label int")
    many = df.crossJoin(spark.range(5)).drop("id")
    found = train_gbt(many, COLS, max_depth=3, max_iter=4)
    root = scratch_path(spark, "gbt-equal")
    found.stages[-1].write().save(root)
    passed = spark.read.parquet(f"{root}/data").agg(F.max("nodeData.rawCount")).first()[0]
    assert passed == df.distinct().count() < many.count() / 5
    roots = [n.cover for n in from_spark_gbt(spark, found, COLS).nodes if n.node == 0]
    assert roots == [many.count()] * 4
    plain = gbt_pipeline(COLS, max_depth=3, max_iter=4).fit(many.withColumn("label", F.col("label").cast("double")))
    a, b = (np.array([r[0] for r in log_odds(df.orderBy("a", "b", "c"), m).select("margin").collect()]) for m in (found, plain))
    assert np.allclose(a, b, atol=1e-9)


# ------------------------------------------------------------------- attribution
def expectation(tree, at, x, known):
    """Path-dependent expectation by recursion over one tree."""
    f = tree.feature[at]
    if f < 0:
        return tree.value[at]
    left, right = tree.left[at], tree.right[at]
    if f in known:
        go_left = tree.missing_left[at] if math.isnan(x[f]) else x[f] < tree.threshold[at]
        return expectation(tree, left if go_left else right, x, known)
    share = tree.cover[left] / (tree.cover[left] + tree.cover[right])
    return share * expectation(tree, left, x, known) + (1 - share) * expectation(tree, right, x, known)


def brute_shapley(model, x):
    m = len(x)

    def v(known):
        return model.base + sum(expectation(t, t.root, x, known) for t in model.trees)

    phi = []
    for i in range(m):
        others, total = [j for j in range(m) if j != i], 0.0
        for k in range(m):
            weight = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
            for group in itertools.combinations(others, k):
                total += weight * (v({*group, i}) - v(set(group)))
        phi.append(total)
    return phi, v(set())


def random_ensemble(rng, m, depth, trees):
    nodes = []

    def grow(tree, node, level):
        if level == depth or (level and rng.random() < 0.2):
            nodes.append(Node(tree, node, value=rng.uniform(-1, 1), cover=rng.uniform(1, 9)))
            return
        nodes.append(
            Node(tree, node, rng.randrange(m), rng.uniform(0, 1), 2 * node, 2 * node + 1, 0.0, rng.uniform(1, 9), rng.random() < 0.5)
        )
        grow(tree, 2 * node, level + 1)
        grow(tree, 2 * node + 1, level + 1)

    for t in range(trees):
        grow(t, 1, 0)
    return TreeEnsemble(nodes, [f"f{i}" for i in range(m)], base=rng.uniform(-1, 1))


@pytest.mark.parametrize("seed", range(4))
def test_shapley_values_match_all_coalitions(seed):
    rng = random.Random(seed)
    model = random_ensemble(rng, 5, 6, 3)
    x = np.array([[rng.choice([rng.random(), math.nan]) if rng.random() < 0.3 else rng.random() for _ in range(5)] for _ in range(6)])
    out = attribution.shapley_of_leaves(x, attribution.path_leaves(model))
    for row, got in zip(x, out):
        phi, base = brute_shapley(model, row)
        assert np.allclose(got[:-1], phi, atol=1e-10)
        assert got[-1] + model.base == pytest.approx(base, abs=1e-10)


def test_thirty_features_in_blocks_of_leaves(spark, monkeypatch):
    rng = random.Random(9)
    model = random_ensemble(rng, 30, 7, 12)
    rows = [[rng.random() for _ in range(30)] for _ in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in model.features))
    whole = attribution.tree_attribution(df, model, model.features).collect()
    monkeypatch.setattr(attribution, "LEAF_BLOCK", 100)
    parts = attribution.tree_attribution(df, model, model.features).collect()
    margins = model.margins(np.array([r[:30] for r in whole]))
    for a, b, m in zip(whole, parts, margins):
        assert a["margin"] == pytest.approx(m, abs=1e-9)
        assert np.allclose(a[30:], b[30:], atol=1e-9)


def test_nodes_without_cover_are_refused():
    nodes = [Node(0, 1, 0, 0.5, 2, 3), Node(0, 2, cover=0.0), Node(0, 3)]
    with pytest.raises(ValueError):
        attribution.path_leaves(TreeEnsemble(nodes, ["a"]))
