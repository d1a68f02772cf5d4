"""Split, labels, contracts, exact AUC, Tree SHAP and the run ledger."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinsignal.operators import attribution, contract
from clinsignal.operators.auc import roc_auc
from clinsignal.operators.features import add_label, split
from clinsignal.operators.ledger import ModelNotFound, load_model, record_run
from clinsignal.operators.scoring import DEFAULT_SCORECARD, log_odds, score, train_gbt
from clinsignal.plans import layers as P
from clinsignal.schemas import FEATURES
from clinsignal.session import scratch_path


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("n_ranges", [1, 3, 16])
def test_auc_matches_brute_force_with_ties(spark, n_ranges):
    rnd = random.Random(7)
    rows = [(float(rnd.randint(0, 20)), int(rnd.random() < 0.4)) for _ in range(600)]
    df = spark.createDataFrame(rows, "s double, y int")
    got = roc_auc(df, "s", "y", n_ranges).first()
    assert got["n_pos"] + got["n_neg"] == 600
    assert got["roc_auc"] == pytest.approx(brute_auc(*zip(*rows)), abs=1e-12)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert roc_auc(df, "s", "y").first()["roc_auc"] is None


def test_split_disjoint_covering_and_stable(spark, sf_small):
    f = P.features(spark, sf_small)
    train, test = split(f)
    ids_train = {r[0] for r in train.select("event_id").collect()}
    ids_test = {r[0] for r in test.select("event_id").collect()}
    assert not ids_train & ids_test
    assert len(ids_train) + len(ids_test) == f.count()
    assert len(ids_test) == math.ceil(0.2 * f.count())
    _, test2 = split(f.repartition(7))
    assert {r[0] for r in test2.select("event_id").collect()} == ids_test


def test_label_fallbacks(spark):
    df = spark.createDataFrame([("a", 150, 1), ("b", 120, None)], "event_id string, systolic_bp int, adverse_event_signal int")
    assert [r["label"] for r in add_label(df).orderBy("event_id").collect()] == [1, 0]
    df2 = df.drop("adverse_event_signal")
    assert [r["label"] for r in add_label(df2).orderBy("event_id").collect()] == [1, 0]
    coin = add_label(df2.drop("systolic_bp")).orderBy("event_id").collect()
    assert all(r["label"] in (0, 1) for r in coin)
    assert coin == add_label(df2.drop("systolic_bp")).orderBy("event_id").collect()


def test_contract_enforce(spark, sf_small):
    f = P.features(spark, sf_small)
    assert contract.enforce(f).columns == FEATURES
    bad = f.withColumn("systolic_bp", F.lit("x"))
    with pytest.raises(Exception):
        contract.enforce(bad).collect()


@pytest.fixture(scope="module")
def small_gbt(spark, sf_small):
    train, test = split(P.features(spark, sf_small))
    model = train_gbt(train, FEATURES, max_depth=3, max_iter=4)
    return model, test


def _java_tree_expectation(node, x, subset):
    """Path-dependent conditional expectation by recursion over the JVM tree."""
    if node.getClass().getSimpleName() == "LeafNode":
        return node.prediction()
    split_ = node.split()
    f, thr = split_.featureIndex(), split_.threshold()
    left, right = node.leftChild(), node.rightChild()
    if f in subset:
        return _java_tree_expectation(left if x[f] <= thr else right, x, subset)
    nl, nr = left.impurityStats().count(), right.impurityStats().count()
    el = _java_tree_expectation(left, x, subset)
    er = _java_tree_expectation(right, x, subset)
    return (nl * el + nr * er) / (nl + nr)


def _brute_shap(gbt, x):
    trees = gbt._java_obj.trees()
    weights = list(gbt.treeWeights)
    m = len(x)

    def v(subset):
        return 2.0 * sum(w * _java_tree_expectation(trees[i].rootNode(), x, subset) for i, w in enumerate(weights))

    phi = []
    for i in range(m):
        others = [j for j in range(m) if j != i]
        total = 0.0
        for k in range(m):
            for s in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                total += w * (v(set(s) | {i}) - v(set(s)))
        phi.append(total)
    return phi, v(set())


def test_tree_shap_matches_recursion_and_is_additive(spark, small_gbt):
    model, test = small_gbt
    gbt = model.stages[-1]
    explained = attribution.tree_attribution(test, model, FEATURES)
    margins = log_odds(test, model).select("event_id", F.col("margin").alias("model_margin"))
    rows = explained.join(margins, "event_id").orderBy("event_id").limit(12).collect()
    assert rows
    for r in rows:
        phi = [r[f"phi_{f}"] for f in FEATURES]
        assert r["base_value"] + sum(phi) == pytest.approx(r["margin"], abs=1e-9)
        assert r["margin"] == pytest.approx(r["model_margin"], abs=1e-9)
        want_phi, want_base = _brute_shap(gbt, [float(r[f]) for f in FEATURES])
        assert np.allclose(phi, want_phi, atol=1e-9)
        assert r["base_value"] == pytest.approx(want_base, abs=1e-9)
        assert -1.0 < r["delta_p"] < 1.0


def test_tree_attribution_covers_every_row(spark, small_gbt):
    model, test = small_gbt
    explained = attribution.tree_attribution(test, model, FEATURES)
    assert explained.count() == test.count()
    assert explained.where(F.col("margin").isNull()).count() == 0


def test_linear_attribution_additive(spark, sf_small):
    a = attribution.linear_attribution(P.features(spark, sf_small), DEFAULT_SCORECARD)
    phis = [f"phi_{t.feature}" for t in DEFAULT_SCORECARD.terms]
    gap = a.select(F.max(F.abs(F.col("base_value") + sum(F.col(c) for c in phis) - F.col("margin")))).first()[0]
    assert gap < 1e-12


def test_ledger_versions_and_load(spark, small_gbt):
    model, test = small_gbt
    root = scratch_path(spark, "registry-test")
    auc = roc_auc(score(test, model), "risk_probability", "label")
    r1 = record_run(spark, root, "m", {"depth": 3}, auc, model=model).first()
    r2 = record_run(spark, root, "m", {"depth": 3}, {"roc_auc": 0.5}, model=model).first()
    assert (r1["version"], r2["version"]) == (1, 2)
    assert r1["params"]["depth"] == "3"
    loaded = load_model(spark, root, "m")
    assert loaded.transform(test).count() == test.count()
    with pytest.raises(ModelNotFound):
        load_model(spark, root, "absent")


class _ProbaModel:
    """A foreign-style model object with predict_proba (as sklearn / boosters have)."""

    def predict_proba(self, x):
        p = (x["systolic_bp"].to_numpy() > 140).astype("float64") * 0.8 + 0.1
        return np.column_stack([1 - p, p])


def test_python_model_path_matches_native_scorecard(spark, sf_small):
    from clinsignal.operators.scoring import NumpyScorecard, score_python_model

    f = P.features(spark, sf_small)
    native = score(f, DEFAULT_SCORECARD).select("event_id", F.col("risk_probability").alias("a"))
    foreign = score_python_model(f, NumpyScorecard(DEFAULT_SCORECARD)).select("event_id", F.col("risk_probability").alias("b"))
    gap = native.join(foreign, "event_id").select(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]
    assert gap < 1e-12
    proba = score_python_model(f, _ProbaModel())
    assert proba.where((F.col("risk_probability") > 0.5) != (F.col("systolic_bp") > 140)).count() == 0
