"""Per-feature attribution of a risk score and the audit delta-P.

Linear scorecard: exact Shapley values are ``weight * (x - center)`` -- plain
column expressions.

Tree ensembles (Spark GBT, second-order trees, literal node tables): exact
path-dependent Tree SHAP as a Spark job, in time leaves x depth^2 per vector.

* A leaf is a game of its own among the distinct features on its path.  Feature
  j contributes ``z_j`` (the cover shares of its splits, multiplied) while it is
  unknown and ``o_j`` (1 if the vector takes all of its splits, else 0) once it is
  known.  Extending a path by a feature multiplies the polynomial of coalition
  sizes by ``z_j + o_j t``; unwinding divides one feature out again, and the
  Shapley weights of the coefficients left give that feature's phi.
* Leaves are worked through in blocks of LEAF_BLOCK, each with its own broadcast
  of bounded size, whatever the number of trees; vectors in chunks of bounded memory.
* Work runs in place, one Arrow batch at a time; a feature vector that repeats
  within a batch is explained once.  Nothing is shuffled or joined back.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinsignal.functions.numeric import sigmoid
from clinsignal.operators import ensemble
from clinsignal.operators.ensemble import TreeEnsemble, feature_struct, from_spark_gbt
from clinsignal.operators.scoring import Scorecard

LEAF_BLOCK = 1 << 14  # leaves explained by one pass over a batch
CHUNK_BYTES = 64 * 1024 * 1024  # working memory of one chunk of vectors


# -- linear ------------------------------------------------------------------


def linear_attribution(df: DataFrame, model: Scorecard, prefix: str = "phi_") -> DataFrame:
    """phi per term, base value (intercept), margin, probability and delta-P."""
    phis = {f"{prefix}{t.feature}": t.contribution() for t in model.terms}
    out = df.withColumns(phis).withColumn("base_value", F.lit(float(model.intercept)))
    total = F.col("base_value")
    for name in phis:
        total = total + F.col(name)
    return out.withColumn("margin", total).withColumn("risk_probability", sigmoid("margin")).withColumn(
        "delta_p", sigmoid("margin") - sigmoid("base_value")
    )


def delta_p(margin_col: str = "margin", baseline: float = 0.0):
    """sigmoid(margin) - sigmoid(baseline); baseline is a log-odds intercept."""
    return sigmoid(margin_col) - sigmoid(F.lit(float(baseline)))


# -- trees ---------------------------------------------------------------------


@dataclass
class Leaves:
    """Leaves with the distinct features of their paths, padded to one length.

    A padded place has z = o = 1: a player who changes nothing, and so nobody's phi.
    """

    value: np.ndarray  # (leaves,)
    feature: np.ndarray  # (leaves, places), -1: padding
    low: np.ndarray  # low <= x < high on the path
    high: np.ndarray
    missing: np.ndarray  # a missing value takes this path
    share: np.ndarray  # z

    def block(self, start: int, stop: int) -> Leaves:
        return Leaves(*[a[start:stop] for a in vars(self).values()])


def path_leaves(model: TreeEnsemble) -> Leaves:
    """All leaves of the ensemble; covers must be positive."""
    paths: list[tuple[float, dict[int, list]]] = []
    for tree in model.trees:
        stack = [(tree.root, {})]
        while stack:
            at, path = stack.pop()
            f = int(tree.feature[at])
            if f < 0:
                paths.append((float(tree.value[at]), path))
                continue
            for child, goes_left in ((int(tree.left[at]), True), (int(tree.right[at]), False)):
                low, high, missing, share = path.get(f, (-np.inf, np.inf, True, 1.0))
                cover = tree.cover[tree.left[at]] + tree.cover[tree.right[at]]
                if not tree.cover[child] > 0:
                    raise ValueError("a node without cover has no expectation")
                taken = tree.missing_left[at] == goes_left
                bounds = (low, min(high, tree.threshold[at])) if goes_left else (max(low, tree.threshold[at]), high)
                stack.append((child, {**path, f: (*bounds, missing and taken, share * tree.cover[child] / cover)}))
    places = max([1, *[len(p) for _, p in paths]])
    n = len(paths)
    out = Leaves(
        np.array([v for v, _ in paths]), np.full((n, places), -1), np.full((n, places), -np.inf), np.full((n, places), np.inf),
        np.ones((n, places), bool), np.ones((n, places)),
    )
    for i, (_, path) in enumerate(paths):
        for k, (f, (low, high, missing, share)) in enumerate(path.items()):
            out.feature[i, k], out.low[i, k], out.high[i, k] = f, low, high
            out.missing[i, k], out.share[i, k] = missing, share
    return out


def shapley_of_leaves(x: np.ndarray, leaves: Leaves) -> np.ndarray:
    """(rows, features + 1): phi of every feature, then the expectation without any."""
    n, m = x.shape
    count, places = leaves.feature.shape
    out = np.zeros((n, m + 1))
    out[:, m] = (leaves.value * leaves.share.prod(axis=1)).sum()
    weights = [math.factorial(k) * math.factorial(places - k - 1) / math.factorial(places) for k in range(places)]
    column = [np.zeros((count, m)) for _ in range(places)]
    for k in range(places):
        used = np.flatnonzero(leaves.feature[:, k] >= 0)
        column[k][used, leaves.feature[used, k]] = 1.0
    step = max(1, int(CHUNK_BYTES // (8 * max(1, count) * (2 * places + 3))))
    for start in range(0, n, step):
        xb = x[start : start + step]
        ones, extended = [], [np.ones((len(xb), count))]
        for k in range(places):
            v = xb[:, np.maximum(leaves.feature[:, k], 0)]
            inside = (v >= leaves.low[:, k]) & (v < leaves.high[:, k]) | (np.isnan(v) & leaves.missing[:, k])
            ones.append((inside | (leaves.feature[:, k] < 0)).astype(np.float64))
            extended = extend(extended, leaves.share[:, k], ones[k])
        for k in range(places):
            z, o = leaves.share[:, k], ones[k]
            total = sum(w * c for w, c in zip(weights, unwind(extended, z, o)))
            out[start : start + step, :m] += ((o - z) * total * leaves.value) @ column[k]
    return out


def extend(path: list[np.ndarray], z: np.ndarray, o: np.ndarray) -> list[np.ndarray]:
    """Coefficients by coalition size after one more feature: times (z + o t)."""
    out = [z * c for c in path] + [o * path[-1]]
    for k in range(1, len(path)):
        out[k] += o * path[k - 1]
    return out


def unwind(path: list[np.ndarray], z: np.ndarray, o: np.ndarray) -> list[np.ndarray]:
    """Coefficients without one feature: divided by (z + o t), from the top where o is 1."""
    known, out = o > 0, [np.empty(0)] * (len(path) - 1)
    carried = path[-1]
    for k in reversed(range(len(path) - 1)):
        out[k] = np.where(known, carried, path[k] / z)
        carried = path[k] - z * out[k]
    return out


def tree_attribution(
    df: DataFrame,
    model: PipelineModel | GBTClassificationModel | TreeEnsemble,
    features: list[str],
    prefix: str = "phi_",
    baseline: float = 0.0,
) -> DataFrame:
    """Rows of ``df`` + phi per feature (log-odds), base_value, margin, risk_probability, delta_p.

    ``baseline`` is the log-odds the audit compares against (0 for models without
    an intercept).
    """
    spark = df.sparkSession
    trees = model if isinstance(model, TreeEnsemble) else from_spark_gbt(spark, model, features)
    leaves, m = path_leaves(trees), len(features)

    def explainer(shipped):
        def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for pdf in batches:
                # a vector that repeats within the batch is explained once
                distinct, which = np.unique(pdf.to_numpy(dtype=np.float64), axis=0, return_inverse=True)
                yield pd.Series(list(shapley_of_leaves(distinct, shipped.value)[which.ravel()]))

        return F.pandas_udf(explain, "array<double>")

    # in place: no join back, so null features (NaN to the model) keep their rows
    found = None
    for start in range(0, len(leaves.value), LEAF_BLOCK):
        part = explainer(spark.sparkContext.broadcast(leaves.block(start, start + LEAF_BLOCK)))(feature_struct(features))
        found = part if found is None else F.zip_with(found, part, lambda a, b: a + b)
    if found is None:
        found = F.array_repeat(F.lit(0.0), m + 1)
    rows = df.withColumn("__found", found)
    phis = {f"{prefix}{f}": F.col("__found")[i] for i, f in enumerate(features)}
    base = F.col("__found")[m] + F.lit(trees.base)
    rows = rows.withColumns({**phis, "base_value": base}).drop("__found")
    total = F.col("base_value")
    for name in phis:
        total = total + F.col(name)
    return rows.withColumn("margin", total).withColumn("risk_probability", sigmoid("margin")).withColumn(
        "delta_p", sigmoid("margin") - sigmoid(F.lit(float(baseline)))
    )


# The batch kernels above are shipped to executors by value, so workers need
# only numpy / pandas, not this package on their path.
for _module in (sys.modules[__name__], ensemble):
    cloudpickle.register_pickle_by_value(_module)
