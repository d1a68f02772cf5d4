"""Tree ensembles as node tables: one form for every trained or literal model.

A node table has a row per node.  An inner node sends a row left when the value
of its feature is below the threshold, right otherwise, and a missing value to
its ``missing_left`` side; a leaf carries a log-odds value (learning rate or tree
weight already folded in).  ``cover`` is the training weight that reached the
node.  The margin is ``base`` plus the values of the leaves a row ends in.

The table is as large as the model (rounds x 2^(depth + 1)), whatever the data.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinsignal.functions.numeric import sigmoid
from clinsignal.session import drop_scratch, scratch_path

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, missing_left boolean, left int, right int, value double, cover double, "
    "gain double"
)
# Log-odds of Spark's logistic GBT = 2 x the ensemble margin.
GBT_LOGIT_SCALE = 2.0


@dataclass(frozen=True)
class Node:
    """One row of a node table; ``feature`` is None for a leaf."""

    tree: int
    node: int
    feature: int | None = None
    threshold: float | None = None
    left: int | None = None
    right: int | None = None
    value: float = 0.0
    cover: float = 1.0
    missing_left: bool = False
    gain: float | None = None


class TreeEnsemble:
    """Node table plus the names of the features its numbers stand for."""

    def __init__(self, nodes: list[Node], features: list[str], base: float = 0.0):
        self.nodes = sorted(nodes, key=lambda n: (n.tree, n.node))
        self.features = list(features)
        self.base = float(base)
        by_tree: dict[int, list[Node]] = {}
        for n in self.nodes:
            by_tree.setdefault(n.tree, []).append(n)
        self.trees = [Tree(by_tree[t]) for t in sorted(by_tree)]

    # -- scoring ------------------------------------------------------------

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += tree.values(x)
        return total

    def margin(self, spark: SparkSession) -> Column:
        """Log-odds column over the feature columns (Arrow batches)."""
        shipped = spark.sparkContext.broadcast(self)

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            model = shipped.value
            for pdf in batches:
                yield pd.Series(model.margins(pdf.to_numpy(dtype=np.float64)))

        return F.pandas_udf(score, "double")(feature_struct(self.features))

    def transform(self, df: DataFrame) -> DataFrame:
        """Margin, probability and 0/1 prediction (missing features allowed)."""
        out = df.withColumn("margin", self.margin(df.sparkSession)).withColumn("probability", sigmoid("margin"))
        return out.withColumn("prediction", (F.col("probability") > 0.5).cast("double"))

    # -- storage ------------------------------------------------------------

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (n.tree, n.node, n.feature, n.threshold, n.missing_left, n.left, n.right, float(n.value), float(n.cover), n.gain)
            for n in self.nodes
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        spec = spark.createDataFrame([(self.features, self.base)], "features array<string>, base double")
        spec.coalesce(1).write.parquet(f"{path}/spec")
        self.frame(spark).coalesce(1).write.parquet(f"{path}/nodes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeEnsemble:
        spec = spark.read.parquet(f"{path}/spec").first()
        rows = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes").collect()
        return TreeEnsemble([Node(**r.asDict()) for r in rows], spec["features"], spec["base"])


class Tree:
    """One tree's nodes as arrays; children as positions in them."""

    def __init__(self, nodes: list[Node]):
        at = {n.node: i for i, n in enumerate(nodes)}
        inner = [n.feature is not None for n in nodes]
        self.feature = np.array([n.feature if k else -1 for n, k in zip(nodes, inner)], np.int64)
        self.threshold = np.array([n.threshold if k else np.inf for n, k in zip(nodes, inner)], np.float64)
        self.left = np.array([at[n.left] if k else -1 for n, k in zip(nodes, inner)], np.int64)
        self.right = np.array([at[n.right] if k else -1 for n, k in zip(nodes, inner)], np.int64)
        self.missing_left = np.array([bool(n.missing_left) for n in nodes])
        self.value = np.array([n.value for n in nodes], np.float64)
        self.cover = np.array([n.cover for n in nodes], np.float64)
        self.root = at[min(at)]

    def values(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.full(len(x), self.root), np.arange(len(x))
        while (inner := self.feature[at] >= 0).any():
            v = x[rows, self.feature[at]]
            go_left = np.where(np.isnan(v), self.missing_left[at], v < self.threshold[at])
            at = np.where(inner, np.where(go_left, self.left[at], self.right[at]), at)
        return self.value[at]


def feature_struct(features: list[str]) -> Column:
    return F.struct(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])


def from_spark_gbt(spark: SparkSession, model: PipelineModel | GBTClassificationModel, features: list[str]) -> TreeEnsemble:
    """The node table of a fitted Spark GBT, read from its saved form.

    Spark sends ``x <= threshold`` left and a missing value right.  Covers are sums
    of row weights: the first of a node's statistics.
    """
    stages = [model] if isinstance(model, GBTClassificationModel) else model.stages
    gbt = next((s for s in stages if isinstance(s, GBTClassificationModel)), None)
    if gbt is None:
        raise ValueError("model has no gradient-boosted tree stage")
    path = scratch_path(spark, "gbt-model")
    gbt.write().save(path)
    rows = (
        spark.read.parquet(f"{path}/data")
        .select(
            "treeID",
            "nodeData.id",
            "nodeData.prediction",
            F.col("nodeData.impurityStats")[0].alias("count"),
            "nodeData.leftChild",
            "nodeData.rightChild",
            "nodeData.split.featureIndex",
            F.try_element_at(F.col("nodeData.split.leftCategoriesOrThreshold"), F.lit(1)).alias("threshold"),
        )
        .collect()
    )
    drop_scratch(spark, path)
    weights = list(gbt.treeWeights)
    nodes = []
    for r in rows:
        if r["leftChild"] < 0:
            value = GBT_LOGIT_SCALE * weights[r["treeID"]] * r["prediction"]
            nodes.append(Node(r["treeID"], r["id"], value=value, cover=r["count"]))
        else:
            above = float(np.nextafter(r["threshold"], np.inf))
            nodes.append(Node(r["treeID"], r["id"], r["featureIndex"], above, r["leftChild"], r["rightChild"], 0.0, r["count"]))
    return TreeEnsemble(nodes, features)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
