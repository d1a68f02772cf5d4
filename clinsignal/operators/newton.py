"""Second-order gradient boosting: distributed gradient/hessian histograms.

Training rows become bins once: every feature is cut at its distinct values, or
at quantiles where it has more than ``max_bins`` of them, and rows of equal bins
and label are one weighted row (map-side combined), written to the shared folder.

A round grows one tree level by level.  Per level one aggregation gives, for each
open node, feature and bin, the sums of the gradients ``p - y`` and hessians
``p (1 - p)``; running sums over the bins of a (node, feature) give every split's

    gain = (GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)) / 2 - gamma

and the best split of each node comes back to the driver: at most 2^level rows.
A missing value goes to the side with the larger gain.  Leaf values are the
regularised Newton steps ``-rate * G / (H + l2)``; children's sums follow from the
split, so leaves need no pass of their own.  A row's node and margin are CASE
expressions over its bins; margins are written out every few rounds, which cuts
the lineage.

Equal gains (to 9 decimals) go to the first feature, then the lowest threshold.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinsignal.functions.numeric import sigmoid
from clinsignal.operators.ensemble import Node, TreeEnsemble
from clinsignal.session import drop_scratch, scratch_path

MIN_GAIN = 1e-6
ROUNDS_PER_TABLE = 8  # margins are written after so many rounds
MISSING = -1  # bin of missing values


@dataclass(frozen=True)
class Settings:
    """Depth, rate and rounds of the source training job; the
    regularisation is the usual default of second-order boosting."""

    max_depth: int = 6
    rate: float = 0.1
    rounds: int = 100
    l2: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    max_bins: int = 256
    base: float = 0.0


@dataclass
class Open:
    """A node while its tree grows; the sums are those of its rows."""

    node: int
    g: float = 0.0
    h: float = 0.0
    split: tuple | None = None  # (feature, bin, missing goes left)
    gain: float | None = None
    children: list[Open] = field(default_factory=list)


def bin_floors(df: DataFrame, feature: str, max_bins: int) -> list[float]:
    """Lowest value of every bin, ascending: distinct values, or quantiles of many."""
    present = df.select(F.col(feature).cast("double").alias("x")).where("x is not null and not isnan(x)")
    some = [r["x"] for r in present.distinct().limit(max_bins + 1).collect()]
    if len(some) <= max_bins:
        return sorted(some)
    shares = [i / max_bins for i in range(max_bins)]
    cuts = present.agg(F.percentile_approx("x", shares, 100 * max_bins).alias("q")).first()["q"]
    return sorted(set(cuts))


def binned(df: DataFrame, features: list[str], floors: list[list[float]], label: str) -> DataFrame:
    """Bin numbers ``b0, b1, ...``, label ``y`` and the weight ``n`` of equal rows."""
    cut = [i for i, f in enumerate(floors) if len(f) > 1]
    values = df.select(
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("y")
    )
    if cut:
        values = Bucketizer(
            splitsArray=[[float("-inf"), *floors[i][1:], float("inf")] for i in cut],
            inputCols=[f"x{i}" for i in cut],
            outputCols=[f"k{i}" for i in cut],
            handleInvalid="keep",
        ).transform(values)
    bins = []
    for i in range(len(features)):
        x = F.col(f"x{i}")
        number = F.col(f"k{i}").cast("int") if i in cut else F.lit(0)
        bins.append(F.when(x.isNull() | F.isnan(x), F.lit(MISSING)).otherwise(number).alias(f"b{i}"))
    names = [f"b{i}" for i in range(len(features))]
    return values.select(*bins, "y").where("y is not null").groupBy(*names, "y").agg(F.count(F.lit(1)).alias("n"))


def goes_left(split: tuple) -> Column:
    feature, last, missing_left = split
    b = F.col(f"b{feature}")
    return b <= last if missing_left else (b <= last) & (b != MISSING)


def leaf_case(top: Open, leaf) -> Column:
    """``leaf(node)`` of the node that a row's bins lead to."""
    if top.split is None:
        return leaf(top)
    left, right = top.children
    return F.when(goes_left(top.split), leaf_case(left, leaf)).otherwise(leaf_case(right, leaf))


def best_splits(rows: DataFrame, n_features: int, s: Settings) -> DataFrame:
    """Best split per ``node``: one row each, from the histograms of gradients and hessians."""
    bins = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"b{i}").alias("bin")) for i in range(n_features)])
    sums = [F.sum(F.col(c)).alias(c) for c in ("g", "h")]
    hist = rows.select("node", "g", "h", F.explode(bins).alias("x")).groupBy("node", "x.feature", "x.bin").agg(*sums)
    # running sums over the bins of a (node, feature); missing values come last
    per = W.partitionBy("node", "feature")
    upto = per.orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    known = F.col("bin") != MISSING
    totals = {}
    for c in ("g", "h"):
        totals[f"{c}_all"] = F.sum(c).over(per)
        totals[f"{c}_missing"] = F.coalesce(F.sum(F.when(~known, F.col(c))).over(per), F.lit(0.0))
        totals[f"{c}_left"] = F.coalesce(F.sum(F.when(known, F.col(c))).over(upto), F.lit(0.0))
    at = hist.withColumns(totals).withColumn("last", F.max("bin").over(per)).where(known & (F.col("bin") < F.col("last")))
    sides = F.array(*[F.struct(F.lit(m).alias("missing_left"), F.lit(float(m)).alias("share")) for m in (True, False)])
    both = at.select("*", F.explode(sides).alias("side"))
    gl = F.col("g_left") + F.col("side.share") * F.col("g_missing")
    hl = F.col("h_left") + F.col("side.share") * F.col("h_missing")
    g, h = F.col("g_all"), F.col("h_all")

    def score(a: Column, b: Column) -> Column:
        return a * a / (b + F.lit(s.l2))

    gain = (score(gl, hl) + score(g - gl, h - hl) - score(g, h)) / 2 - F.lit(s.gamma)
    found = both.select(
        "node", "feature", "bin", F.col("side.missing_left").alias("missing_left"), gl.alias("gl"), hl.alias("hl"),
        g.alias("g"), h.alias("h"), gain.alias("gain"),
    ).where(
        (F.col("hl") >= s.min_child_weight) & (F.col("h") - F.col("hl") >= s.min_child_weight) & (F.col("gain") > MIN_GAIN)
    )
    # ties: first feature, lowest bin, missing to the left
    rank = F.struct(F.round("gain", 9), -F.col("feature"), -F.col("bin"), F.col("missing_left").cast("int"))
    return found.groupBy("node").agg(F.max_by(F.struct(*found.columns[1:]), rank).alias("best")).select("node", "best.*")


def grow(state: DataFrame, n_features: int, s: Settings) -> Open:
    """One tree on rows (bins, y, n, margin)."""
    p = sigmoid("margin")
    rows = state.withColumns({"g": (p - F.col("y")) * F.col("n"), "h": p * (F.lit(1.0) - p) * F.col("n")})
    top = Open(1)
    level = [top]
    for _ in range(s.max_depth):
        nodes = {o.node: o for o in level}
        placed = rows.withColumn("node", leaf_case(top, lambda o: F.lit(o.node if o.node in nodes else None).cast("int")))
        found = best_splits(placed.where("node is not null"), n_features, s).collect()
        level = []
        for r in sorted(found, key=lambda r: r["node"]):
            o = nodes[r["node"]]
            o.g, o.h = r["g"], r["h"]
            o.split, o.gain = (r["feature"], r["bin"], r["missing_left"]), r["gain"]
            o.children = [Open(2 * o.node, r["gl"], r["hl"]), Open(2 * o.node + 1, r["g"] - r["gl"], r["h"] - r["hl"])]
            level += o.children
        if not level:
            break
    if top.split is None:
        sums = rows.agg(F.sum("g").alias("g"), F.sum("h").alias("h")).first()
        top.g, top.h = sums["g"] or 0.0, sums["h"] or 0.0
    return top


def leaf_value(o: Open, s: Settings) -> float:
    return -s.rate * o.g / (o.h + s.l2)


def node_rows(tree: int, top: Open, floors: list[list[float]], s: Settings) -> list[Node]:
    out, queue = [], [top]
    while queue:
        o = queue.pop()
        if o.split is None:
            out.append(Node(tree, o.node, value=leaf_value(o, s), cover=o.h))
            continue
        feature, last, missing_left = o.split
        out.append(Node(tree, o.node, feature, floors[feature][last + 1], 2 * o.node, 2 * o.node + 1, 0.0, o.h, missing_left, o.gain))
        queue += o.children
    return out


def train_newton(train: DataFrame, features: list[str], label: str = "label", settings: Settings = Settings()) -> TreeEnsemble:
    """Fit second-order boosted trees; cover is the hessian sum of a node."""
    spark, s = train.sparkSession, settings
    floors = [bin_floors(train, f, s.max_bins) for f in features]
    paths: list[str] = []

    def write(df: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "newton"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    start = binned(train, features, floors, label).withColumn("margin", F.lit(s.base))
    state = write(start)
    nodes: list[Node] = []
    for tree in range(s.rounds):
        top = grow(state, len(features), s)
        nodes += node_rows(tree, top, floors, s)
        state = state.withColumn("margin", F.col("margin") + leaf_case(top, lambda o: F.lit(leaf_value(o, s))))
        if (tree + 1) % ROUNDS_PER_TABLE == 0 and tree + 1 < s.rounds:
            state = write(state)
    drop_scratch(spark, *paths)
    return TreeEnsemble(nodes, features, s.base)
