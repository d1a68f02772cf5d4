"""Risk models behind one ``score(df, model)`` interface.

* ``Scorecard``: fixed linear log-odds model (weights, reference points,
  intercept).  Pure column expressions, so its scores, attributions and
  metrics are SQL-checkable.
* ``TreeEnsemble``: second-order boosted trees or a literal node table.
* Spark ML ``PipelineModel`` (assembler + gradient-boosted trees): trained
  distributedly, applied with ``transform`` -- JVM only, batch or stream.

``score`` adds ``risk_probability`` (double) and ``adverse_event_risk_score``,
the 0/1 class decision as double.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsignal.functions.numeric import sigmoid
from clinsignal.operators.ensemble import TreeEnsemble
from clinsignal.schemas import FEATURES

ALERT_THRESHOLD = 0.5


@dataclass(frozen=True)
class Term:
    """One additive log-odds term: ``weight * (value - center)``.

    ``equals`` turns the feature into an indicator ``[feature == equals]``.
    """

    feature: str
    weight: float
    center: float = 0.0
    equals: int | None = None

    def value(self) -> Column:
        c = F.col(self.feature)
        if self.equals is not None:
            return (c.cast("bigint") == F.lit(self.equals)).cast("double")
        return c.cast("double")

    def contribution(self) -> Column:
        return F.lit(self.weight) * (self.value() - F.lit(self.center))


@dataclass(frozen=True)
class Scorecard:
    terms: tuple[Term, ...]
    intercept: float = 0.0
    name: str = "scorecard"
    features: tuple[str, ...] = field(default=tuple(FEATURES))

    def margin(self) -> Column:
        total = F.lit(self.intercept)
        for t in self.terms:
            total = total + t.contribution()
        return total


# Test scorecard used for SQL-checkable scoring (our own, not from the source
# pipeline): log-odds = 0.05*(sys-140) + 0.03*(dia-90) + 0.4*[rx=17767] + 0.8*[snomed=709044004].
DEFAULT_SCORECARD = Scorecard(
    terms=(
        Term("systolic_bp", 0.05, 140.0),
        Term("diastolic_bp", 0.03, 90.0),
        Term("rxnorm_id", 0.4, 0.0, equals=17767),
        Term("snomed_code", 0.8, 0.0, equals=709044004),
    )
)


def decision(prob: Column, threshold: float = ALERT_THRESHOLD) -> Column:
    """Strict ``>`` threshold; null probability -> 0."""
    return F.when(prob > threshold, F.lit(1.0)).otherwise(F.lit(0.0))


def score(df: DataFrame, model: Scorecard | TreeEnsemble | PipelineModel) -> DataFrame:
    """Add ``risk_probability`` and the 0/1 ``adverse_event_risk_score``."""
    if isinstance(model, Scorecard):
        prob = sigmoid(model.margin())
        return df.withColumn("risk_probability", prob).withColumn(
            "adverse_event_risk_score", decision(F.col("risk_probability"))
        )
    if isinstance(model, TreeEnsemble):
        prob = sigmoid(model.margin(df.sparkSession))
        return df.withColumn("risk_probability", prob).withColumn(
            "adverse_event_risk_score", decision(F.col("risk_probability"))
        )
    out = model.transform(df)
    prob = vector_to_array(F.col("probability"))[1]
    keep = [c for c in df.columns]
    return out.select(
        *keep,
        prob.alias("risk_probability"),
        F.col("prediction").cast("double").alias("adverse_event_risk_score"),
    )


def log_odds(df: DataFrame, model: Scorecard | TreeEnsemble | PipelineModel, out_col: str = "margin") -> DataFrame:
    """Model margin in log-odds.  For logistic GBT it is 2 x rawPrediction[1]."""
    if isinstance(model, Scorecard):
        return df.withColumn(out_col, model.margin())
    if isinstance(model, TreeEnsemble):
        return df.withColumn(out_col, model.margin(df.sparkSession))
    out = model.transform(df)
    return out.select(*df.columns, (F.lit(2.0) * vector_to_array(F.col("rawPrediction"))[1]).alias(out_col))


# Model size settings of the source training job (depth,
# learning rate, rounds, seed).
GBT_PARAMS = {"max_depth": 6, "step_size": 0.1, "max_iter": 100, "seed": 42}
# One bin per distinct value of the pressures (51): fewer would lose split points.
MAX_BINS = 256
ROW_WEIGHT = "equal_rows"
GROUPS_A_TASK = 10_000  # distinct training rows of a partition, at least


def gbt_pipeline(
    features: list[str] = FEATURES,
    label_col: str = "label",
    max_depth: int = GBT_PARAMS["max_depth"],
    step_size: float = GBT_PARAMS["step_size"],
    max_iter: int = GBT_PARAMS["max_iter"],
    seed: int = GBT_PARAMS["seed"],
    max_bins: int = MAX_BINS,
    weight_col: str | None = None,
) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features_vec", handleInvalid="keep")
    gbt = GBTClassifier(
        featuresCol="features_vec",
        labelCol=label_col,
        maxDepth=max_depth,
        stepSize=step_size,
        maxIter=max_iter,
        lossType="logistic",
        seed=seed,
        maxBins=max_bins,
        cacheNodeIds=True,
    )
    if weight_col is not None:
        gbt = gbt.setWeightCol(weight_col)
    return Pipeline(stages=[assembler, gbt])


def train_gbt(train: DataFrame, features: list[str] = FEATURES, label_col: str = "label", **params) -> PipelineModel:
    """Distributed fit on the distinct (features, label) rows, each weighted by its number.

    A round meets its rows only in weighted sums, and equal rows get equal scores,
    so one row of weight n stands for n equal ones: the same trees, while the many
    passes of boosting are over the value combinations that occur.  Rows that are
    all different are grouped in vain, by one more shuffle.  The groups are
    persisted (memory, spilling to disk), in no more partitions than they fill (the
    passes start several tasks a partition and round), and released after.
    """
    data = (
        train.groupBy(*features, F.col(label_col).cast("double").alias(label_col))
        .agg(F.count(F.lit(1)).cast("double").alias(ROW_WEIGHT))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        n_partitions = max(1, -(-data.count() // GROUPS_A_TASK))
        return gbt_pipeline(features, label_col, weight_col=ROW_WEIGHT, **params).fit(data.coalesce(n_partitions))
    finally:
        data.unpersist()


def triage(scored: DataFrame, prob_col: str = "risk_probability", alerts_only: bool = True) -> DataFrame:
    """ALERT when probability > 0.5 (null -> NORMAL); optionally only alerts.

    The filter is a plain predicate, so it reaches a parquet scan of a scored
    table as a pushed filter.
    """
    p = F.col(prob_col)
    out = scored.withColumn("status", F.when(p > ALERT_THRESHOLD, F.lit("ALERT")).otherwise(F.lit("NORMAL")))
    return out.where(p > ALERT_THRESHOLD) if alerts_only else out


def score_python_model(df: DataFrame, model, features: list[str] = FEATURES) -> DataFrame:
    """Score with a model that only exists in Python (e.g. a foreign booster).

    An Arrow-batched ``pandas_udf`` over the struct of feature columns.  The
    model travels once as cloudpickled bytes in a broadcast variable and is
    unpickled once per task.  ``model`` has ``predict_proba(X) -> (n, 2)`` or is
    a callable ``X -> P(positive)``, where ``X`` is a pandas frame with
    ``features`` as columns.  Spark ML models do not need this path (``score``
    runs them in the JVM).
    """
    payload = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    loaded: dict[str, object] = {}

    @F.pandas_udf("double")
    def predict(x: pd.DataFrame) -> pd.Series:
        if "model" not in loaded:
            loaded["model"] = cloudpickle.loads(payload.value)
        m = loaded["model"]
        out = m.predict_proba(x)[:, 1] if hasattr(m, "predict_proba") else m(x)
        return pd.Series(out, index=x.index, dtype="float64")

    return df.withColumn("risk_probability", predict(F.struct(*features))).withColumn(
        "adverse_event_risk_score", decision(F.col("risk_probability"))
    )


class NumpyScorecard:
    """A scorecard as a plain Python model object (for the Python-model path)."""

    def __init__(self, card: Scorecard):
        self.terms = [(t.feature, t.weight, t.center, t.equals) for t in card.terms]
        self.intercept = card.intercept

    def __call__(self, x):
        margin = np.full(len(x), self.intercept, dtype="float64")
        for feature, weight, center, equals in self.terms:
            v = x[feature].to_numpy(dtype="float64")
            if equals is not None:
                v = (v == equals).astype("float64")
            margin = margin + weight * (v - center)
        return 1.0 / (1.0 + np.exp(-margin))


# Helpers defined here (e.g. ``NumpyScorecard``) travel to executors by value,
# so workers need only numpy / pandas; installed foreign model classes still
# pickle by reference.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
