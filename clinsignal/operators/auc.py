"""Exact ROC-AUC (Mann-Whitney with half credit for ties), distributed.

1. Aggregate to one row per distinct score with positive / negative counts
   (partial aggregation map-side; a hot score is one row after it), checkpointed
   to the shared folder.
2. Range-partition and sort these rows by score.  Partitions grow in number with
   the data (shuffle partitions, merged by size), none holds all scores.
3. One streaming pass per partition sums positives, negatives and the credit of
   its positives over its own negatives: one row per partition.
4. Prefix sums of the partitions' negatives give each what lies below it.

AUC = sum over scores of pos * (negatives strictly below + neg / 2) / (P * N).
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinsignal.session import work_dir


SUMS = pa.schema([("part", pa.int32()), ("pos", pa.int64()), ("neg", pa.int64()), ("credit", pa.float64())])


def score_counts(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    label = F.col(label_col).cast("bigint")
    return df.groupBy(F.col(score_col).alias("score")).agg(
        F.sum(label).alias("pos"), F.sum(F.lit(1) - label).alias("neg")
    )


def partition_sums(batches):
    """mapInArrow kernel over (part, pos, neg) in score order -> one row."""
    part, below, pos_all, credit = None, 0, 0, 0.0
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(0)[0].as_py()
        pos, neg = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        before = below + np.cumsum(neg) - neg
        credit += float((pos * (before + neg / 2.0)).sum())
        below, pos_all = below + int(neg.sum()), pos_all + int(pos.sum())
    if part is not None:
        yield pa.RecordBatch.from_pylist([{"part": part, "pos": pos_all, "neg": below, "credit": credit}], schema=SUMS)


def roc_auc(df: DataFrame, score_col: str, label_col: str = "label", n_ranges: int | None = None) -> DataFrame:
    """One row: roc_auc (double, null when a class is absent), n_pos, n_neg (bigint).

    ``n_ranges`` fixes the number of score ranges (default: the shuffle partitions).
    """
    work_dir(df.sparkSession)  # make sure a reliable checkpoint folder is set
    counts = score_counts(df.where(F.col(score_col).isNotNull()), score_col, label_col).checkpoint(eager=True)
    ranged = counts.repartitionByRange(n_ranges, "score") if n_ranges else counts.repartitionByRange("score")
    sums = (
        ranged.sortWithinPartitions("score")
        .select(F.spark_partition_id().alias("part"), "pos", "neg")
        .mapInArrow(partition_sums, "part int, pos bigint, neg bigint, credit double")
    )
    # one row per partition
    below = F.coalesce(F.sum("neg").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    credit = F.col("credit") + F.col("pos").cast("double") * F.col("below")
    totals = sums.withColumn("below", below).agg(
        F.sum(credit).alias("credit"),
        F.coalesce(F.sum("pos"), F.lit(0)).cast("bigint").alias("n_pos"),
        F.coalesce(F.sum("neg"), F.lit(0)).cast("bigint").alias("n_neg"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return totals.select(F.when(pairs > 0, F.col("credit") / pairs).alias("roc_auc"), "n_pos", "n_neg")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
