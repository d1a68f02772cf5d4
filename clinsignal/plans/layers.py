"""Shared batch derivations of the medallion layers from the given tables.

raw topic rows -> silver -> gold -> training frame / alerts.  The derivations
are lazy DataFrames over the whole ``events`` table.  As in a production
medallion pipeline, each layer is also *materialized once* (per application
and input directory) in the shared work folder -- silver and alerts as
tables, gold as a published snapshot -- and downstream jobs scan those
tables: column pruning and filter push-down reach the parquet scan, and the
lineage of every downstream job starts at a written table.

In batch form the record time of the topic row stands in for the ingestion /
evaluation stamps, which keeps results repeatable; the streaming jobs use
``current_timestamp``.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinsignal.functions.numeric import coerce_bigint
from clinsignal.operators.enrich import standardize
from clinsignal.operators.features import add_label, indicator_features, training_frame
from clinsignal.operators.ingest import parse_events, sanitize
from clinsignal.operators.scoring import DEFAULT_SCORECARD, Scorecard, score
from clinsignal.plans.topic_files import FileTopic, write_time_ordered_files
from clinsignal.schemas import ALERTS_SCHEMA, CODE_FEATURES, FEATURES
from clinsignal.sources.fixtures import clinical_raw as derive_clinical_raw
from clinsignal.session import scratch_path
from clinsignal.sources import sinks
from clinsignal.sources.sinks import write_snapshot
from clinsignal.sources.tables import given_table, table_stamp
from clinsignal.sources.topics import topic_frame
from clinsignal.streaming import jobs

RECORD_TS = "record_ts"

# (application id, input dir, stamp of the input, layer) -> path of the materialized layer
_TABLES: dict[tuple, str] = {}
BUILD_LOCK = threading.RLock()  # concurrent queries build each layer once


def layer_key(spark: SparkSession, sf_dir: str, layer: str) -> tuple:
    """What a layer was made of: rows added to or replaced in the input make a new one."""
    return spark.sparkContext.applicationId, sf_dir.rstrip("/"), table_stamp(spark, sf_dir, "events"), layer


def reset_tables() -> None:
    """Forget materialized layers (the next access rebuilds them)."""
    _TABLES.clear()
    _TOPICS.clear()


def clinical_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_clinical_raw(given_table(spark, sf_dir, "events"))


def raw_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped rows (binary JSON value + record timestamp)."""
    return topic_frame(clinical_raw(spark, sf_dir))


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_topic(spark, sf_dir).withColumnRenamed("timestamp", RECORD_TS)
    return parse_events(raw, carry=[RECORD_TS])


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsed_events(spark, sf_dir)
    return sanitize(parsed, ingested_at=F.col(RECORD_TS)).drop(RECORD_TS)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize(silver(spark, sf_dir))


def labelled_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold with a confirmed-outcome column: kidney finding -> 1, no finding
    -> unknown (null), other findings -> 0.  Exercises the existing-label path."""
    g = gold_table(spark, sf_dir)
    return g.withColumn(
        "adverse_event_signal",
        F.when(F.col("snomed_code") == "709044004", F.lit(1))
        .when(F.col("snomed_code") == "000000000", F.lit(None).cast("int"))
        .otherwise(F.lit(0)),
    )


TOPIC_SLICES = 4  # micro-batches of a small topic
SLICE_BYTES = 64 << 20  # input bytes of one micro-batch of a larger one


def topic_slices(spark: SparkSession, sf_dir: str, least: int = TOPIC_SLICES) -> int:
    """Micro-batches of the topic: their number grows with the input, not their size."""
    return max(least, -(-table_stamp(spark, sf_dir, "events")[0] // SLICE_BYTES))


_TOPICS: dict[tuple, FileTopic] = {}


def topic_files(spark: SparkSession, sf_dir: str) -> FileTopic:
    """The raw topic as time-ordered Kafka-shaped files, written once; every
    streaming consumer subscribes to it with its own checkpoint."""
    key = layer_key(spark, sf_dir, "topic")
    with BUILD_LOCK:
        if key not in _TOPICS:
            _TOPICS[key] = write_time_ordered_files(
                raw_topic(spark, sf_dir), scratch_path(spark, "topic"), topic_slices(spark, sf_dir)
            )
    return _TOPICS[key]


def alerts_files(spark: SparkSession, sf_dir: str) -> FileTopic:
    """The alerts table replayed as time-ordered files (the scoring sink's
    shape), written once for the monitoring streams."""
    key = layer_key(spark, sf_dir, "alerts-files")
    with BUILD_LOCK:
        if key not in _TOPICS:
            _TOPICS[key] = write_time_ordered_files(
                alerts_table(spark, sf_dir), scratch_path(spark, "alerts-files"), topic_slices(spark, sf_dir), "evaluated_at"
            )
    return _TOPICS[key]


SILVER_DATE = jobs.SILVER_DATE


def silver_table(spark: SparkSession, sf_dir: str, with_date: bool = False) -> DataFrame:
    """The silver layer as a table (written once, then scanned), partitioned by
    ingestion date; the partition column is returned only when asked for."""
    key = layer_key(spark, sf_dir, "silver")
    with BUILD_LOCK:
        if key not in _TABLES:
            path = scratch_path(spark, "silver")
            dated = silver(spark, sf_dir).withColumn(SILVER_DATE, F.to_date("ingested_at"))
            sinks.write_by_date(dated, SILVER_DATE, path)
            _TABLES[key] = path
    table = spark.read.parquet(_TABLES[key])
    return table if with_date else table.drop(SILVER_DATE)


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold layer: published snapshot of ``standardize(silver table)``.

    The build publishes a versioned snapshot; its path is kept, so readers scan
    it directly without resolving the pointer table again.
    """
    key = layer_key(spark, sf_dir, "gold")
    with BUILD_LOCK:
        if key not in _TABLES:
            root = scratch_path(spark, "gold")
            _TABLES[key] = write_snapshot(standardize(silver_table(spark, sf_dir)), root)
    return spark.read.parquet(_TABLES[key])


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id + 4 int64 features + int label (threshold fallback), from the gold table."""
    frame, _ = training_frame(gold_table(spark, sf_dir))
    return frame


def v1_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gold_table(spark, sf_dir).select("event_id", *FEATURES)
    return add_label(indicator_features(g))


ALERTS_DATE = jobs.ALERTS_DATE
ALERTS_TABLE_SCHEMA = T.StructType(ALERTS_SCHEMA.fields + [T.StructField(ALERTS_DATE, T.DateType(), True)])


def alerts_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored alerts as a table (what the scoring job appends and reports read),
    partitioned by evaluation date so recent-window reports prune old partitions."""
    key = layer_key(spark, sf_dir, "alerts")
    with BUILD_LOCK:
        if key not in _TABLES:
            path = scratch_path(spark, "alerts")
            dated = alerts(spark, sf_dir).withColumn(ALERTS_DATE, F.to_date("evaluated_at"))
            sinks.write_by_date(dated, ALERTS_DATE, path)
            _TABLES[key] = path
    return spark.read.schema(ALERTS_TABLE_SCHEMA).parquet(_TABLES[key])


def alerts(spark: SparkSession, sf_dir: str, model: Scorecard = DEFAULT_SCORECARD) -> DataFrame:
    """Scored alerts: int64 contract features, score, decision, time (from the gold table)."""
    g = gold_table(spark, sf_dir)
    aligned = g.select(
        "event_id",
        F.coalesce(F.col("systolic_bp").cast("bigint"), F.lit(0).cast("bigint")).alias("systolic_bp"),
        F.coalesce(F.col("diastolic_bp").cast("bigint"), F.lit(0).cast("bigint")).alias("diastolic_bp"),
        *[coerce_bigint(c).alias(c) for c in CODE_FEATURES],
        F.col("ingested_at").alias("evaluated_at"),
    )
    return score(aligned, model).select(
        "event_id",
        "systolic_bp",
        "diastolic_bp",
        "rxnorm_id",
        "snomed_code",
        "adverse_event_risk_score",
        "risk_probability",
        "evaluated_at",
    )
