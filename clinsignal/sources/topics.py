"""Event topics: Kafka in production, Kafka-shaped parquet files in tests.

Both give rows with a binary ``value`` (UTF-8 JSON) and a record
``timestamp``; everything downstream only reads those two columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinsignal.operators.ingest import encode_payload
from clinsignal.schemas import CLINICAL_EVENT_SCHEMA

# The file stand-in for a topic carries the Kafka columns the jobs use.
TOPIC_FILE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

RAW_TOPIC = "raw-clinical-events"


def topic_frame(clinical: DataFrame, topic: str = RAW_TOPIC, time_col: str = "ts") -> DataFrame:
    """Raw clinical records -> Kafka-shaped rows (key, value, topic, timestamp)."""
    fields = [f.name for f in CLINICAL_EVENT_SCHEMA.fields]
    return clinical.select(
        F.col("event_id").cast("binary").alias("key"),
        encode_payload(clinical, fields, "value"),
        F.lit(topic).alias("topic"),
        F.col(time_col).cast("timestamp").alias("timestamp"),
    )


def write_topic(rows: DataFrame, fmt: str = "kafka", options: dict[str, str] | None = None, path: str | None = None) -> None:
    """Append rows with key, value and topic to a topic: Kafka by its options
    (``kafka.bootstrap.servers``), or files under ``path``."""
    writer = rows.write.format(fmt).mode("append").options(**(options or {}))
    writer.save(path) if path else writer.save()


def read_events(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    stream: bool = True,
) -> DataFrame:
    """Subscribe to (or scan) an event topic.

    ``fmt="kafka"`` expects e.g. ``{"kafka.bootstrap.servers": ..., "subscribe": ...,
    "startingOffsets": "latest"}``.  Any file format reads Kafka-shaped files
    at ``path``; ``maxFilesPerTrigger`` may be passed in ``options``.
    """
    options = dict(options or {})
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        return reader.format("kafka").options(**options).load()
    reader = reader.format(fmt).schema(TOPIC_FILE_SCHEMA).options(**options)
    return reader.load(path)
