"""Raw topic rows -> typed, sanitized events (and the reverse encoding)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinsignal.functions.text import mask_ssn
from clinsignal.schemas import CLINICAL_EVENT_SCHEMA, INFERENCE_PAYLOAD_SCHEMA

# Keeps null fields as JSON nulls (like a plain dict encoder), not dropped.
JSON_WRITE_OPTIONS = {"ignoreNullFields": "false"}


def encode_payload(df: DataFrame, columns: Sequence[str], out_col: str = "value") -> Column:
    """Record -> UTF-8 JSON bytes, the topic's value encoding."""
    return F.to_json(F.struct(*[df[c] for c in columns]), JSON_WRITE_OPTIONS).cast("binary").alias(out_col)


def parse_json(
    raw: DataFrame,
    schema: T.StructType,
    value_col: str = "value",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Bytes -> text -> struct by a fixed schema (permissive) -> flat columns.

    Malformed, null or empty payloads are not dropped: they become all-null
    rows.  ``carry`` keeps extra source columns (e.g. the record time).
    """
    parsed = raw.select(
        F.from_json(F.col(value_col).cast("string"), schema).alias("data"),
        *[F.col(c) for c in carry],
    )
    return parsed.select("data.*", *carry)


def parse_events(raw: DataFrame, value_col: str = "value", carry: Sequence[str] = ()) -> DataFrame:
    return parse_json(raw, CLINICAL_EVENT_SCHEMA, value_col, carry)


def parse_payload(raw: DataFrame, value_col: str = "value", carry: Sequence[str] = (), schema: T.StructType = INFERENCE_PAYLOAD_SCHEMA) -> DataFrame:
    return parse_json(raw, schema, value_col, carry)


def sanitize(events: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Drop the direct identifier, mask SSNs, stamp the ingestion time.

    ``ingested_at`` defaults to ``current_timestamp()`` (one value per
    micro-batch); batch jobs may pass the record time instead.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return (
        events.drop("patient_name")
        .withColumn("patient_ssn", mask_ssn("patient_ssn"))
        .withColumn("ingested_at", stamp.cast("timestamp"))
    )
