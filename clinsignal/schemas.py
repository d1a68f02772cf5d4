"""Declared schemas and data contracts."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw clinical event on the topic: 9 flat nullable fields.
CLINICAL_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("provider_id", T.StringType(), True),
        T.StructField("patient_name", T.StringType(), True),
        T.StructField("patient_ssn", T.StringType(), True),
        T.StructField("medication_prescribed", T.StringType(), True),
        T.StructField("clinical_notes", T.StringType(), True),
        T.StructField("systolic_bp", T.IntegerType(), True),
        T.StructField("diastolic_bp", T.IntegerType(), True),
    ]
)

# Payload read by the scoring stream (BPs double, codes int32).
INFERENCE_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), True),
        T.StructField("systolic_bp", T.DoubleType(), True),
        T.StructField("diastolic_bp", T.DoubleType(), True),
        T.StructField("rxnorm_id", T.IntegerType(), True),
        T.StructField("snomed_code", T.IntegerType(), True),
    ]
)

# Same payload plus the free-text fields, so codes can be derived inline
# when the producer does not send them.
SCORING_PAYLOAD_SCHEMA = T.StructType(
    INFERENCE_PAYLOAD_SCHEMA.fields
    + [
        T.StructField("medication_prescribed", T.StringType(), True),
        T.StructField("clinical_notes", T.StringType(), True),
    ]
)

# Row shape of the Kafka source.
KAFKA_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)

FEATURES = ["rxnorm_id", "snomed_code", "systolic_bp", "diastolic_bp"]
CODE_FEATURES = ["rxnorm_id", "snomed_code"]
TARGET = "adverse_event_signal"

# Serving contract (v4): four int64 features in this order.
FEATURE_CONTRACT_V4 = T.StructType([T.StructField(c, T.LongType(), True) for c in FEATURES])

# Triage contract (v1): BPs double + two one-hot indicators.
FEATURE_CONTRACT_V1 = T.StructType(
    [
        T.StructField("systolic_bp", T.DoubleType(), True),
        T.StructField("diastolic_bp", T.DoubleType(), True),
        T.StructField("rxnorm_17767_amlodipine", T.IntegerType(), True),
        T.StructField("snomed_709044004_kidney_injury", T.IntegerType(), True),
    ]
)

ALERTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), True),
        T.StructField("systolic_bp", T.LongType(), True),
        T.StructField("diastolic_bp", T.LongType(), True),
        T.StructField("rxnorm_id", T.LongType(), True),
        T.StructField("snomed_code", T.LongType(), True),
        T.StructField("adverse_event_risk_score", T.DoubleType(), True),
        T.StructField("risk_probability", T.DoubleType(), True),
        T.StructField("evaluated_at", T.TimestampType(), True),
    ]
)

RUN_LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.IntegerType(), False),
        T.StructField("started_at", T.TimestampType(), True),
        T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
        T.StructField("contract", T.StringType(), True),
        T.StructField("path", T.StringType(), True),
    ]
)
