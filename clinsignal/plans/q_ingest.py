"""Queries over the ingest, silver and gold layers."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clinsignal.functions.text import SSN_MASK, SSN_PATTERN, mask_ssn, normalize_text, ts_text
from clinsignal.functions.vocab import RXNORM_DEFAULT, RXNORM_RULES, SNOMED_DEFAULT, SNOMED_RULES, rxnorm_code, snomed_code
from clinsignal.operators.enrich import standardize_by_table
from clinsignal.operators.ingest import parse_payload
from clinsignal.plans import layers as P
from clinsignal.plans.registry import query
from clinsignal.plans.sql_base import code_sql, lit, ts_text_sql, with_base, strip_sql
from clinsignal.session import scratch_path
from clinsignal.sources.sinks import read_snapshot, write_snapshot
from clinsignal.sources.tables import given_table, newest_partitions

SILVER_COLS = [
    "event_id",
    "timestamp",
    "provider_id",
    "patient_ssn",
    "medication_prescribed",
    "clinical_notes",
    "systolic_bp",
    "diastolic_bp",
]
SILVER_COLS_SQL = ", ".join(f'"{c}"' if c == "timestamp" else c for c in SILVER_COLS)


def _silver_out(df):
    return df.select(*SILVER_COLS, ts_text("ingested_at").alias("ingested_at"))


SILVER_OUT_SQL = f"SELECT {SILVER_COLS_SQL}, {ts_text_sql('ingested_at')} AS ingested_at FROM silver"


@query(
    "signal_matrix",
    with_base(
        """
SELECT rxnorm_id, snomed_code, CAST(count(*) AS BIGINT) AS n_events,
  CAST(sum(CASE WHEN systolic_bp > 140 THEN 1 ELSE 0 END) AS BIGINT) AS n_high_bp,
  CAST(sum(CASE WHEN contains(patient_ssn, 'XXX-XX-XXXX') THEN 1 ELSE 0 END) AS BIGINT) AS n_masked
FROM gold GROUP BY rxnorm_id, snomed_code"""
    ),
)
def signal_matrix(spark: SparkSession, sf_dir: str):
    """Flagship: topic bytes -> parse -> sanitize -> code -> count per code pair."""
    g = P.gold(spark, sf_dir)
    return g.groupBy("rxnorm_id", "snomed_code").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.when(F.col("systolic_bp") > 140, 1).otherwise(0)).cast("bigint").alias("n_high_bp"),
        F.sum(F.when(F.col("patient_ssn").contains("XXX-XX-XXXX"), 1).otherwise(0)).cast("bigint").alias("n_masked"),
    )


@query(
    "parse_events",
    with_base(
        'SELECT event_id, "timestamp", provider_id, patient_name, patient_ssn, medication_prescribed, '
        "clinical_notes, systolic_bp, diastolic_bp FROM clinical_raw"
    ),
)
def parse_events_q(spark: SparkSession, sf_dir: str):
    return P.parsed_events(spark, sf_dir).drop(P.RECORD_TS)


@query(
    "parse_payload",
    with_base(
        "SELECT event_id, CAST(systolic_bp AS DOUBLE) AS systolic_bp, CAST(diastolic_bp AS DOUBLE) AS diastolic_bp, "
        "CAST(NULL AS INTEGER) AS rxnorm_id, CAST(NULL AS INTEGER) AS snomed_code FROM clinical_raw"
    ),
)
def parse_payload_q(spark: SparkSession, sf_dir: str):
    """Scoring-side parse of the raw topic: the producer sends no codes, so they are null."""
    return parse_payload(P.raw_topic(spark, sf_dir))


@query("sanitize", with_base(SILVER_OUT_SQL))
def sanitize_q(spark: SparkSession, sf_dir: str):
    return _silver_out(P.silver(spark, sf_dir))


@query(
    "normalize_text",
    with_base(
        f"SELECT event_id, {strip_sql('medication_prescribed')} AS medication_norm, "
        f"{strip_sql('clinical_notes')} AS notes_norm FROM silver"
    ),
)
def normalize_text_q(spark: SparkSession, sf_dir: str):
    return P.silver(spark, sf_dir).select(
        "event_id",
        normalize_text("medication_prescribed").alias("medication_norm"),
        normalize_text("clinical_notes").alias("notes_norm"),
    )


@query("code_medication", with_base("SELECT event_id, medication_prescribed, rxnorm_id FROM gold"))
def code_medication_q(spark: SparkSession, sf_dir: str):
    return P.gold(spark, sf_dir).select("event_id", "medication_prescribed", "rxnorm_id")


@query("code_notes", with_base("SELECT event_id, clinical_notes, snomed_code FROM gold"))
def code_notes_q(spark: SparkSession, sf_dir: str):
    return P.gold(spark, sf_dir).select("event_id", "clinical_notes", "snomed_code")


@query("code_by_rule_table", with_base("SELECT event_id, rxnorm_id, snomed_code FROM gold"))
def code_by_rule_table_q(spark: SparkSession, sf_dir: str):
    """Table-driven coder (broadcast rule table over distinct texts), same codes."""
    return standardize_by_table(P.silver_table(spark, sf_dir)).select("event_id", "rxnorm_id", "snomed_code")


@query(
    "encode_payload",
    with_base(
        "SELECT event_id, json_object('event_id', event_id, 'timestamp', \"timestamp\", 'provider_id', provider_id, "
        "'patient_name', patient_name, 'patient_ssn', patient_ssn, 'medication_prescribed', medication_prescribed, "
        "'clinical_notes', clinical_notes, 'systolic_bp', systolic_bp, 'diastolic_bp', diastolic_bp)::VARCHAR AS payload "
        "FROM clinical_raw"
    ),
)
def encode_payload_q(spark: SparkSession, sf_dir: str):
    topic = P.raw_topic(spark, sf_dir)
    return topic.select(F.col("key").cast("string").alias("event_id"), F.col("value").cast("string").alias("payload"))


@query("silver_scan", with_base(SILVER_OUT_SQL))
def silver_scan_q(spark: SparkSession, sf_dir: str):
    """Snapshot scan of the written silver table (the batch reader's view)."""
    return _silver_out(P.silver_table(spark, sf_dir))


@query("silver_count", with_base("SELECT CAST(count(*) AS BIGINT) AS n_records FROM silver"))
def silver_count_q(spark: SparkSession, sf_dir: str):
    return P.silver_table(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_records"))


@query(
    "silver_latest",
    with_base(
        f"SELECT {SILVER_COLS_SQL}, {ts_text_sql('ingested_at')} AS ingested_at FROM silver "
        "ORDER BY silver.ingested_at DESC NULLS LAST, event_id LIMIT 20"
    ),
)
def silver_latest_q(spark: SparkSession, sf_dir: str):
    """Newest 20 records: a top-k over only the newest date partitions that hold 20 rows."""
    s = newest_partitions(P.silver_table(spark, sf_dir, with_date=True), 20, P.SILVER_DATE)
    newest = s.orderBy(F.col("ingested_at").desc_nulls_last(), F.col("event_id")).limit(20)
    return _silver_out(newest)


GOLD_OUT_SQL = (
    f"SELECT {SILVER_COLS_SQL}, {ts_text_sql('ingested_at')} AS ingested_at, rxnorm_id, snomed_code, "
    f"{ts_text_sql('enriched_at')} AS enriched_at FROM gold"
)


@query("gold_snapshot", with_base(GOLD_OUT_SQL))
def gold_snapshot_q(spark: SparkSession, sf_dir: str):
    """Publish gold as a new snapshot version, then read the current version."""
    root = scratch_path(spark, "gold")
    write_snapshot(P.gold(spark, sf_dir), root)
    g = read_snapshot(spark, root)
    return g.select(
        *SILVER_COLS,
        ts_text("ingested_at").alias("ingested_at"),
        "rxnorm_id",
        "snomed_code",
        ts_text("enriched_at").alias("enriched_at"),
    )


@query(
    "gold_preview",
    with_base("SELECT event_id, medication_prescribed, rxnorm_id, snomed_code FROM gold ORDER BY event_id LIMIT 5"),
)
def gold_preview_q(spark: SparkSession, sf_dir: str):
    return (
        P.gold_table(spark, sf_dir)
        .select("event_id", "medication_prescribed", "rxnorm_id", "snomed_code")
        .orderBy("event_id")
        .limit(5)
    )


@query(
    "code_documents",
    f"""SELECT doc_id,
  {code_sql('text', RXNORM_RULES, RXNORM_DEFAULT)} AS rxnorm_id,
  {code_sql('text', SNOMED_RULES, SNOMED_DEFAULT)} AS snomed_code,
  CAST(length(text) AS BIGINT) AS n_chars,
  CAST(length(regexp_replace(text, {lit(SSN_PATTERN)}, {lit(SSN_MASK)}, 'g')) AS BIGINT) AS masked_chars
FROM documents""",
)
def code_documents_q(spark: SparkSession, sf_dir: str):
    """Coders and identifier mask over whole free-text documents (any length)."""
    docs = given_table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        rxnorm_code("text").alias("rxnorm_id"),
        snomed_code("text").alias("snomed_code"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.length(mask_ssn("text")).cast("bigint").alias("masked_chars"),
    )
