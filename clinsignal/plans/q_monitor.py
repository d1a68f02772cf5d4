"""Queries over the scored alerts table: scans, KPIs, throughput, ledgers, triage."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clinsignal.functions.numeric import percent_text
from clinsignal.functions.text import ts_text
from clinsignal.operators import monitor
from clinsignal.operators.scoring import triage
from clinsignal.plans import layers as P
from clinsignal.plans.registry import query
from clinsignal.plans.sql_base import ts_text_sql, with_base
from clinsignal.schemas import ALERTS_SCHEMA
from clinsignal.session import scratch_path
from clinsignal.sources.sinks import append
from clinsignal.sources.tables import read_table_or_empty, union_drifted

ROUND = 9
ALERT_KEYS = ["event_id", "systolic_bp", "diastolic_bp", "rxnorm_id", "snomed_code", "adverse_event_risk_score"]
ALERT_KEYS_SQL = ", ".join(ALERT_KEYS)


def alerts_out(df, with_time: bool = True):
    cols = [*ALERT_KEYS, F.round("risk_probability", ROUND).alias("risk_probability")]
    if with_time:
        cols.append(ts_text("evaluated_at").alias("evaluated_at"))
    return df.select(*cols)


def alerts_out_sql(source: str = "alerts", with_time: bool = True, tail: str = "") -> str:
    time = f", {ts_text_sql('evaluated_at')} AS evaluated_at" if with_time else ""
    return f"SELECT {ALERT_KEYS_SQL}, round(risk_probability, {ROUND}) AS risk_probability{time} FROM {source} {tail}"


@query("alerts_scan", with_base(alerts_out_sql()))
def alerts_scan_q(spark: SparkSession, sf_dir: str):
    """Write the alerts table, then scan it with the contract schema."""
    path = scratch_path(spark, "alerts")
    append(P.alerts(spark, sf_dir), path)
    return alerts_out(read_table_or_empty(spark, path, ALERTS_SCHEMA))


@query(
    "kpi_summary",
    with_base(
        "SELECT CAST(count(*) AS BIGINT) AS total_evaluations, "
        "CAST(COALESCE(trunc(sum(adverse_event_risk_score)), 0) AS BIGINT) AS high_risk_alerts, "
        "CASE WHEN count(*) > 0 THEN 100.0 * CAST(COALESCE(trunc(sum(adverse_event_risk_score)), 0) AS DOUBLE) / count(*) "
        "ELSE 0.0 END AS high_risk_ratio FROM alerts"
    ),
)
def kpi_summary_q(spark: SparkSession, sf_dir: str):
    return monitor.kpi_summary(P.alerts_table(spark, sf_dir))


@query(
    "kpi_text",
    with_base(
        """, k AS (SELECT count(*) AS n, CAST(COALESCE(trunc(sum(adverse_event_risk_score)), 0) AS BIGINT) AS h FROM alerts)
SELECT format('{:,}', n) || ' records' AS total_text, format('{:,}', h) || ' events' AS high_risk_text,
  printf('%.1f%%', CASE WHEN n > 0 THEN 100.0 * CAST(h AS DOUBLE) / n ELSE 0.0 END) || ' ratio' AS ratio_text FROM k"""
    ),
)
def kpi_text_q(spark: SparkSession, sf_dir: str):
    return monitor.kpi_text(monitor.kpi_summary(P.alerts_table(spark, sf_dir)))


@query(
    "velocity_by_clock",
    with_base(
        "SELECT strftime(evaluated_at, '%H:%M:%S') AS time_sec, CAST(count(*) AS BIGINT) AS message_count "
        "FROM alerts WHERE evaluated_at IS NOT NULL GROUP BY 1 ORDER BY 1"
    ),
)
def velocity_by_clock_q(spark: SparkSession, sf_dir: str):
    return monitor.velocity_by_clock(P.alerts_table(spark, sf_dir))


@query("alerts_latest", with_base(alerts_out_sql(tail="ORDER BY alerts.evaluated_at DESC NULLS LAST, event_id")))
def alerts_latest_q(spark: SparkSession, sf_dir: str):
    return alerts_out(monitor.latest_first(P.alerts_table(spark, sf_dir)))


def _audit_sql() -> str:
    cols = ", ".join(
        f'{ts_text_sql(c) if c == "evaluated_at" else c} AS "{h}"' for c, h in monitor.AUDIT_HEADINGS
    )
    return with_base(
        f"SELECT {cols} FROM alerts ORDER BY alerts.evaluated_at DESC NULLS LAST, event_id LIMIT {monitor.AUDIT_ROWS}"
    )


@query("audit_ledger", _audit_sql())
def audit_ledger_q(spark: SparkSession, sf_dir: str):
    return monitor.audit_ledger(P.alerts_table(spark, sf_dir), date_col=P.ALERTS_DATE)


@query(
    "risk_by_bp",
    with_base(
        "SELECT diastolic_bp, systolic_bp, adverse_event_risk_score, CAST(count(*) AS BIGINT) AS n_events "
        "FROM alerts GROUP BY 1, 2, 3"
    ),
)
def risk_by_bp_q(spark: SparkSession, sf_dir: str):
    return monitor.risk_by_bp(P.alerts_table(spark, sf_dir))


@query(
    "triage_alerts",
    with_base(
        f"SELECT event_id, round(risk_probability, {ROUND}) AS risk_probability, "
        "printf('%.2f%%', risk_probability * 100) AS risk_pct, 'ALERT' AS status FROM alerts WHERE risk_probability > 0.5"
    ),
)
def triage_alerts_q(spark: SparkSession, sf_dir: str):
    t = triage(P.alerts_table(spark, sf_dir))
    return t.select(
        "event_id",
        F.round("risk_probability", ROUND).alias("risk_probability"),
        percent_text(F.col("risk_probability") * 100, 2).alias("risk_pct"),
        "status",
    )


# Alerts written before this instant come from an older scorer that did not
# emit risk_probability (schema evolution across file slices).
SLICE_CUT = "2024-01-15 00:00:00"


@query(
    "union_slices",
    with_base(
        f"SELECT {ALERT_KEYS_SQL}, CASE WHEN evaluated_at < TIMESTAMP '{SLICE_CUT}' THEN NULL "
        f"ELSE round(risk_probability, {ROUND}) END AS risk_probability, "
        f"{ts_text_sql('evaluated_at')} AS evaluated_at FROM alerts"
    ),
)
def union_slices_q(spark: SparkSession, sf_dir: str):
    """Bag union of file slices with different schemas (missing columns -> null)."""
    path = scratch_path(spark, "alerts-slices")
    a = P.alerts_table(spark, sf_dir)
    old = F.col("evaluated_at") < F.lit(SLICE_CUT).cast("timestamp")
    append(a.where(old).drop("risk_probability"), path)
    append(a.where(~old | F.col("evaluated_at").isNull()), path)
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    return alerts_out(merged)


@query(
    "union_drifted",
    with_base(
        "SELECT event_id, CAST(systolic_bp AS VARCHAR) AS systolic_bp, diastolic_bp, rxnorm_id, snomed_code, "
        f"adverse_event_risk_score, CASE WHEN evaluated_at < TIMESTAMP '{SLICE_CUT}' THEN NULL "
        f"ELSE round(risk_probability, {ROUND}) END AS risk_probability, "
        f"{ts_text_sql('evaluated_at')} AS evaluated_at FROM alerts"
    ),
)
def union_drifted_q(spark: SparkSession, sf_dir: str):
    """Bag union of file slices whose column types changed: whole decisions became
    doubles, a pressure was sent as text for a while."""
    path = scratch_path(spark, "alerts-drifted")
    a = P.alerts_table(spark, sf_dir)
    t, cut = F.col("evaluated_at"), F.lit(SLICE_CUT).cast("timestamp")
    later = cut + F.expr("INTERVAL 7 DAYS")
    old = a.where(t < cut).drop("risk_probability")
    append(old.withColumn("adverse_event_risk_score", F.col("adverse_event_risk_score").cast("int")), path)
    append(a.where((t >= cut) & (t < later)).withColumn("systolic_bp", F.col("systolic_bp").cast("string")), path)
    append(a.where((t >= later) | t.isNull()), path)
    return alerts_out(union_drifted(spark, path))
