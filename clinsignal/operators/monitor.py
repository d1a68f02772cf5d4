"""Monitoring reports over the scored alerts table.

Every report is one aggregation or one top-k over the table: KPIs are a single
global aggregate (partial per task, one tiny final merge), throughput is a
grouped count with map-side combine, the audit ledger is a top-k
(``TakeOrderedAndProject``: each task keeps k rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinsignal.functions.numeric import percent_text, thousands
from clinsignal.functions.text import clock_text, ts_text
from clinsignal.sources.tables import newest_partitions

# Display headings of the audit ledger, in column order.
AUDIT_HEADINGS = [
    ("event_id", "Event Identifier"),
    ("evaluated_at", "Evaluation Timestamp"),
    ("systolic_bp", "Systolic BP"),
    ("diastolic_bp", "Diastolic BP"),
    ("rxnorm_id", "RxNorm ID"),
    ("snomed_code", "SNOMED Code"),
    ("adverse_event_risk_score", "Assessed ADE Risk Score"),
]
AUDIT_ROWS = 15


def kpi_summary(alerts: DataFrame, score_col: str = "adverse_event_risk_score") -> DataFrame:
    """One row: total evaluations, high-risk count (sum of decisions, truncated), ratio in %.

    An empty table gives one all-zero row.
    """
    agg = alerts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(score_col)).alias("s"))
    n = F.col("n")
    high = F.coalesce(F.col("s").try_cast("bigint"), F.lit(0).cast("bigint"))
    return agg.select(
        n.cast("bigint").alias("total_evaluations"),
        high.alias("high_risk_alerts"),
        F.when(n > 0, F.lit(100.0) * high.cast("double") / n.cast("double")).otherwise(F.lit(0.0)).alias("high_risk_ratio"),
    )


def kpi_text(kpis: DataFrame) -> DataFrame:
    """Display text of the KPI row: ``1,234 records``, ``56 events``, ``4.5% ratio``."""
    return kpis.select(
        F.concat(thousands("total_evaluations"), F.lit(" records")).alias("total_text"),
        F.concat(thousands("high_risk_alerts"), F.lit(" events")).alias("high_risk_text"),
        F.concat(percent_text("high_risk_ratio", 1), F.lit(" ratio")).alias("ratio_text"),
    )


def velocity_by_clock(alerts: DataFrame, ts_col: str = "evaluated_at") -> DataFrame:
    """Messages per second-of-day text (days merge), sorted by key, null times dropped."""
    keyed = alerts.where(F.col(ts_col).isNotNull()).select(clock_text(ts_col).alias("time_sec"))
    return keyed.groupBy("time_sec").agg(F.count(F.lit(1)).alias("message_count")).orderBy("time_sec")


def latest_first(alerts: DataFrame, ts_col: str = "evaluated_at", limit: int | None = None) -> DataFrame:
    """Newest first, missing times last, event id as tie-break; optional top-k."""
    ordered = alerts.orderBy(F.col(ts_col).desc_nulls_last(), F.col("event_id").asc_nulls_last())
    return ordered.limit(limit) if limit is not None else ordered


def audit_ledger(alerts: DataFrame, rows: int = AUDIT_ROWS, date_col: str | None = None) -> DataFrame:
    """Latest ``rows`` evaluations with display headings.

    With ``date_col`` (the table's date partition column) only the newest
    partitions are scanned.
    """
    if date_col is not None:
        alerts = newest_partitions(alerts, rows, date_col)
    top = latest_first(alerts.select(*[c for c, _ in AUDIT_HEADINGS]), limit=rows)
    return top.select(
        *[
            (ts_text(c) if c == "evaluated_at" else F.col(c)).alias(heading)
            for c, heading in AUDIT_HEADINGS
        ]
    )


def risk_by_bp(alerts: DataFrame) -> DataFrame:
    """Scatter data as counts per (diastolic, systolic, decision) triple."""
    return alerts.groupBy("diastolic_bp", "systolic_bp", "adverse_event_risk_score").agg(
        F.count(F.lit(1)).alias("n_events")
    )
