"""Streaming queries: each runs a Structured Streaming job over a file-backed
topic derived from ``events`` (``availableNow``, several micro-batches), then
returns the batch read of its sink.  Processing-time stamps are left out of
the outputs so that results are comparable with the batch SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clinsignal.operators.features import split
from clinsignal.operators.ledger import load_model, record_run
from clinsignal.operators.newton import train_newton
from clinsignal.operators.scoring import DEFAULT_SCORECARD
from clinsignal.plans import layers as P
from clinsignal.plans.q_ingest import SILVER_COLS, SILVER_COLS_SQL
from clinsignal.plans.q_model import NEWTON_FEATURES, TRIAGE
from clinsignal.plans.q_monitor import alerts_out, alerts_out_sql  # also registers kpi_summary (oracle reused below)
from clinsignal.plans.registry import ORACLES, query
from clinsignal.plans.sql_base import sigmoid_sql, test_side_sql, with_base
from clinsignal.plans.sql_trees import applied_ctes, newton_ctes
from clinsignal.plans.topic_files import write_time_ordered_files
from clinsignal.schemas import ALERTS_SCHEMA, FEATURES
from clinsignal.session import scratch_path
from clinsignal.sources.fixtures import faulty_payloads
from clinsignal.sources.topics import read_events
from clinsignal.streaming import jobs
from clinsignal.streaming.progress import RunRecorder, read_progress

AVAILABLE_NOW = {"availableNow": True}


def _raw_stream(spark: SparkSession, sf_dir: str):
    """Subscribe to the shared file-backed topic (one time slice per micro-batch)."""
    topic = P.topic_files(spark, sf_dir)
    return read_events(spark, fmt="parquet", options=topic.stream_options(), path=topic.path)


@query("stream_ingest", with_base(f"SELECT {SILVER_COLS_SQL} FROM silver"))
def stream_ingest_q(spark: SparkSession, sf_dir: str):
    """Topic -> parse -> sanitize -> silver file sink (append, checkpointed)."""
    sink = scratch_path(spark, "silver-stream")
    q = jobs.start_ingest(
        _raw_stream(spark, sf_dir), sink, scratch_path(spark, "ckpt-ingest"), trigger=AVAILABLE_NOW
    )
    jobs.run_to_completion(q)
    return spark.read.parquet(sink).select(*SILVER_COLS)


@query("gold_incremental", with_base(f"SELECT {SILVER_COLS_SQL}, rxnorm_id, snomed_code FROM gold"))
def gold_incremental_q(spark: SparkSession, sf_dir: str):
    """Topic -> silver stream, then silver (as a stream) -> gold, appending only new rows."""
    silver_path, gold_path = scratch_path(spark, "silver-inc"), scratch_path(spark, "gold-inc")
    q = jobs.start_ingest(_raw_stream(spark, sf_dir), silver_path, scratch_path(spark, "ckpt-silver-inc"), trigger=AVAILABLE_NOW)
    jobs.run_to_completion(q)
    silver_stream = spark.readStream.schema(spark.read.parquet(silver_path).schema).parquet(silver_path)
    q = jobs.start_standardize(silver_stream, gold_path, scratch_path(spark, "ckpt-gold-inc"), trigger=AVAILABLE_NOW)
    jobs.run_to_completion(q)
    return spark.read.parquet(gold_path).select(*SILVER_COLS, "rxnorm_id", "snomed_code")


@query("stream_score", with_base(alerts_out_sql(with_time=False)))
def stream_score_q(spark: SparkSession, sf_dir: str):
    """Topic -> payload -> inline codes -> aligned features -> score -> alerts sink."""
    sink = scratch_path(spark, "alerts-stream")
    q = jobs.start_scoring(
        _raw_stream(spark, sf_dir), DEFAULT_SCORECARD, sink, scratch_path(spark, "ckpt-score"), trigger=AVAILABLE_NOW
    )
    jobs.run_to_completion(q)
    return alerts_out(spark.read.schema(ALERTS_SCHEMA).parquet(sink), with_time=False)


@query("stream_fanout", with_base(alerts_out_sql(with_time=False)))
def stream_fanout_q(spark: SparkSession, sf_dir: str):
    """One scoring query, two sinks via foreachBatch (alerts + mirror table)."""
    alerts_path = scratch_path(spark, "alerts-fanout")
    mirror_path = scratch_path(spark, "alerts-mirror")
    q = jobs.start_fanout(
        _raw_stream(spark, sf_dir),
        DEFAULT_SCORECARD,
        alerts_path,
        scratch_path(spark, "ckpt-fanout"),
        mirror=mirror_path,
        trigger=AVAILABLE_NOW,
    )
    jobs.run_to_completion(q)
    return alerts_out(spark.read.parquet(alerts_path).drop("batch_id"), with_time=False)


@query(
    "velocity_stream",
    with_base(
        "SELECT strftime(date_trunc('second', evaluated_at), '%Y-%m-%d %H:%M:%S') AS window_start, "
        "CAST(count(*) AS BIGINT) AS message_count FROM alerts WHERE evaluated_at IS NOT NULL GROUP BY 1"
    ),
)
def velocity_stream_q(spark: SparkSession, sf_dir: str):
    """Alerts as an unordered stream -> 1-second counts per micro-batch, merged by day."""
    src = P.alerts_files(spark, sf_dir)
    events = spark.readStream.schema(ALERTS_SCHEMA).options(**src.stream_options()).parquet(src.path)
    sink = scratch_path(spark, "velocity")
    q = jobs.start_velocity(events, sink, scratch_path(spark, "ckpt-velocity"), trigger=AVAILABLE_NOW, merge_every=3)
    jobs.run_to_completion(q)
    counts = jobs.read_velocity(spark, sink)
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "message_count")



@query("kpi_stream", ORACLES["kpi_summary"])
def kpi_stream_q(spark: SparkSession, sf_dir: str):
    """KPIs maintained incrementally over the alerts stream (one-row state)."""
    src = P.alerts_files(spark, sf_dir)
    events = spark.readStream.schema(ALERTS_SCHEMA).options(**src.stream_options()).parquet(src.path)
    sink = scratch_path(spark, "kpis")
    jobs.run_to_completion(jobs.start_kpis(events, sink, scratch_path(spark, "ckpt-kpis"), trigger=AVAILABLE_NOW))
    return jobs.read_kpis(spark, sink)


@query("audit_ledger_stream", ORACLES["audit_ledger"])
def audit_ledger_stream_q(spark: SparkSession, sf_dir: str):
    """The newest evaluations, kept by the stream; the report reads k rows."""
    src = P.alerts_files(spark, sf_dir)
    events = spark.readStream.schema(ALERTS_SCHEMA).options(**src.stream_options()).parquet(src.path)
    sink = scratch_path(spark, "latest")
    jobs.run_to_completion(jobs.start_latest(events, sink, scratch_path(spark, "ckpt-latest"), trigger=AVAILABLE_NOW))
    return jobs.read_latest(spark, sink)


# The faulty feed in SQL (texts as sent), and the rules judged on them.
_FAULTY_SQL = """
, sent AS (
  SELECT event_id, id, id % 97 = 0 AS cut,
    CASE id % 19 WHEN 0 THEN NULL WHEN 1 THEN 'high' WHEN 2 THEN systolic_bp || '0' WHEN 3 THEN systolic_bp || '.5'
      ELSE CAST(systolic_bp AS VARCHAR) END AS systolic_bp,
    CASE id % 23 WHEN 0 THEN NULL WHEN 1 THEN '8O' WHEN 2 THEN '5' WHEN 3 THEN ' ' || diastolic_bp || '.0'
      ELSE CAST(diastolic_bp AS VARCHAR) END AS diastolic_bp
  FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) AS id FROM clinical_raw)),
judged AS (
  SELECT event_id, field, CASE WHEN cut THEN 'malformed' WHEN text IS NULL THEN 'missing'
      WHEN TRY_CAST(trim(text) AS DOUBLE) IS NULL THEN 'not_a_number'
      WHEN TRY_CAST(trim(text) AS DOUBLE) <> floor(TRY_CAST(trim(text) AS DOUBLE)) THEN 'not_whole'
      WHEN TRY_CAST(trim(text) AS DOUBLE) NOT BETWEEN low AND high THEN 'out_of_range' END AS reason
  FROM (SELECT event_id, FALSE AS cut, 'systolic_bp' AS field, systolic_bp AS text, 40 AS low, 300 AS high FROM sent WHERE NOT cut
    UNION ALL SELECT event_id, FALSE, 'diastolic_bp', diastolic_bp, 20, 200 FROM sent WHERE NOT cut
    UNION ALL SELECT event_id, TRUE, 'payload', NULL, 0, 0 FROM sent WHERE cut))
"""


def _checked_run(spark: SparkSession, sf_dir: str):
    """(alerts path, rejected path) of a checked scoring run over the faulty feed."""
    raw = faulty_payloads(P.clinical_raw(spark, sf_dir))
    topic = write_time_ordered_files(raw, scratch_path(spark, "topic-faulty"), P.topic_slices(spark, sf_dir, 3))
    stream = read_events(spark, fmt="parquet", options=topic.stream_options(), path=topic.path)
    alerts, rejected = scratch_path(spark, "alerts-checked"), scratch_path(spark, "rejected")
    q = jobs.start_checked_scoring(
        stream, DEFAULT_SCORECARD, alerts, rejected, scratch_path(spark, "ckpt-checked"), trigger=AVAILABLE_NOW
    )
    jobs.run_to_completion(q)
    return alerts, rejected


@query(
    "contract_violations",
    with_base(
        _FAULTY_SQL
        + "SELECT field, reason, CAST(count(*) AS BIGINT) AS n_events FROM judged WHERE reason IS NOT NULL GROUP BY field, reason"
    ),
)
def contract_violations_q(spark: SparkSession, sf_dir: str):
    """Rows that a scoring stream rejects, counted by field and reason."""
    _, rejected = _checked_run(spark, sf_dir)
    broken = spark.read.parquet(rejected).select(F.explode("violations").alias("v"))
    return broken.groupBy("v.field", "v.reason").agg(F.count(F.lit(1)).alias("n_events"))


@query(
    "score_checked",
    with_base(
        _FAULTY_SQL
        + ", good AS (SELECT event_id FROM sent WHERE event_id NOT IN (SELECT event_id FROM judged WHERE reason IS NOT NULL)) "
        + alerts_out_sql(with_time=False, tail="WHERE event_id IN (SELECT event_id FROM good)")
    ),
)
def score_checked_q(spark: SparkSession, sf_dir: str):
    """The rows of the same feed that keep the contract, scored."""
    alerts, _ = _checked_run(spark, sf_dir)
    return alerts_out(spark.read.schema(ALERTS_SCHEMA).parquet(alerts), with_time=False)


# Instants at which the recorded run's micro-batches end.
PROGRESS_CUTS = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 12:00:00"]


def _progress_sql() -> str:
    batch = " + ".join(f"CAST(ts >= TIMESTAMP '{c}' AS INTEGER)" for c in PROGRESS_CUTS)
    return with_base(
        f", b AS (SELECT {batch} AS slice FROM clinical_raw), "
        "n AS (SELECT slice, count(*) AS n FROM b GROUP BY slice) "
        "SELECT 'batch' AS kind, CAST(row_number() OVER (ORDER BY slice) - 1 AS BIGINT) AS batch_id, "
        "CAST(n AS BIGINT) AS n_rows, NULL AS cause FROM n UNION ALL "
        "SELECT 'end', NULL, CAST(sum(n) AS BIGINT), 'drained' FROM n"
    )


@query("stream_progress", _progress_sql())
def stream_progress_q(spark: SparkSession, sf_dir: str):
    """The record of an ingest run: rows of every micro-batch, and how it ended."""
    cuts = [int(datetime.fromisoformat(f"{c}+00:00").timestamp()) * 1_000_000 for c in PROGRESS_CUTS]
    topic = write_time_ordered_files(P.raw_topic(spark, sf_dir), scratch_path(spark, "topic-cuts"), 0, bounds=cuts)
    root = scratch_path(spark, "registry")
    recorder = RunRecorder(spark, root).attach()
    try:
        q = jobs.start_ingest(
            read_events(spark, fmt="parquet", options=topic.stream_options(), path=topic.path),
            scratch_path(spark, "silver-recorded"),
            scratch_path(spark, "ckpt-recorded"),
            trigger=AVAILABLE_NOW,
        )
        jobs.run_to_completion(q)
        recorder.wait_end(q)
    finally:
        recorder.detach()
    mine = read_progress(spark, root).where(F.col("run_id") == str(q.runId))
    return mine.where("kind = 'end' or n_rows > 0").select("kind", "batch_id", "n_rows", "cause")


@query(
    "stream_score_trees",
    with_base(
        newton_ctes(f"SELECT event_id, {', '.join(FEATURES)}, label FROM feats WHERE NOT {test_side_sql()}", NEWTON_FEATURES, TRIAGE)
        + applied_ctes("SELECT event_id, systolic_bp, diastolic_bp, rxnorm_id, snomed_code FROM alerts", NEWTON_FEATURES, TRIAGE)
        + ", tree_alerts AS (SELECT event_id, systolic_bp, diastolic_bp, rxnorm_id, snomed_code, "
        f"CAST({sigmoid_sql('margin')} > 0.5 AS DOUBLE) AS adverse_event_risk_score, {sigmoid_sql('margin')} AS risk_probability FROM scored) "
        + alerts_out_sql("tree_alerts", with_time=False)
    ),
)
def stream_score_trees_q(spark: SparkSession, sf_dir: str):
    """The scoring stream with a trained tree model, loaded from the registry."""
    train, _ = split(P.features(spark, sf_dir))
    root = scratch_path(spark, "registry")
    record_run(spark, root, "trees", {"rounds": TRIAGE.rounds}, {"depth": TRIAGE.max_depth}, model=train_newton(train, NEWTON_FEATURES, settings=TRIAGE))
    sink = scratch_path(spark, "alerts-trees")
    q = jobs.start_scoring(
        _raw_stream(spark, sf_dir), load_model(spark, root, "trees", 1), sink, scratch_path(spark, "ckpt-trees"), trigger=AVAILABLE_NOW
    )
    jobs.run_to_completion(q)
    return alerts_out(spark.read.schema(ALERTS_SCHEMA).parquet(sink), with_time=False)
