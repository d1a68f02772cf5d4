"""Streaming: rows in = rows out, restart adds nothing, batch = stream, fan-out agreement."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clinsignal.functions.vocab import rxnorm_code, snomed_code
from clinsignal.operators.ingest import parse_payload
from clinsignal.operators.scoring import DEFAULT_SCORECARD
from clinsignal.plans import layers as P
from clinsignal.plans import topic_files
from clinsignal.plans.q_ingest import SILVER_COLS
from clinsignal.plans.topic_files import write_time_ordered_files
from clinsignal.schemas import SCORING_PAYLOAD_SCHEMA
from clinsignal.session import scratch_path
from clinsignal.sources.topics import read_events
from clinsignal.streaming import jobs

NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def topic(spark, sf_small):
    return write_time_ordered_files(P.raw_topic(spark, sf_small), scratch_path(spark, "topic-test"), 3)


def test_topic_slices_grow_in_files(spark, sf_small, monkeypatch):
    """The files of a slice follow its bytes, with equal shares of its rows."""
    monkeypatch.setattr(topic_files, "FILE_BYTES", 2048, raising=False)
    rows = P.raw_topic(spark, sf_small).repartition(2)
    topic = write_time_ordered_files(rows, scratch_path(spark, "topic-files"), 5)
    written = spark.read.parquet(topic.path).withColumn("file", F.input_file_name())
    files = written.groupBy("file").agg(F.count("*").alias("n")).collect()
    assert len(files) == topic.n_slices * topic.files_per_slice and topic.n_slices == 5
    assert topic.files_per_slice >= 4
    assert max(f["n"] for f in files) <= 2 * 1000 / len(files)
    assert written.drop("file").exceptAll(rows).count() == 0 and written.count() == 1000


def test_topic_with_small_and_undated_slices(spark):
    """Slices of a few rows have as many files as the others; empty ones are left out."""
    times = F.when(F.col("id") % 10 > 0, F.timestamp_seconds(F.when(F.col("id") < 995, F.lit(50)).otherwise(F.lit(250))))
    rows = spark.range(0, 1000, 1, 8).select("id", times.alias("timestamp"))
    bounds = [100_000_000, 200_000_000, 300_000_000]
    topic = write_time_ordered_files(rows, scratch_path(spark, "topic-odd"), 0, bounds=bounds)
    batches = []
    stream = spark.readStream.schema(rows.schema).options(**topic.stream_options()).parquet(topic.path)
    sink = stream.writeStream.foreachBatch(lambda batch, _: batches.append(batch.agg(F.count("*"), F.count("timestamp")).first()))
    jobs.run_to_completion(sink.option("checkpointLocation", scratch_path(spark, "ckpt-odd")).trigger(**NOW).start())
    assert [tuple(b) for b in batches] == [(995, 895), (5, 5)]


def _stream(spark, topic):
    return read_events(spark, fmt="parquet", options=topic.stream_options(), path=topic.path)


def test_ingest_restart_adds_nothing_and_equals_batch(spark, sf_small, topic):
    sink, ckpt = scratch_path(spark, "silver-t"), scratch_path(spark, "ckpt-t")
    q = jobs.run_to_completion(jobs.start_ingest(_stream(spark, topic), sink, ckpt, trigger=NOW))
    assert len(q.recentProgress) >= 3  # one time slice per micro-batch
    first = spark.read.parquet(sink).count()
    jobs.run_to_completion(jobs.start_ingest(_stream(spark, topic), sink, ckpt, trigger=NOW))
    assert spark.read.parquet(sink).count() == first == 1000
    stream_rows = spark.read.parquet(sink).select(*SILVER_COLS)
    batch_rows = P.silver(spark, sf_small).select(*SILVER_COLS)
    assert stream_rows.exceptAll(batch_rows).count() == 0 and batch_rows.exceptAll(stream_rows).count() == 0


def test_fanout_sinks_agree(spark, topic):
    alerts, mirror = scratch_path(spark, "alerts-t"), scratch_path(spark, "mirror-t")
    q = jobs.start_fanout(_stream(spark, topic), DEFAULT_SCORECARD, alerts, scratch_path(spark, "ckpt-f"), mirror=mirror, trigger=NOW)
    jobs.run_to_completion(q)
    a = spark.read.parquet(alerts)
    m = spark.read.parquet(mirror)
    assert a.count() == m.count() == 1000
    assert a.exceptAll(m).count() == 0
    assert a.select("batch_id").distinct().count() >= 3


def test_scoring_matches_batch_alerts(spark, sf_small, topic):
    sink = scratch_path(spark, "score-t")
    jobs.run_to_completion(
        jobs.start_scoring(_stream(spark, topic), DEFAULT_SCORECARD, sink, scratch_path(spark, "ckpt-s"), trigger=NOW)
    )
    cols = ["event_id", "systolic_bp", "diastolic_bp", "rxnorm_id", "snomed_code", "adverse_event_risk_score"]
    stream_rows = spark.read.parquet(sink).select(*cols)
    batch_rows = P.alerts(spark, sf_small).select(*cols)
    assert stream_rows.exceptAll(batch_rows).count() == 0 and batch_rows.exceptAll(stream_rows).count() == 0


def test_scoring_runs_each_coder_once(spark, sf_small):
    """The alerts need a code several times; its rules stand in the plan once."""
    raw = P.raw_topic(spark, sf_small)
    payload = parse_payload(raw, schema=SCORING_PAYLOAD_SCHEMA)
    coded = payload.select(rxnorm_code("medication_prescribed").alias("rx"), snomed_code("clinical_notes").alias("sn"))

    def rules(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("(?d)")

    once = rules(coded)
    assert once > 5 and rules(jobs.scored_stream(raw, DEFAULT_SCORECARD)) == once
    assert rules(jobs.scored_payload(jobs.checked_payload(raw), DEFAULT_SCORECARD)) == once


def test_second_start_on_live_checkpoint_is_refused(spark, topic):
    ckpt = scratch_path(spark, "ckpt-live")
    first = jobs.start_ingest(_stream(spark, topic), scratch_path(spark, "live"), ckpt, trigger={"processingTime": "1 second"})
    try:
        first.processAllAvailable()
        with pytest.raises(Exception):
            jobs.start_ingest(_stream(spark, topic), scratch_path(spark, "live2"), ckpt, trigger={"processingTime": "1 second"})
        assert first.isActive
    finally:
        first.stop()


def test_velocity_stream_counts(spark, sf_small):
    src = write_time_ordered_files(P.alerts(spark, sf_small), scratch_path(spark, "alerts-src-t"), 3, "evaluated_at")
    from clinsignal.schemas import ALERTS_SCHEMA

    events = spark.readStream.schema(ALERTS_SCHEMA).options(**src.stream_options()).parquet(src.path)
    sink = scratch_path(spark, "vel-t")
    jobs.run_to_completion(jobs.start_velocity(events, sink, scratch_path(spark, "ckpt-v"), trigger=NOW))
    counts = jobs.read_velocity(spark, sink)
    assert counts.agg(F.sum("message_count")).first()[0] == 1000


def test_incremental_gold_codes_only_new_rows(spark, topic):
    silver, gold = scratch_path(spark, "silver-i"), scratch_path(spark, "gold-i")
    ckpt_gold = scratch_path(spark, "ckpt-gi")
    jobs.run_to_completion(jobs.start_ingest(_stream(spark, topic), silver, scratch_path(spark, "ckpt-si"), trigger=NOW))
    schema = spark.read.parquet(silver).schema
    jobs.run_to_completion(jobs.start_standardize(spark.readStream.schema(schema).parquet(silver), gold, ckpt_gold, trigger=NOW))
    assert spark.read.parquet(gold).count() == 1000
    # nothing new in silver: a second run appends nothing
    jobs.run_to_completion(jobs.start_standardize(spark.readStream.schema(schema).parquet(silver), gold, ckpt_gold, trigger=NOW))
    assert spark.read.parquet(gold).count() == 1000
