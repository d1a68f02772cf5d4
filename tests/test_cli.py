"""The pipeline stages as commands, end to end on a file-backed topic."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException

from clinsignal import cli
from clinsignal.cli import main
from clinsignal.operators.contract import OUTPUTS, enforce_inputs
from clinsignal.operators.ledger import load_serving, read_ledger
from clinsignal.plans import layers as P
from clinsignal.plans.topic_files import write_time_ordered_files
from clinsignal.schemas import ALERTS_SCHEMA
from clinsignal.session import scratch_path
from clinsignal.sources.tables import read_table_or_empty
from clinsignal.sources.topics import write_topic
from clinsignal.streaming.progress import read_progress


def test_stages_end_to_end(spark, sf_small, capsys):
    topic = write_time_ordered_files(P.raw_topic(spark, sf_small), scratch_path(spark, "cli-topic"), 2)
    silver, gold, registry, alerts = (scratch_path(spark, n) for n in ("cli-silver", "cli-gold", "cli-reg", "cli-alerts"))
    src = ["--source", "parquet", "--topic-path", topic.path, "--max-files", str(topic.files_per_slice), "--available-now"]
    main(["ingest", *src, "--checkpoint", scratch_path(spark, "cli-c1"), "--silver", silver])
    assert spark.read.parquet(silver).count() == 1000
    main(["standardize", "--silver", silver, "--gold", gold])
    gold_inc = scratch_path(spark, "cli-gold-inc")
    main(["standardize", "--silver", silver, "--gold", gold_inc, "--incremental", "--checkpoint", scratch_path(spark, "cli-c0")])
    assert spark.read.parquet(gold_inc).count() == 1000
    main(["inspect-silver", "--silver", silver])
    main(["train", "--gold", gold, "--registry", registry, "--max-iter", "3", "--max-depth", "3"])
    main(["train", "--gold", gold, "--registry", registry, "--name", "signal_detector_v1", "--contract", "v1",
          "--max-iter", "3", "--max-depth", "3"])
    main(["score-stream", *src, "--checkpoint", scratch_path(spark, "cli-c2"), "--registry", registry,
          "--alerts", alerts, "--mirror", "none"])
    assert read_table_or_empty(spark, alerts, ALERTS_SCHEMA).count() == 1000
    # second-order trees, checked rows and a run record on the same topic
    main(["train", "--gold", gold, "--registry", registry, "--name", "newton", "--booster", "newton", "--max-iter", "2", "--max-depth", "2"])
    checked, rejected, record = (scratch_path(spark, n) for n in ("cli-checked", "cli-rejected", "cli-record"))
    main(["score-stream", *src, "--checkpoint", scratch_path(spark, "cli-c3"), "--registry", registry, "--name", "newton",
          "--alerts", checked, "--rejected", rejected, "--progress", record])
    assert read_table_or_empty(spark, checked, ALERTS_SCHEMA).count() == 1000 and spark.read.parquet(rejected).count() == 0
    end = read_progress(spark, record).where("kind = 'end'").first()
    assert (end["n_rows"], end["cause"], end["name"]) == (1000, "drained", "score")
    model, inputs = load_serving(spark, registry, "signal_detector")
    run = read_ledger(spark, registry).where("name = 'signal_detector'").first()
    stored = json.loads(run["contract"])
    assert inputs.names == ["rxnorm_id", "snomed_code", "systolic_bp", "diastolic_bp"]
    assert len(stored["example"]) == 3 and [f["name"] for f in stored["outputs"]["fields"]] == OUTPUTS
    assert run["params"]["explainer_type"] == "TreeSHAP" and "audit_delta_p" in run["metrics"]
    main(["triage", "--registry", registry, "--vector", "145", "92", "1", "1"])
    main(["report", "--alerts", alerts])
    out = capsys.readouterr().out
    assert "records: 1000" in out and "1,000 records" in out and "Event Identifier" in out


def test_inputs_are_aligned_to_the_contract_or_refused(spark):
    contract = spark.range(0).selectExpr("id AS a", "double(id) AS b").schema
    swapped = spark.createDataFrame([("x", 1.5, 7)], "key string, b float, a int")
    aligned = enforce_inputs(swapped, contract)
    assert aligned.columns == ["key", "a", "b"] and aligned.first() == ("x", 7, 1.5)
    with pytest.raises(AnalysisException):
        enforce_inputs(swapped.drop("a"), contract).collect()
    with pytest.raises(AnalysisException):
        enforce_inputs(swapped.withColumn("a", swapped["key"]), contract).collect()


def test_topic_rows_written_are_read_back(spark, sf_small):
    rows = P.raw_topic(spark, sf_small)
    path = scratch_path(spark, "topic-out")
    write_topic(rows, "parquet", path=path)
    assert spark.read.parquet(path).select("key", "value").exceptAll(rows.select("key", "value")).count() == 0
    assert spark.read.parquet(path).count() == rows.count()


def test_a_topic_is_read_from_its_latest_offsets_unless_told(monkeypatch):
    """T4: the options that reach the reader (no broker here)."""
    seen = []
    monkeypatch.setattr(cli, "read_events", lambda spark, fmt, options, **kw: seen.append((fmt, options)))
    common = ["ingest", "--checkpoint", "c", "--silver", "s"]
    cli._topic(None, cli.parser().parse_args(common))
    cli._topic(None, cli.parser().parse_args([*common, "--starting-offsets", "earliest", "--topic", "t", "--bootstrap", "h:1"]))
    assert seen[0] == ("kafka", {"kafka.bootstrap.servers": "localhost:9092", "subscribe": "raw-clinical-events", "startingOffsets": "latest"})
    assert seen[1] == ("kafka", {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest"})
