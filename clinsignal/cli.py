"""Pipeline stages as commands: ``python -m clinsignal <stage> [options]``.

Stages: ingest (topic -> silver stream), standardize (silver -> gold
snapshot), inspect-silver, train (gold -> registered model), score-stream
(topic -> alerts + mirror, or alerts + rejected rows), triage (score one vector), report (alerts KPIs,
throughput, audit ledger).  The session comes from the environment
(``spark-submit`` / cluster defaults); only runtime confs are set here.
"""

from __future__ import annotations

import argparse
import json
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clinsignal.operators import contract, monitor
from clinsignal.operators.attribution import tree_attribution
from clinsignal.operators.auc import roc_auc
from clinsignal.operators.enrich import standardize
from clinsignal.operators.features import add_label, indicator_features, split, training_frame
from clinsignal.operators.ledger import load_serving, record_run
from clinsignal.operators.newton import Settings, train_newton
from clinsignal.operators.scoring import GBT_PARAMS, log_odds, score, train_gbt, triage
from clinsignal.schemas import ALERTS_SCHEMA, FEATURE_CONTRACT_V1
from clinsignal.session import configure
from clinsignal.sources.sinks import read_snapshot, write_snapshot
from clinsignal.sources.tables import literal_vector, read_table, read_table_or_empty
from clinsignal.sources.topics import RAW_TOPIC, read_events
from clinsignal.streaming import jobs
from clinsignal.streaming.progress import RunRecorder


# Spark's boosted trees have no intercept: their margin starts at log-odds 0.
BASELINE_LOG_ODDS = 0.0


def _session(app: str) -> SparkSession:
    return configure(SparkSession.builder.appName(app).getOrCreate())


def _topic(spark: SparkSession, args):
    if args.source == "kafka":
        options = {"kafka.bootstrap.servers": args.bootstrap, "subscribe": args.topic, "startingOffsets": args.starting_offsets}
        return read_events(spark, "kafka", options)
    return read_events(spark, args.source, {"maxFilesPerTrigger": str(args.max_files)}, path=args.topic_path)


def _trigger(args) -> dict | None:
    return {"availableNow": True} if args.available_now else None


@contextmanager
def _recorded(spark: SparkSession, root: str | None):
    """Write the progress and the end of the streams run inside to ``root``, if given."""
    if root is None:
        yield
        return
    recorder = RunRecorder(spark, root).attach()
    try:
        yield
    finally:
        recorder.settle()
        recorder.detach()


def cmd_ingest(args) -> None:
    spark = _session("clinsignal-ingest")
    with _recorded(spark, args.progress):
        q = jobs.start_ingest(_topic(spark, args), args.silver, args.checkpoint, args.format, _trigger(args), "ingest")
        jobs.run_until_stopped(spark, [q])


def cmd_standardize(args) -> None:
    spark = _session("clinsignal-standardize")
    if args.incremental:
        schema = read_table(spark, args.silver, args.format).schema
        stream = spark.readStream.format(args.format).schema(schema).load(args.silver)
        q = jobs.start_standardize(stream, args.gold, args.checkpoint, args.format, {"availableNow": True})
        jobs.run_to_completion(q)
        print(f"gold (incremental): {args.gold}")
        return
    silver = read_table(spark, args.silver, args.format)
    path = write_snapshot(standardize(silver), args.gold, args.format)
    preview = read_snapshot(spark, args.gold, args.format).select(
        "event_id", "medication_prescribed", "rxnorm_id", "snomed_code"
    )
    print(f"gold snapshot: {path}")
    preview.orderBy("event_id").show(5, truncate=False)


def cmd_inspect_silver(args) -> None:
    spark = _session("clinsignal-inspect")
    silver = read_table(spark, args.silver, args.format)
    silver.orderBy(F.col("ingested_at").desc_nulls_last(), "event_id").show(20, truncate=False)
    print(f"records: {silver.count()}")


def cmd_train(args) -> None:
    spark = _session("clinsignal-train")
    gold = read_snapshot(spark, args.gold, args.format)
    if args.contract == "v1":
        frame = add_label(indicator_features(gold.select("event_id", "rxnorm_id", "snomed_code", "systolic_bp", "diastolic_bp")))
        available = [f.name for f in FEATURE_CONTRACT_V1.fields]
    else:
        frame, available = training_frame(gold)
    train, test = split(frame)
    params = {"max_depth": args.max_depth, "step_size": args.step_size, "max_iter": args.max_iter, "seed": GBT_PARAMS["seed"]}
    if args.booster == "newton":
        settings = Settings(max_depth=args.max_depth, rate=args.step_size, rounds=args.max_iter)
        model = train_newton(train, available, settings=settings)
    else:
        model = train_gbt(train, available, **params)
    params["booster"] = args.booster
    metrics = roc_auc(log_odds(test, model), "margin", "label")
    # the audited row: the first of the test side
    audited = tree_attribution(test.orderBy("event_id").limit(1), model, available, baseline=BASELINE_LOG_ODDS).first()
    if audited is not None:
        metrics = metrics.withColumn("audit_delta_p", F.lit(audited["delta_p"]))
        print(f"audit of {audited['event_id']}: delta P = {audited['delta_p'] * 100:.2f}%")
    params |= {"explainer_type": "TreeSHAP", "baseline_expectation_phi0": BASELINE_LOG_ODDS}
    signature = contract.signature_json(score(train, model), available)
    row = record_run(spark, args.registry, args.name, params, metrics, signature, model)
    print(json.dumps(row.select("name", "version", "metrics", "path").first().asDict(), default=str))


def cmd_score_stream(args) -> None:
    spark = _session("clinsignal-score")
    model, inputs = load_serving(spark, args.registry, args.name, args.version)
    mirror = None if args.mirror == "none" else args.mirror
    inline = not args.no_inline_codes
    with _recorded(spark, args.progress):
        if args.rejected:
            q = jobs.start_checked_scoring(
                _topic(spark, args), model, args.alerts, args.rejected, args.checkpoint, trigger=_trigger(args), query_name="score"
            )
        else:
            q = jobs.start_fanout(
                _topic(spark, args), model, args.alerts, args.checkpoint, mirror, _trigger(args), inline, args.format, inputs
            )
        jobs.run_until_stopped(spark, [q])


def cmd_triage(args) -> None:
    spark = _session("clinsignal-triage")
    model, inputs = load_serving(spark, args.registry, args.name, args.version)
    rows = None
    if args.vector:
        sys_bp, dia_bp, rx, sn = args.vector
        rows = [(float(sys_bp), float(dia_bp), int(rx), int(sn))]
    vector = literal_vector(spark, rows)
    if inputs is not None:
        vector = contract.enforce_inputs(vector, inputs)
    triage(score(vector, model), alerts_only=False).show(truncate=False)


def cmd_report(args) -> None:
    spark = _session("clinsignal-report")
    alerts = read_table_or_empty(spark, args.alerts, ALERTS_SCHEMA, args.format)
    dated = jobs.ALERTS_DATE in alerts.columns  # date-partitioned tables prune old partitions
    monitor.kpi_text(monitor.kpi_summary(alerts)).show(truncate=False)
    monitor.velocity_by_clock(alerts).show(args.rows, truncate=False)
    monitor.audit_ledger(alerts, date_col=jobs.ALERTS_DATE if dated else None).show(truncate=False)


def _topic_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--source", default="kafka", help="kafka, or a file format of Kafka-shaped files")
    p.add_argument("--bootstrap", default="localhost:9092")
    p.add_argument("--topic", default=RAW_TOPIC)
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--topic-path", help="directory of Kafka-shaped files (file sources)")
    p.add_argument("--max-files", type=int, default=1)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    p.add_argument("--progress", help="folder for the run record: every micro-batch and how the run ended")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="clinsignal")
    sub = ap.add_subparsers(dest="stage", required=True)

    p = sub.add_parser("ingest")
    _topic_args(p)
    p.add_argument("--silver", required=True)
    p.add_argument("--format", default="parquet")
    p.set_defaults(fn=cmd_ingest)

    p = sub.add_parser("standardize")
    p.add_argument("--silver", required=True)
    p.add_argument("--gold", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--incremental", action="store_true", help="append only rows new since the last run (needs --checkpoint)")
    p.add_argument("--checkpoint")
    p.set_defaults(fn=cmd_standardize)

    p = sub.add_parser("inspect-silver")
    p.add_argument("--silver", required=True)
    p.add_argument("--format", default="parquet")
    p.set_defaults(fn=cmd_inspect_silver)

    p = sub.add_parser("train")
    p.add_argument("--gold", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--registry", required=True)
    p.add_argument("--name", default="signal_detector")
    p.add_argument("--max-depth", type=int, default=GBT_PARAMS["max_depth"])
    p.add_argument("--step-size", type=float, default=GBT_PARAMS["step_size"])
    p.add_argument("--max-iter", type=int, default=GBT_PARAMS["max_iter"])
    p.add_argument("--booster", choices=["gbt", "newton"], default="gbt", help="first-order (Spark ML) or second-order trees")
    p.add_argument("--contract", choices=["v4", "v1"], default="v4", help="v4: 4 int64 features; v1: BPs + code indicators")
    p.set_defaults(fn=cmd_train)

    p = sub.add_parser("score-stream")
    _topic_args(p)
    p.add_argument("--registry", required=True)
    p.add_argument("--name", default="signal_detector")
    p.add_argument("--version", type=int)
    p.add_argument("--alerts", required=True)
    p.add_argument("--format", default="parquet", help="table format of the alerts (delta commits every batch)")
    p.add_argument("--mirror", default="console", help="console, none, or a table path")
    p.add_argument("--rejected", help="table for rows that break the field rules; without it odd fields are scored as 0")
    p.add_argument("--no-inline-codes", action="store_true", help="score codes exactly as sent (missing -> 0)")
    p.set_defaults(fn=cmd_score_stream)

    p = sub.add_parser("triage")
    p.add_argument("--registry", required=True)
    p.add_argument("--name", default="signal_detector_v1")
    p.add_argument("--version", type=int)
    p.add_argument("--vector", type=float, nargs=4, metavar=tuple(f.name for f in FEATURE_CONTRACT_V1.fields))
    p.set_defaults(fn=cmd_triage)

    p = sub.add_parser("report")
    p.add_argument("--alerts", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--rows", type=int, default=20)
    p.set_defaults(fn=cmd_report)
    return ap


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.fn(args)

