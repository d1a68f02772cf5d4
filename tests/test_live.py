"""Live monitoring: top-k and throughput kept by streams, contract checks, run records, drifting files."""

from __future__ import annotations

import json
import threading

import pytest
from pyspark.sql import functions as F

from clinsignal.operators import contract, monitor
from clinsignal.operators.scoring import DEFAULT_SCORECARD
from clinsignal.plans import layers as P
from clinsignal.plans.q_stream import _checked_run
from clinsignal.plans.topic_files import write_time_ordered_files
from clinsignal.schemas import ALERTS_SCHEMA
from clinsignal.session import scratch_path
from clinsignal.sources import sinks
from clinsignal.sources.fixtures import faulty_payloads
from clinsignal.sources.tables import common_type, union_drifted
from clinsignal.sources.topics import read_events
from clinsignal.streaming import jobs
from clinsignal.streaming.progress import RunRecorder, read_progress

NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def shuffled(spark, sf_small):
    """Alerts in an order that has nothing to do with their time, in 8 files, one per micro-batch."""
    path = scratch_path(spark, "alerts-shuffled")
    P.alerts(spark, sf_small).orderBy(F.md5("event_id")).repartition(8).write.parquet(path)
    return path


def _alerts(spark, path):
    return spark.readStream.schema(ALERTS_SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)


def test_newest_rows_kept_by_the_stream(spark, sf_small, shuffled):
    sink = scratch_path(spark, "latest-t")
    jobs.run_to_completion(jobs.start_latest(_alerts(spark, shuffled), sink, scratch_path(spark, "ckpt-l"), trigger=NOW))
    want = monitor.audit_ledger(P.alerts(spark, sf_small)).collect()
    assert jobs.read_latest(spark, sink).collect() == want and len(want) == monitor.AUDIT_ROWS
    # one folder for the last batch, one for readers of the batch before
    assert sinks.batch_ids(spark, sink) == [6, 7]
    files = jobs.read_latest(spark, sink).inputFiles()
    assert files and all("batch_id=7" in f for f in files)
    assert spark.read.parquet(f"{sink}/batch_id=7").count() == monitor.AUDIT_ROWS


def test_newest_rows_of_a_retried_batch(spark, sf_small):
    sink, rows = scratch_path(spark, "latest-r"), P.alerts(spark, sf_small).cache()
    held = []

    class Catch:  # takes the foreachBatch function out of the job
        def __getattr__(self, name):
            return lambda *a: (held.append(a[0]) if name == "foreachBatch" else None) or self

    class Stream:
        sparkSession, writeStream = spark, Catch()

    jobs.start_latest(Stream(), sink, "unused", rows=7)
    half = F.crc32("event_id") % 2 == 0
    for batch_id, part in ((0, rows.where(half)), (1, rows.where(~half)), (1, rows.where(~half))):
        held[0](part, batch_id)
    assert jobs.read_latest(spark, sink, 7).collect() == monitor.audit_ledger(rows, 7).collect()
    rows.unpersist()


def test_no_evaluations_yet(spark):
    assert jobs.read_latest(spark, scratch_path(spark, "latest-none")).count() == 0


def test_unsorted_alerts_are_counted_in_full(spark, sf_small, shuffled):
    sink, ckpt = scratch_path(spark, "vel-u"), scratch_path(spark, "ckpt-u")
    q = jobs.start_velocity(_alerts(spark, shuffled), sink, ckpt, trigger=NOW, merge_every=3)
    jobs.run_to_completion(q)
    want = jobs.windowed_counts(P.alerts(spark, sf_small))
    got = jobs.read_velocity(spark, sink)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # merged after batches 2 and 5: what a report may read is bounded
    assert sinks.batch_ids(spark, f"{sink}/merged") == [2, 5]
    assert sinks.batch_ids(spark, f"{sink}/recent") == [3, 4, 5, 6, 7]
    for day in sinks.folder_values(spark, f"{sink}/days", "day"):
        assert len(sinks.batch_ids(spark, f"{sink}/days/day={day}", "upto")) <= 2
    # a merge that is repeated, and one without anything to merge, change nothing
    jobs.merge_velocity(spark, sink)
    jobs.merge_velocity(spark, sink)
    assert jobs.read_velocity(spark, sink).exceptAll(want).count() == 0
    days = ("2024-01-10", "2024-01-11")
    some = jobs.read_velocity(spark, sink, days)
    inside = want.where(F.to_date("window_start").between(*[F.lit(d).cast("date") for d in days]))
    assert some.count() == inside.count() > 0 and some.exceptAll(inside).count() == 0
    files = some.inputFiles()
    assert files and all("day=2024-01-10" in f or "day=2024-01-11" in f or "/recent/" in f for f in files)


def test_a_merge_that_was_not_published_is_done_again(spark, sf_small):
    sink = scratch_path(spark, "vel-crash")
    counts = jobs.windowed_counts(P.alerts(spark, sf_small))
    for b in (0, 1):
        counts.write.parquet(f"{sink}/recent/batch_id={b}")
    # day files of a merge that ended before it was published
    half = counts.limit(3).withColumns({"day": F.to_date("window_start"), "upto": F.lit(1).cast("bigint")})
    half.write.partitionBy("day", "upto").parquet(f"{sink}/days")
    total = 2 * counts.agg(F.sum("message_count")).first()[0]
    assert jobs.read_velocity(spark, sink).agg(F.sum("message_count")).first()[0] == total
    jobs.merge_velocity(spark, sink)
    assert jobs.read_velocity(spark, sink).agg(F.sum("message_count")).first()[0] == total


# ------------------------------------------------------------------ contract checks
def test_rules_on_texts(spark):
    rows = [
        ("120", "80"), (None, "80"), ("", "80"), ("high", "80"), ("120.0", " 80 "), ("120.5", "80"), ("1e2", "80"), ("12d", "80"),
        ("39", "80"), ("301", "80"), ("1e300", "80"), ("-5", None), ("١٢٠", "80"),
    ]
    df = spark.createDataFrame([(*r, None, "7") for r in rows], "systolic_bp string, diastolic_bp string, rxnorm_id string, snomed_code string")
    got = [[tuple(v) for v in r[0]] for r in df.select(contract.violations()).collect()]
    sys = [g[0][1] if g and g[0][0] == "systolic_bp" else None for g in got]
    assert sys == [
        None, "missing", "not_a_number", "not_a_number", None, "not_whole", None, "not_a_number",
        "out_of_range", "out_of_range", "out_of_range", "out_of_range", "not_a_number",
    ]
    assert got[11] == [("systolic_bp", "out_of_range"), ("diastolic_bp", "missing")]


def test_checked_stream_rejects_scores_and_observes(spark, sf_small):
    raw = faulty_payloads(P.clinical_raw(spark, sf_small))
    path = scratch_path(spark, "topic-f")
    odd = spark.createDataFrame([(None, None, "t", None), (None, bytearray(b"[1]"), "t", None), (None, bytearray(b""), "t", None)], raw.schema)
    raw.unionByName(odd).repartition(3).write.parquet(path)
    stream = read_events(spark, fmt="parquet", options={"maxFilesPerTrigger": "1"}, path=path)
    alerts, rejected = scratch_path(spark, "al-c"), scratch_path(spark, "rej-c")
    q = jobs.start_checked_scoring(stream, DEFAULT_SCORECARD, alerts, rejected, scratch_path(spark, "ckpt-c"), trigger=NOW)
    jobs.run_to_completion(q)
    bad = spark.read.parquet(rejected)
    assert spark.read.parquet(alerts).count() + bad.count() == 1003
    counted = {(r["field"], r["reason"]): r["n"] for r in bad.select(F.explode("violations").alias("v")).groupBy("v.field", "v.reason").agg(F.count("*").alias("n")).collect()}
    # the metrics of the progress say the same, without a pass over the table
    metrics = [p.observedMetrics["contract"].asDict() for p in q.recentProgress if "contract" in p.observedMetrics]
    for (field, reason), n in counted.items():
        assert sum(m[f"{field}__{reason}"] for m in metrics) == n
    assert sum(m["n_rejected"] for m in metrics) == bad.count() and sum(m["n_rows"] for m in metrics) == 1003
    assert counted["payload", "malformed"] >= 3
    assert bad.where("payload is null").count() == 1


def test_checked_run_has_more_micro_batches_for_more_input(spark, sf_small, monkeypatch):
    monkeypatch.setattr(P, "SLICE_BYTES", P.table_stamp(spark, sf_small, "events")[0] // 6)
    alerts, rejected = _checked_run(spark, sf_small)
    assert len(sinks.batch_ids(spark, alerts)) == len(sinks.batch_ids(spark, rejected)) >= 6
    assert spark.read.schema(ALERTS_SCHEMA).parquet(alerts).count() + spark.read.parquet(rejected).count() == 1000


# ---------------------------------------------------------------------- run records
def test_stop_and_failure_are_recorded(spark, sf_small):
    topic = write_time_ordered_files(P.raw_topic(spark, sf_small), scratch_path(spark, "topic-r"), 3)
    root = scratch_path(spark, "registry-r")
    assert read_progress(spark, root).count() == 0
    recorder = RunRecorder(spark, root).attach()
    try:

        def stream():
            return read_events(spark, fmt="parquet", options=topic.stream_options(), path=topic.path)

        live = jobs.start_ingest(stream(), scratch_path(spark, "s-1"), scratch_path(spark, "c-1"), trigger={"processingTime": "0 seconds"}, query_name="live")
        live.processAllAvailable()
        recorder.stop(live)
        assert recorder.wait_end(live)

        def broken(batch, batch_id):
            raise ValueError("sink is gone")

        failing = stream().writeStream.foreachBatch(broken).option("checkpointLocation", scratch_path(spark, "c-2")).trigger(**NOW).start()
        with pytest.raises(Exception):
            jobs.run_to_completion(failing)
        assert recorder.wait_end(failing)
    finally:
        recorder.detach()
    rows = read_progress(spark, root).collect()
    mine = [r for r in rows if r["run_id"] == str(live.runId)]
    assert sum(r["n_rows"] for r in mine if r["kind"] == "batch") == 1000
    assert len({r["batch_id"] for r in mine if r["kind"] == "batch" and r["n_rows"]}) == 3
    assert all(json.loads(r["end_offsets"]) for r in mine if r["kind"] == "batch")
    assert [(r["cause"], r["n_rows"], r["name"]) for r in mine if r["kind"] == "end"] == [("stopped", 1000, "live")]
    ends = [r for r in rows if r["run_id"] == str(failing.runId) and r["kind"] == "end"]
    assert [r["cause"] for r in ends] == ["failed"] and "sink is gone" in ends[0]["error"]


def test_running_until_one_query_fails_stops_the_others(spark, sf_small):
    """K9: the failure of any query surfaces, and nothing is left running."""
    topic = write_time_ordered_files(P.raw_topic(spark, sf_small), scratch_path(spark, "topic-k9"), 2)

    def stream():
        return read_events(spark, fmt="parquet", options=topic.stream_options(), path=topic.path)

    def broken(batch, batch_id):
        raise ValueError("no more")

    good = jobs.start_ingest(stream(), scratch_path(spark, "s-k9"), scratch_path(spark, "c-k9"), trigger={"processingTime": "1 second"})
    bad = stream().writeStream.foreachBatch(broken).option("checkpointLocation", scratch_path(spark, "c-k9b")).start()
    with pytest.raises(Exception, match="no more"):
        jobs.run_until_stopped(spark, [good, bad])
    assert not good.isActive and not bad.isActive


# ------------------------------------------------------------------------ layers
def test_layers_follow_their_input(spark, sf_small, tmp_path):
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    events.limit(10).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    assert P.silver_table(spark, str(tmp_path)).count() == 10
    events.limit(5).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    assert P.silver_table(spark, str(tmp_path)).count() == 15
    assert P.gold_table(spark, str(tmp_path)).count() == 15


def test_date_tables_have_a_file_a_day(spark, sf_small):
    path = scratch_path(spark, "by-date")
    dated = P.alerts(spark, sf_small).withColumn("d", F.to_date("evaluated_at")).repartition(16)
    sinks.write_by_date(dated, "d", path)
    days = spark.read.parquet(path).select("d").distinct().count()
    assert len(spark.read.parquet(path).inputFiles()) == days > 20


# -------------------------------------------------------------------- drifting files
def test_union_of_drifted_files(spark):
    path = scratch_path(spark, "drift")
    slices = [
        "select 1 as k, 10 as n, cast(1.5 as double) as x, date'2024-01-02' as d",
        "select cast(2 as bigint) as k, 'ten' as n, timestamp'2024-01-03 04:05:06' as d",
        "select 3 as k, 2.25D as n, cast(null as double) as x, 'new' as y, date'2024-01-04' as d",
        "select 4 as k, 11 as n, cast(2.5 as double) as x, date'2024-01-05' as d",
    ]
    for s in slices:
        spark.sql(s).write.mode("append").parquet(path)
    df = union_drifted(spark, path)
    assert dict(df.dtypes) == {"k": "bigint", "n": "string", "x": "double", "d": "timestamp", "y": "string"}
    got = {r["k"]: (r["n"], r["x"], str(r["d"]), r["y"]) for r in df.collect()}
    assert got == {
        1: ("10", 1.5, "2024-01-02 00:00:00", None),
        2: ("ten", None, "2024-01-03 04:05:06", None),
        3: ("2.25", None, "2024-01-04 00:00:00", "new"),
        4: ("11", 2.5, "2024-01-05 00:00:00", None),
    }
    with pytest.raises(Exception):
        union_drifted(spark, scratch_path(spark, "no-files"))


def test_common_types():
    from pyspark.sql import types as T

    assert common_type([T.IntegerType(), T.LongType()]) == T.LongType()
    assert common_type([T.LongType(), T.FloatType()]) == T.DoubleType()
    assert common_type([T.BooleanType(), T.IntegerType()]) == T.StringType()
    assert common_type([T.NullType(), T.DateType()]) == T.DateType()


# ------------------------------------------------------------------------ versions
def test_two_writers_never_publish_one_version(spark):
    root, barrier, errors = scratch_path(spark, "snap-race"), threading.Barrier(4), []

    def write(k):
        try:
            frame = spark.range(k + 1)
            barrier.wait()
            sinks.write_snapshot(frame, root)
        except Exception as exc:  # noqa: BLE001
            errors.append(exc)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert sinks.claimed(spark, f"{root}/_versions") == [1, 2, 3, 4]
    version, path = sinks.current_version(spark, root)
    assert version == 4 and sinks.read_snapshot(spark, root).count() == spark.read.parquet(path).count()


def test_two_runs_never_record_one_version(spark):
    from clinsignal.operators.ledger import read_ledger, record_run

    root, barrier = scratch_path(spark, "ledger-race"), threading.Barrier(3)

    def run():
        barrier.wait()
        record_run(spark, root, "m", {"a": 1}, {"auc": 0.5})

    threads = [threading.Thread(target=run) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r["version"] for r in read_ledger(spark, root).collect()) == [1, 2, 3]


def test_a_claimed_number_is_not_given_again(spark):
    folder = scratch_path(spark, "claims")
    assert [sinks.claim_number(spark, folder, 1) for _ in range(3)] == [1, 2, 3]
    assert sinks.claim_number(spark, folder, 2) == 4


# ------------------------------------------------------------------- regex classes
ODD_TEXTS = [
    "dose 5", "dose\xa05", "dose ٥", "dose\x855", "dose\x1c5", "xéz", "x_z", "x-z", "x²z", "xéz", "Ⅷ", "٣4", "a b", "a​b",
    "tab\there", "[x]", "a&b", "no", "", None, "ß9", "naïve 7 mg", "12.5", "— 3", "line\nbreak", "x y",
]


@pytest.mark.parametrize(
    "pattern",
    [r"\b(dose)\s+\d+", r"\b(x)\w+z", r"x\Wz", r"\d\D|\D\d", r"a\sb", r"a\Sb", r"[\s\d]{2}", r"[^\w\s]", r"[\w&&x]9", r"\Bz", r"[]x]", r"[^\d]\d$", r"x.y", r"[[x]+]"],
)
def test_both_coders_read_a_rule_alike(spark, pattern):
    import re
    import warnings

    from clinsignal.functions.vocab import code_expr
    from clinsignal.operators.enrich import code_join, rules_frame

    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)], "i int, t string")
    rules = [(pattern, "hit")]
    native = df.withColumn("code", code_expr("t", rules, "none"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        table = code_join(df, "t", rules_frame(spark, rules), "code", "none")
        a = {r["i"]: r["code"] for r in native.collect()}
        b = {r["i"]: r["code"] for r in table.collect()}
        assert a == b
        assert any(re.search(pattern, t.lower()) for t in ODD_TEXTS if t) == ("hit" in b.values())
