"""Structured Streaming jobs: sanitize to silver, score to alerts, throughput.

All jobs are built from the batch operators (the same DataFrame functions
work on streaming frames), write with a checkpoint per query (one checkpoint
= one query), and take a trigger: default micro-batches in production,
``availableNow`` in tests and replays.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from clinsignal.functions.numeric import coerce_bigint
from clinsignal.functions.vocab import rxnorm_code, snomed_code
from clinsignal.operators.contract import SERVING_RULES, enforce_inputs, observed, violations
from clinsignal.operators.enrich import standardize
from clinsignal.operators.features import align_features
from clinsignal.operators.ingest import parse_events, parse_payload, sanitize
from clinsignal.operators.monitor import AUDIT_ROWS, audit_ledger, latest_first
from clinsignal.operators.scoring import Scorecard, score
from clinsignal.schemas import ALERTS_SCHEMA, INFERENCE_PAYLOAD_SCHEMA, SCORING_PAYLOAD_SCHEMA
from clinsignal.sources.sinks import batch_ids, drop_folders, folder_values

ALERT_COLUMNS = [f.name for f in ALERTS_SCHEMA.fields]
# date partition columns of the silver and alerts tables
SILVER_DATE = "ingested_date"
ALERTS_DATE = "evaluated_date"


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**trigger) if trigger else writer


# -- ingest ---------------------------------------------------------------------


def sanitized_stream(raw: DataFrame) -> DataFrame:
    """Topic rows -> parsed -> identifier dropped, SSN masked, stamped."""
    return sanitize(parse_events(raw))


def start_ingest(
    raw: DataFrame,
    sink_path: str,
    checkpoint: str,
    sink_fmt: str = "parquet",
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append the sanitized stream to the silver table (exactly-once via the
    sink's commit log and the checkpoint), partitioned by ingestion date."""
    writer = (
        sanitized_stream(raw)
        .withColumn(SILVER_DATE, F.to_date("ingested_at"))
        .writeStream.format(sink_fmt)
        .outputMode("append")
        .partitionBy(SILVER_DATE)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start(sink_path)


def start_standardize(
    silver: DataFrame,
    gold_path: str,
    checkpoint: str,
    sink_fmt: str = "parquet",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Incremental gold: code only the silver files added since the last run.

    ``silver`` is the silver table read as a stream (its file-sink commit log
    lists what is new); with ``availableNow`` this is a batch job that never
    re-codes old rows, in place of rewriting gold from all of silver.
    """
    writer = (
        standardize(silver)
        .writeStream.format(sink_fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, trigger).start(gold_path)


# -- scoring ----------------------------------------------------------------------


CODE_TEXTS = {"rxnorm_id": "rxnorm_text", "snomed_code": "snomed_text"}


def with_code_texts(rows: DataFrame) -> DataFrame:
    """The codes of a payload's texts in columns of their own, for payloads without codes.

    Their readers use a code more than once; a column is computed once, where an
    expression would run the coder again at every use.  Not in a branch, where
    the parts that its rules share would not be computed once either.
    """
    coders = {"rxnorm_id": rxnorm_code("medication_prescribed"), "snomed_code": snomed_code("clinical_notes")}
    return rows.withColumns({text: coders[c] for c, text in CODE_TEXTS.items()})


def scored_stream(
    raw: DataFrame,
    model: Scorecard | PipelineModel,
    enrich_inline: bool = True,
    contract: StructType | None = None,
) -> DataFrame:
    """Topic rows -> payload -> codes -> aligned int64 features -> score -> stamp.

    With ``enrich_inline`` (default) codes missing from the payload are derived
    from its medication / notes text with the native coders; otherwise missing
    codes become 0, as a payload-only consumer sees them.  With ``contract`` (of
    a registered model) a frame that does not fit it raises before it is scored.
    """
    if enrich_inline:
        p = with_code_texts(parse_payload(raw, schema=SCORING_PAYLOAD_SCHEMA))
        p = p.withColumns({c: F.coalesce(F.col(c).cast("bigint"), coerce_bigint(text)) for c, text in CODE_TEXTS.items()})
    else:
        p = parse_payload(raw, schema=INFERENCE_PAYLOAD_SCHEMA)
    aligned = align_features(p)
    if contract is not None:
        aligned = enforce_inputs(aligned, contract)
    return (
        score(aligned, model)
        .withColumn("evaluated_at", F.current_timestamp())
        .select(*ALERT_COLUMNS)
    )


def start_scoring(
    raw: DataFrame,
    model: Scorecard | PipelineModel,
    sink_path: str,
    checkpoint: str,
    sink_fmt: str = "parquet",
    trigger: dict | None = None,
    enrich_inline: bool = True,
) -> StreamingQuery:
    writer = (
        scored_stream(raw, model, enrich_inline)
        .withColumn(ALERTS_DATE, F.to_date("evaluated_at"))
        .writeStream.format(sink_fmt)
        .outputMode("append")
        .partitionBy(ALERTS_DATE)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, trigger).start(sink_path)


def fanout_writer(alerts_path: str, mirror: str | None = "console", mirror_rows: int = 20, fmt: str = "parquet"):
    """foreachBatch function: score once, write alerts and a mirror.

    The batch is persisted so both sinks reuse one computation.  Output is
    partitioned by evaluation date (like every alerts table) and batch id; each
    sink overwrites only its own ``batch_id=<id>`` partitions, so a retried batch
    (foreachBatch is at-least-once) replaces its own output instead of
    duplicating it.  ``mirror`` is "console", None, or a table path.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            tagged = batch.withColumn(ALERTS_DATE, F.to_date("evaluated_at")).withColumn(
                "batch_id", F.lit(batch_id).cast("bigint")
            )
            (
                tagged.write.format(fmt)
                .mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(ALERTS_DATE, "batch_id")
                .save(alerts_path)
            )
            if mirror == "console":
                batch.show(mirror_rows, truncate=False)
            elif mirror:
                (
                    tagged.write.format(fmt)
                    .mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy(ALERTS_DATE, "batch_id")
                    .save(mirror)
                )
        finally:
            batch.unpersist()

    return write


def start_fanout(
    raw: DataFrame,
    model: Scorecard | PipelineModel,
    alerts_path: str,
    checkpoint: str,
    mirror: str | None = "console",
    trigger: dict | None = None,
    enrich_inline: bool = True,
    fmt: str = "parquet",
    contract: StructType | None = None,
) -> StreamingQuery:
    """One scoring query, two sinks (alerts table + mirror) in the table format ``fmt``."""
    writer = (
        scored_stream(raw, model, enrich_inline, contract)
        .writeStream.foreachBatch(fanout_writer(alerts_path, mirror, fmt=fmt))
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, trigger).start()


CHECKED_PAYLOAD_SCHEMA = StructType(
    [StructField(n, StringType()) for n in (*SCORING_PAYLOAD_SCHEMA.names, "_corrupt_record")]
)
CONTRACT_METRICS = "contract"


def checked_payload(raw: DataFrame, rules=SERVING_RULES) -> DataFrame:
    """Topic rows -> payload fields as text, and the rules that each row breaks."""
    payload = F.col("value").cast("string")
    data = F.from_json(payload, CHECKED_PAYLOAD_SCHEMA, {"columnNameOfCorruptRecord": "_corrupt_record"})
    rows = raw.select(payload.alias("payload"), data.alias("data")).select("payload", "data.*")
    malformed = F.col("payload").isNull() | F.col("_corrupt_record").isNotNull()
    return observed(rows.withColumn("violations", violations(rules, malformed)).drop("_corrupt_record"), CONTRACT_METRICS, rules)


def scored_payload(rows: DataFrame, model: Scorecard | PipelineModel) -> DataFrame:
    """Rows that keep the contract -> codes -> int64 features -> score -> stamp."""
    typed = with_code_texts(rows).withColumns(
        {
            "systolic_bp": coerce_bigint("systolic_bp"),
            "diastolic_bp": coerce_bigint("diastolic_bp"),
            **{c: coerce_bigint(F.coalesce(F.col(c), F.col(text))) for c, text in CODE_TEXTS.items()},
        }
    )
    return score(typed, model).withColumn("evaluated_at", F.current_timestamp()).select(*ALERT_COLUMNS)


def start_checked_scoring(
    raw: DataFrame,
    model: Scorecard | PipelineModel,
    alerts_path: str,
    rejected_path: str,
    checkpoint: str,
    rules=SERVING_RULES,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Score the rows that keep the contract; write the others aside with their reasons.

    Nothing is filled in or cast to 0: a row with a missing or odd field goes to the
    rejected table as it came.  Both sinks replace only their own ``batch_id=``
    folder, so a retried batch repeats itself; counts per field and reason come
    with the query's progress (``observedMetrics``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = batch.where(F.size("violations") == 0)
            scored_payload(good, model).write.mode("overwrite").parquet(f"{alerts_path}/batch_id={batch_id}")
            (
                batch.where(F.size("violations") > 0)
                .select("event_id", "payload", "violations", F.current_timestamp().alias("rejected_at"))
                .write.mode("overwrite")
                .parquet(f"{rejected_path}/batch_id={batch_id}")
            )
        finally:
            batch.unpersist()

    writer = checked_payload(raw, rules).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()


# -- throughput -------------------------------------------------------------------


def windowed_counts(events: DataFrame, ts_col: str = "evaluated_at", window: str = "1 second") -> DataFrame:
    """Event-time tumbling-window counts of the given rows."""
    return (
        events.groupBy(F.window(ts_col, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("message_count"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "message_count")
    )


MERGE_EVERY = 16  # micro-batches whose counts are merged into the day files at once


def _merged_upto(spark, sink_path: str) -> int:
    """Number of the last micro-batch that the day files contain (-1: none)."""
    done = batch_ids(spark, f"{sink_path}/merged")
    return done[-1] if done else -1


def merge_velocity(spark, sink_path: str) -> None:
    """Fold the micro-batches' counts into one file per day.

    Only the days that the waiting counts touch -- late rows may touch old ones --
    are written anew, beside their former versions.  A folder under ``merged``
    publishes the result; a merge that stops before it is done again.  What
    neither this version nor a reader of the one before needs is dropped.
    """
    before = _merged_upto(spark, sink_path)
    waiting = [b for b in batch_ids(spark, f"{sink_path}/recent") if b > before]
    if not waiting:
        return
    recent, upto = _recent_counts(spark, sink_path, before), waiting[-1]
    days = [str(r["day"]) for r in recent.select(F.to_date("window_start").alias("day")).distinct().collect()]
    held = _day_counts(spark, sink_path, before, days)
    merged = _summed(recent if held is None else recent.unionByName(held))
    (
        merged.withColumns({"day": F.to_date("window_start"), "upto": F.lit(upto).cast("bigint")})
        .repartition("day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "upto")
        .parquet(f"{sink_path}/days")
    )
    spark.range(1).write.mode("overwrite").parquet(f"{sink_path}/merged/batch_id={upto}")
    useless = [f"recent/batch_id={b}" for b in batch_ids(spark, f"{sink_path}/recent") if b <= before]
    useless += [f"merged/batch_id={b}" for b in batch_ids(spark, f"{sink_path}/merged") if b < before]
    for day in days:
        versions = batch_ids(spark, f"{sink_path}/days/day={day}", "upto")
        needed = [v for v in versions if v <= before][-1:] + [upto]
        useless += [f"days/day={day}/upto={v}" for v in versions if v not in needed]
    drop_folders(spark, [f"{sink_path}/{u}" for u in useless])


VELOCITY_SCHEMA = "window_start timestamp, window_end timestamp, message_count bigint"


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("window_start", "window_end").agg(F.sum("message_count").alias("message_count"))


def _recent_counts(spark, sink_path: str, after: int) -> DataFrame:
    """Counts of the micro-batches that no merge contains yet."""
    parts = spark.read.schema(f"{VELOCITY_SCHEMA}, batch_id bigint").parquet(f"{sink_path}/recent")
    return parts.where(F.col("batch_id") > after).drop("batch_id")


def _day_counts(spark, sink_path: str, upto: int, days: list[str] | None = None) -> DataFrame | None:
    """Counts as published by merge ``upto``: one folder a day, its newest up to that merge."""
    base, paths = f"{sink_path}/days", []
    for day in folder_values(spark, base, "day"):
        if days is None or day in days:
            versions = [v for v in batch_ids(spark, f"{base}/day={day}", "upto") if v <= upto]
            paths += [f"{base}/day={day}/upto={v}" for v in versions[-1:]]
    return spark.read.schema(VELOCITY_SCHEMA).parquet(*paths) if paths else None


def start_velocity(
    events: DataFrame,
    sink_path: str,
    checkpoint: str,
    ts_col: str = "evaluated_at",
    window: str = "1 second",
    trigger: dict | None = None,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Counts per event-time window, whatever the order of the rows.

    A micro-batch writes its own counts to its own ``batch_id=`` folder (idempotent
    on retry); every ``merge_every`` batches they are folded into one file per day.
    There is no state to grow and no watermark to fall behind: a late row adds to
    its window's sum when it comes.  A report reads the day files of its days and
    at most ``merge_every`` small ones.
    """
    spark = events.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            windowed_counts(batch, ts_col, window)
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(f"{sink_path}/recent/batch_id={batch_id}")
        )
        if (batch_id + 1) % merge_every == 0:
            merge_velocity(spark, sink_path)

    writer = (
        events.select(ts_col)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, trigger).start()


def read_velocity(spark, sink_path: str, days: tuple | None = None) -> DataFrame:
    """Count per window, of all history or of the days from ``days[0]`` to ``days[1]``."""
    upto = _merged_upto(spark, sink_path)
    parts = _recent_counts(spark, sink_path, upto)
    wanted = None
    if days is not None:
        wanted = [d for d in folder_values(spark, f"{sink_path}/days", "day") if str(days[0]) <= d <= str(days[1])]
        parts = parts.where(F.to_date("window_start").between(F.lit(str(days[0])).cast("date"), F.lit(str(days[1])).cast("date")))
    merged = _day_counts(spark, sink_path, upto, wanted)
    return _summed(parts if merged is None else parts.unionByName(merged))


# -- newest evaluations -----------------------------------------------------------


def start_latest(
    alerts: DataFrame,
    sink_path: str,
    checkpoint: str,
    rows: int = AUDIT_ROWS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the newest ``rows`` evaluations of the alerts stream.

    The top-k of a union is the top-k of the parts' top-ks: each micro-batch
    merges its own (one row set of k per task) with that of the batch before and
    writes the k rows to its ``batch_id=`` folder.  A retried batch finds the same
    predecessor, so it writes the same rows; older folders are dropped.
    """
    spark, columns = alerts.sparkSession, [f.name for f in ALERTS_SCHEMA.fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        earlier = [b for b in batch_ids(spark, sink_path) if b < batch_id]
        newest = latest_first(batch.select(*columns), limit=rows)
        if earlier:
            held = spark.read.schema(ALERTS_SCHEMA).parquet(f"{sink_path}/batch_id={earlier[-1]}")
            newest = latest_first(held.unionByName(newest), limit=rows)
        newest.coalesce(1).write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")
        # the batch before stays: a reader may be in it, and a retry needs it
        drop_folders(spark, [f"{sink_path}/batch_id={b}" for b in earlier[:-1]])

    writer = alerts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def read_latest(spark, sink_path: str, rows: int = AUDIT_ROWS) -> DataFrame:
    """Audit ledger from the stream's newest top-k; reads that one file only."""
    done = batch_ids(spark, sink_path)
    if not done:
        return audit_ledger(spark.createDataFrame([], ALERTS_SCHEMA), rows)
    return audit_ledger(spark.read.schema(ALERTS_SCHEMA).parquet(f"{sink_path}/batch_id={done[-1]}"), rows)


def start_kpis(
    alerts: DataFrame,
    sink_path: str,
    checkpoint: str,
    score_col: str = "adverse_event_risk_score",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Running totals (evaluations, sum of decisions) over the alerts stream.

    A global streaming aggregate: its state is one row however much data
    flows, so a monitor never rescans the table.  Complete mode re-emits the
    totals each micro-batch into that batch's partition; ``read_kpis`` turns
    the latest totals into the KPI row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(sink_path)
        )

    totals = alerts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(score_col)).alias("s"))
    writer = totals.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def read_kpis(spark, sink_path: str) -> DataFrame:
    """KPI row from the latest running totals (same columns as ``monitor.kpi_summary``)."""
    latest = spark.read.parquet(sink_path).agg(F.max_by("n", "batch_id").alias("n"), F.max_by("s", "batch_id").alias("s"))
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    high = F.coalesce(F.col("s").try_cast("bigint"), F.lit(0).cast("bigint"))
    return latest.select(
        n.alias("total_evaluations"),
        high.alias("high_risk_alerts"),
        F.when(n > 0, F.lit(100.0) * high.cast("double") / n.cast("double")).otherwise(F.lit(0.0)).alias("high_risk_ratio"),
    )


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Block until an ``availableNow`` query drains its input; re-raise failures."""
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise query.exception()
    return query



def run_until_stopped(spark, queries: list[StreamingQuery]) -> None:
    """Block until any query ends or the process is interrupted, then stop all.

    A failure of *any* query surfaces here (waiting on one query alone would
    hide a failure of the others).  Earlier terminations in the session are
    cleared first; otherwise the wait would return at once.
    """
    spark.streams.resetTerminated()
    try:
        spark.streams.awaitAnyTermination()
    except KeyboardInterrupt:
        pass
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()
