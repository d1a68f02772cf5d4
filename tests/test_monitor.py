"""Monitoring reports and table sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from clinsignal.operators import monitor
from clinsignal.plans import layers as P
from clinsignal.schemas import ALERTS_SCHEMA
from clinsignal.session import scratch_path
from clinsignal.sources.sinks import current_version, read_snapshot, write_snapshot
from clinsignal.sources.tables import read_table_or_empty


def test_kpis_on_empty_table(spark):
    empty = spark.createDataFrame([], ALERTS_SCHEMA)
    row = monitor.kpi_summary(empty).first()
    assert (row["total_evaluations"], row["high_risk_alerts"], row["high_risk_ratio"]) == (0, 0, 0.0)
    text = monitor.kpi_text(monitor.kpi_summary(empty)).first()
    assert text["total_text"] == "0 records" and text["ratio_text"] == "0.0% ratio"


def test_missing_table_reads_empty(spark):
    df = read_table_or_empty(spark, scratch_path(spark, "nothing-here"), ALERTS_SCHEMA)
    assert df.count() == 0 and df.schema == ALERTS_SCHEMA


def test_audit_ledger_shape(spark, sf_small):
    ledger = monitor.audit_ledger(P.alerts(spark, sf_small))
    assert ledger.count() == 15
    assert ledger.columns[0] == "Event Identifier" and ledger.columns[-1] == "Assessed ADE Risk Score"


def test_velocity_groups_merge_days(spark, sf_oracle):
    v = monitor.velocity_by_clock(P.alerts(spark, sf_oracle))
    assert v.count() == 9464
    assert v.agg(F.sum("message_count")).first()[0] == 10000


def test_snapshot_versions(spark, sf_small):
    root = scratch_path(spark, "snap")
    g = P.gold(spark, sf_small)
    write_snapshot(g, root)
    write_snapshot(g.limit(10), root)
    version, _ = current_version(spark, root)
    assert version == 2
    assert read_snapshot(spark, root).count() == 10


def test_compaction_keeps_rows(spark, sf_small):
    from clinsignal.sources.sinks import compact

    src = scratch_path(spark, "many-files")
    P.alerts(spark, sf_small).repartition(20).write.parquet(src)
    root = scratch_path(spark, "compacted")
    path = compact(spark, src, root, 2)
    assert spark.read.parquet(path).count() == 1000
    assert len([f for f in spark.read.parquet(path).inputFiles()]) <= 2


def test_newest_partitions_is_exact_for_top_k(spark):
    from pyspark.sql import types as T

    from clinsignal.sources.tables import newest_partitions

    rows = (
        [(f"a{i}", f"2024-01-01 0{i % 10}:00:00") for i in range(10)]  # 10 rows on day 1
        + [("b0", "2024-01-02 01:00:00"), ("b1", "2024-01-02 02:00:00")]  # 2 rows on day 2
        + [("c0", "2024-01-03 05:00:00")]  # 1 row on day 3
        + [("n0", None)]  # undated
    )
    path = scratch_path(spark, "dated")
    schema = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("ts", T.StringType())])
    df = spark.createDataFrame(rows, schema).select("event_id", F.col("ts").cast("timestamp").alias("evaluated_at"))
    df.withColumn("d", F.to_date("evaluated_at")).write.partitionBy("d").parquet(path)
    table = spark.read.parquet(path)

    def top(t, k):
        return [r[0] for r in monitor.latest_first(t, limit=k).select("event_id").collect()]

    for k in (1, 3, 4, 13, 14, 20):
        assert top(newest_partitions(table, k, "d"), k) == top(table, k)
    # 4 newest rows need days 3 and 2 and part of day 1 -> days 1..3 kept, undated dropped
    assert newest_partitions(table, 4, "d").where(F.col("d").isNull()).count() == 0
