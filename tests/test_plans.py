"""Physical-plan properties the design relies on (checked on the executed plan)."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan: str) -> list[str]:
    return re.findall(r"FileScan parquet \[([^\]]*)\]", plan)


@pytest.fixture(scope="module")
def qs():
    return queries()


def test_flagship_reads_three_event_columns_and_aggregates_partially(spark, qs):
    plan = _plan(qs["signal_matrix"](spark, SF))
    assert _read_schemas(plan) and all(len(s.split(",")) == 3 for s in _read_schemas(plan))
    assert "partial_count" in plan
    assert "Python" not in plan  # coders, mask and parse are JVM expressions


def test_training_scan_is_pruned(spark, qs):
    plan = _plan(qs["feature_select"](spark, SF))
    (schema,) = _read_schemas(plan)
    assert sorted(c.split("#")[0] for c in schema.split(",")) == ["diastolic_bp", "rxnorm_id", "snomed_code", "systolic_bp"]


def test_triage_filter_reaches_the_scan(spark, qs):
    plan = _plan(qs["triage_alerts"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(risk_probability,0\.5\)", plan)


def test_kpis_read_one_column_with_partial_aggregation(spark, qs):
    plan = _plan(qs["kpi_summary"](spark, SF))
    (schema,) = _read_schemas(plan)
    assert schema.split("#")[0] == "adverse_event_risk_score"
    assert "partial_sum" in plan


def test_audit_ledger_is_a_top_k_over_the_newest_partitions(spark, qs):
    plan = _plan(qs["audit_ledger"](spark, SF))
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*evaluated_date", plan)


def test_rule_table_codes_rows_in_place(spark, qs):
    # the rule list is broadcast to a batch kernel: no join, no shuffle by text
    plan = _plan(qs["code_by_rule_table"](spark, SF))
    assert "Join" not in plan and "hashpartitioning" not in plan
    assert "CartesianProduct" not in plan


def test_silver_latest_scans_only_the_newest_partitions(spark, qs):
    plan = _plan(qs["silver_latest"](spark, SF))
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*ingested_date", plan)
