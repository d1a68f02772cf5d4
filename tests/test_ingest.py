"""Parsing and sanitizing: malformed input is kept as all-null rows, never dropped."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinsignal.operators.ingest import parse_events, parse_payload, sanitize
from clinsignal.plans import layers as P

EDGE_PAYLOADS = [
    '{"event_id": "e1", "systolic_bp": 145, "diastolic_bp": 92}',
    '{"event_id": "e2", "rxnorm_id": "17767"}',
    "not json",
    "",
    '{"event_id": "e5", "systolic_bp": "NaN"}',
    '{"event_id": 6, "systolic_bp": "150", "rxnorm_id": 17767.5}',
    None,
    '{"event_id": null, "extra": {"a": 1}}',
    "[1, 2]",
    '{"event_id": "e10", "snomed_code": 99999999999}',
    '{"event_id": "a", "event_id": "e11"}',
    '{"event_id": {"x": 1}}',
    '{"event_id": "e13", "systolic_bp": 1',
]


def _raw(spark, payloads):
    rows = [(None if p is None else bytearray(p.encode("utf-8")), i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("value", T.BinaryType()), T.StructField("i", T.IntegerType())]))


def test_edge_payloads_are_kept(spark):
    parsed = parse_payload(_raw(spark, EDGE_PAYLOADS), carry=["i"])
    rows = {r["i"]: r for r in parsed.collect()}
    assert len(rows) == len(EDGE_PAYLOADS)
    assert rows[0]["systolic_bp"] == 145.0 and rows[0]["rxnorm_id"] is None
    assert rows[1]["event_id"] == "e2" and rows[1]["rxnorm_id"] is None
    for i in (2, 3, 6, 8, 12):
        assert all(rows[i][c] is None for c in ("event_id", "systolic_bp", "diastolic_bp", "rxnorm_id", "snomed_code"))
    assert math.isnan(rows[4]["systolic_bp"])
    assert rows[5]["event_id"] == "6" and rows[5]["systolic_bp"] is None and rows[5]["rxnorm_id"] is None
    assert rows[7]["event_id"] is None
    assert rows[9]["snomed_code"] is None
    assert rows[10]["event_id"] == "e11"
    assert rows[11]["event_id"] == '{"x":1}'


def test_sanitize_keeps_every_row(spark):
    silver = sanitize(parse_events(_raw(spark, EDGE_PAYLOADS)))
    assert silver.count() == len(EDGE_PAYLOADS)
    assert "patient_name" not in silver.columns
    assert silver.where(F.col("ingested_at").isNull()).count() == 0


def test_silver_golden_counts(spark, sf_oracle):
    s = P.silver(spark, sf_oracle)
    counts = {
        "masked": s.where(F.col("patient_ssn") == "XXX-XX-XXXX").count(),
        "null": s.where(F.col("patient_ssn").isNull()).count(),
        "redacted": s.where(F.col("patient_ssn") == "redacted").count(),
    }
    assert counts == {"masked": 9344, "null": 345, "redacted": 311}


def test_gold_golden_code_counts(spark, sf_oracle):
    g = P.gold(spark, sf_oracle)
    rx = {r[0]: r[1] for r in g.groupBy("rxnorm_id").count().collect()}
    sn = {r[0]: r[1] for r in g.groupBy("snomed_code").count().collect()}
    assert rx == {"00000": 3333, "17767": 2222, "29302": 1112, "311654": 1111, "5640": 1111, "json_36561": 1111}
    assert sn == {"000000000": 2500, "266395002": 1250, "404640003": 2500, "450428004": 2500, "709044004": 1250}


def test_alerts_golden_high_risk(spark, sf_small, sf_oracle):
    for sf, expected in ((sf_small, 407), (sf_oracle, 4158)):
        assert P.alerts(spark, sf).where(F.col("adverse_event_risk_score") == 1.0).count() == expected


def test_json_roundtrip_keeps_nulls(spark, sf_small):
    payload = P.raw_topic(spark, sf_small).select(F.col("value").cast("string").alias("v"))
    with_null = payload.where(F.col("v").contains('"patient_ssn":null')).count()
    assert with_null > 0  # null fields are written as JSON nulls, not dropped


def test_fixture_goldens_across_scales(spark):
    """Golden counts of FIXTURES.md: high-risk alerts and threshold-label positives per scale."""
    from clinsignal.operators.features import split

    expected = {
        "/root/testdata/sf0.001": (407, 393),
        "/root/testdata/sf0.01": (4158, 3921),
        "/root/testdata/sf0.1": (41460, 39216),
    }
    for sf, (high_risk, positives) in expected.items():
        assert P.alerts(spark, sf).where(F.col("adverse_event_risk_score") == 1.0).count() == high_risk
        assert P.features(spark, sf).where(F.col("label") == 1).count() == positives
    _, test = split(P.features(spark, "/root/testdata/sf0.01"))
    assert test.count() == 2000  # exactly a fifth
