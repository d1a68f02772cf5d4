"""DuckDB-dialect SQL for the shared derivations (the oracle side).

Each oracle query is ``BASE_CTES`` followed by its own SELECT.  The CTEs
mirror ``plans.layers`` step by step: clinical_raw -> silver -> gold ->
feats (training frame) -> alerts.
"""

from __future__ import annotations

from clinsignal.functions.numeric import NUMERIC_TEXT
from clinsignal.functions.text import SSN_MASK, SSN_PATTERN
from clinsignal.functions.vocab import RXNORM_DEFAULT, RXNORM_RULES, SNOMED_DEFAULT, SNOMED_RULES
from clinsignal.operators.features import HASH_DIGITS, LABEL_THRESHOLD, SPLIT_SEED, TEST_FRACTION
from clinsignal.operators.scoring import DEFAULT_SCORECARD, Scorecard
from clinsignal.sources.fixtures import MEDICATION_TEXTS, NOTE_TEXTS


def lit(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def pick_sql(key: str, values: list) -> str:
    arms = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values))
    return f"CASE {key} {arms} END"


def strip_sql(col: str) -> str:
    """Lower-cased text without ASCII white space at its ends (all the fixture has)."""
    return f"lower(regexp_replace({col}, '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g'))"


def code_sql(col: str, rules: list[tuple[str, str]], default: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({strip_sql(col)}, {lit(p)}) THEN {lit(c)}" for p, c in rules)
    return f"CASE {arms} ELSE {lit(default)} END"


def coerce_sql(col: str) -> str:
    text = f"CAST({col} AS VARCHAR)"
    parsed = f"CASE WHEN regexp_matches({text}, {lit(NUMERIC_TEXT)}) THEN TRY_CAST(trim({text}) AS DOUBLE) END"
    whole = f"CASE WHEN regexp_matches({text}, '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST(trim({text}) AS BIGINT) END"
    return f"COALESCE({whole}, TRY_CAST(trunc({parsed}) AS BIGINT), 0)"


def margin_sql(model: Scorecard = DEFAULT_SCORECARD) -> str:
    parts = [f"CAST({model.intercept!r} AS DOUBLE)"]
    for t in model.terms:
        if t.equals is not None:
            value = f"CAST(CAST({t.feature} AS BIGINT) = {t.equals} AS DOUBLE)"
        else:
            value = f"CAST({t.feature} AS DOUBLE)"
        parts.append(f"CAST({t.weight!r} AS DOUBLE) * ({value} - CAST({t.center!r} AS DOUBLE))")
    return "(" + " + ".join(parts) + ")"


def sigmoid_sql(x: str) -> str:
    return f"(1.0 / (1.0 + exp(-({x}))))"


def iso_sql(ts: str) -> str:
    return (
        f"CASE WHEN strftime({ts}, '%f') = '000000' THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') END"
    )


def ts_text_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def test_side_sql(key: str = "event_id") -> str:
    return f"({key} IN (SELECT event_id FROM test_ids))"


BASE_CTES = f"""
WITH clinical_raw AS (
  SELECT
    'evt_' || CAST(event_id AS VARCHAR) AS event_id,
    {iso_sql('ts')} AS "timestamp",
    'prov_' || CAST(10 + user_id % 90 AS VARCHAR) AS provider_id,
    'Patient ' || CAST(user_id AS VARCHAR) AS patient_name,
    CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'redacted'
         ELSE lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0')
              || '-' || lpad(CAST((event_id * 7) % 10000 AS VARCHAR), 4, '0') END AS patient_ssn,
    {pick_sql('event_id % 9', MEDICATION_TEXTS)} AS medication_prescribed,
    {pick_sql('event_id % 8', NOTE_TEXTS)} AS clinical_notes,
    CAST(110 + (event_id * 37) % 51 AS INTEGER) AS systolic_bp,
    CAST(70 + (event_id * 17) % 31 AS INTEGER) AS diastolic_bp,
    ts
  FROM events
),
silver AS (
  SELECT event_id, "timestamp", provider_id,
    regexp_replace(patient_ssn, {lit(SSN_PATTERN)}, {lit(SSN_MASK)}, 'g') AS patient_ssn,
    medication_prescribed, clinical_notes, systolic_bp, diastolic_bp, ts AS ingested_at
  FROM clinical_raw
),
gold AS (
  SELECT *,
    {code_sql('medication_prescribed', RXNORM_RULES, RXNORM_DEFAULT)} AS rxnorm_id,
    {code_sql('clinical_notes', SNOMED_RULES, SNOMED_DEFAULT)} AS snomed_code,
    ingested_at AS enriched_at
  FROM silver
),
feats AS (
  SELECT event_id,
    {coerce_sql('rxnorm_id')} AS rxnorm_id,
    {coerce_sql('snomed_code')} AS snomed_code,
    {coerce_sql('systolic_bp')} AS systolic_bp,
    {coerce_sql('diastolic_bp')} AS diastolic_bp,
    CAST(systolic_bp > {LABEL_THRESHOLD} AS INTEGER) AS label
  FROM gold
),
test_ids AS (
  SELECT event_id FROM (
    SELECT event_id, count(*) OVER () AS n,
      row_number() OVER (ORDER BY substr(md5('{SPLIT_SEED}:' || event_id), 1, {HASH_DIGITS}), event_id) AS place
    FROM feats)
  WHERE place <= ceil({TEST_FRACTION} * n)
),
alerts_base AS (
  SELECT event_id,
    COALESCE(CAST(systolic_bp AS BIGINT), 0) AS systolic_bp,
    COALESCE(CAST(diastolic_bp AS BIGINT), 0) AS diastolic_bp,
    {coerce_sql('rxnorm_id')} AS rxnorm_id,
    {coerce_sql('snomed_code')} AS snomed_code,
    ingested_at AS evaluated_at
  FROM gold
),
alerts AS (
  SELECT event_id, systolic_bp, diastolic_bp, rxnorm_id, snomed_code,
    CASE WHEN p > 0.5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS adverse_event_risk_score,
    p AS risk_probability, evaluated_at
  FROM (SELECT *, {sigmoid_sql(margin_sql())} AS p FROM alerts_base)
)
"""


def with_base(select_sql: str) -> str:
    return BASE_CTES + select_sql
