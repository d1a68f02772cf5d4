"""Clinical test input derived from the given ``events`` table.

The source pipeline ships no data; its raw record has 9 fields.  ``clinical_raw``
fills them deterministically from ``events`` (one clinical event per event row,
nothing dropped), with the odd cases a real feed has: null / empty / upper-case
/ padded / brand-name / unknown medications, null notes, null and non-SSN
identifiers.  The same derivation is written in SQL in ``plans.sql_base``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsignal.functions.text import iso_text

# Medication texts (by event_id % 9) and note texts (by event_id % 8) of the
# fixture.
MEDICATION_TEXTS = [
    "Zestril 10",
    "simvastatin",
    "\t METFORMIN 500mg\n",
    "Motrin",
    "NORVASC",
    "Warfarin",
    "",
    None,
    "amlodipin",
]
NOTE_TEXTS = [
    "Myalgia in both thighs since Tuesday; walks with help.",
    "Urticaria on the forearm, fading by evening.",
    "Vertigo when standing up, gone after a minute.",
    "Nightly cough with lightheadedness, sleeps badly.",
    "Values for creatinine unchanged, none flagged.",
    "\tRenal scan shows FAILURE on the left, rash on the back.\n",
    None,
    "lightheaded",
]


def _pick(key: Column, values: list[str | None]) -> Column:
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        expr = F.when(key == i, lit) if expr is None else expr.when(key == i, lit)
    return expr


def _zero_pad(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def clinical_raw(events: DataFrame) -> DataFrame:
    """events -> 9-field raw clinical events plus the record time ``ts``."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    ssn = (
        F.when(eid % 29 == 0, F.lit(None).cast("string"))
        .when(eid % 31 == 0, F.lit("redacted"))
        .otherwise(
            F.concat(_zero_pad(uid % 1000, 3), F.lit("-"), _zero_pad(eid % 100, 2), F.lit("-"), _zero_pad((eid * 7) % 10000, 4))
        )
    )
    return events.select(
        F.concat(F.lit("evt_"), eid.cast("string")).alias("event_id"),
        iso_text("ts").alias("timestamp"),
        F.concat(F.lit("prov_"), (F.lit(10) + uid % 90).cast("string")).alias("provider_id"),
        F.concat(F.lit("Patient "), uid.cast("string")).alias("patient_name"),
        ssn.alias("patient_ssn"),
        _pick(eid % 9, MEDICATION_TEXTS).alias("medication_prescribed"),
        _pick(eid % 8, NOTE_TEXTS).alias("clinical_notes"),
        (F.lit(110) + (eid * 37) % 51).cast("int").alias("systolic_bp"),
        (F.lit(70) + (eid * 17) % 31).cast("int").alias("diastolic_bp"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def faulty_payloads(clinical: DataFrame) -> DataFrame:
    """Clinical events as JSON text with what a feed gets wrong: pressures that are
    missing, words, impossible or no whole numbers, and payloads cut short."""
    number = F.substring("event_id", 5, 20).cast("bigint")
    systolic, diastolic = F.col("systolic_bp").cast("string"), F.col("diastolic_bp").cast("string")
    rows = clinical.withColumns(
        {
            "systolic_bp": F.when(number % 19 == 0, F.lit(None).cast("string"))
            .when(number % 19 == 1, F.lit("high"))
            .when(number % 19 == 2, F.concat(systolic, F.lit("0")))
            .when(number % 19 == 3, F.concat(systolic, F.lit(".5")))
            .otherwise(systolic),
            "diastolic_bp": F.when(number % 23 == 0, F.lit(None).cast("string"))
            .when(number % 23 == 1, F.lit("8O"))
            .when(number % 23 == 2, F.lit("5"))
            .when(number % 23 == 3, F.concat(F.lit(" "), diastolic, F.lit(".0")))
            .otherwise(diastolic),
        }
    )
    fields = ["event_id", "systolic_bp", "diastolic_bp", "medication_prescribed", "clinical_notes"]
    payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    cut = F.when(number % 97 == 0, F.substring(payload, 1, 24)).otherwise(payload)
    return rows.select(
        F.col("event_id").cast("binary").alias("key"), cut.cast("binary").alias("value"),
        F.lit("raw-clinical-events").alias("topic"), F.col("ts").cast("timestamp").alias("timestamp"),
    )
