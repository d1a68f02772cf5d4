"""Model contracts: infer from data, profile, store with a model, enforce at serve time."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinsignal.functions.numeric import NUMERIC_TEXT, coerce_bigint
from clinsignal.schemas import FEATURE_CONTRACT_V4, FEATURES

OUTPUTS = ["risk_probability", "adverse_event_risk_score"]


def infer_contract(df: DataFrame, features: list[str] = FEATURES) -> T.StructType:
    """The contract is the (driver-side) schema of the feature projection."""
    return df.select(*features).schema


def contract_json(schema: T.StructType) -> str:
    return json.dumps(schema.jsonValue(), sort_keys=True)


def contract_profile(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """One row per contract field: position, type, rows, nulls, min and max.

    A single aggregation pass (partial aggregation map-side) then an unpivot of
    its one result row.
    """
    schema = df.select(*features).schema
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for f in features:
        aggs += [
            F.count(F.when(F.col(f).isNull(), 1)).alias(f"{f}__nulls"),
            F.min(F.col(f).cast("double")).alias(f"{f}__min"),
            F.max(F.col(f).cast("double")).alias(f"{f}__max"),
        ]
    stats = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(f).alias("field"),
            F.lit(i).alias("position"),
            F.lit(schema[f].dataType.simpleString()).alias("dtype"),
            F.col("n_rows").cast("bigint").alias("n_rows"),
            F.col(f"{f}__nulls").cast("bigint").alias("n_nulls"),
            F.col(f"{f}__min").alias("min_value"),
            F.col(f"{f}__max").alias("max_value"),
        )
        for i, f in enumerate(features)
    ]
    return stats.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def signature_json(scored: DataFrame, features: list[str], key: str = "event_id", examples: int = 3) -> str:
    """Input schema, output schema and the input's first rows by ``key`` as JSON."""
    first = scored.orderBy(key).limit(examples).select(*features)
    return json.dumps(
        {
            "inputs": scored.select(*features).schema.jsonValue(),
            "outputs": scored.select(*OUTPUTS).schema.jsonValue(),
            "example": [json.loads(row) for row in first.toJSON().collect()],
        },
        sort_keys=True,
    )


def input_contract(text: str) -> T.StructType:
    """The input half of a stored contract (a signature, or an input schema alone)."""
    stored = json.loads(text)
    return T.StructType.fromJson(stored.get("inputs", stored))


def enforce_inputs(df: DataFrame, contract: T.StructType) -> DataFrame:
    """All columns, those of the contract last, in its order and types.

    Raises when one is missing or its type cannot be cast up; nulls are allowed,
    the models take them.
    """
    others = [f for f in df.schema.fields if f.name not in contract.names]
    wanted = T.StructType(others + [T.StructField(f.name, f.dataType, True) for f in contract.fields])
    return df.select(*wanted.names).to(wanted)  # the selection raises where ``to`` would add nulls


def enforce(df: DataFrame, contract: T.StructType = FEATURE_CONTRACT_V4) -> DataFrame:
    """Reorder / project / up-cast to the contract; raises on missing columns and incompatible types."""
    return df.select(*contract.names).to(contract)


# -- row-level checks -----------------------------------------------------------------


@dataclass(frozen=True)
class FieldRule:
    """What a row's text of a field must be: present, a whole number, in a range."""

    name: str
    low: int | None = None
    high: int | None = None
    required: bool = True


# Physiologically possible pressures; codes may be missing (they are derived then).
SERVING_RULES = (
    FieldRule("systolic_bp", 40, 300),
    FieldRule("diastolic_bp", 20, 200),
    FieldRule("rxnorm_id", 0, required=False),
    FieldRule("snomed_code", 0, required=False),
)
REASONS = ("missing", "not_a_number", "not_whole", "out_of_range")
PAYLOAD = "payload"  # field name of a payload that is no JSON object
VIOLATIONS = "array<struct<field:string,reason:string>>"


def broken_rule(rule: FieldRule) -> Column:
    """The first reason why a row's field breaks its rule; null if it does not."""
    text = F.col(rule.name).cast("string")
    number = F.regexp_replace(text, r"^\s+|\s+$", "").try_cast("decimal(38,9)")
    whole = coerce_bigint(rule.name)
    outside = F.lit(False)
    if rule.low is not None:
        outside = outside | (whole < rule.low)
    if rule.high is not None:
        outside = outside | (whole > rule.high)
    missing = F.when(text.isNull(), F.lit("missing" if rule.required else None))
    return (
        missing.when(~text.rlike(NUMERIC_TEXT), F.lit("not_a_number"))
        .when(number.isNull(), F.lit("out_of_range"))
        .when(number != F.floor(number), F.lit("not_whole"))
        .when(outside, F.lit("out_of_range"))
    )


def violations(rules: tuple[FieldRule, ...] = SERVING_RULES, malformed: Column | None = None) -> Column:
    """All broken rules of a row, in the order of the rules; of a malformed payload only that."""
    found = [F.struct(F.lit(r.name).alias("field"), broken_rule(r).alias("reason")) for r in rules]
    broken = F.filter(F.array(*found), lambda v: v["reason"].isNotNull()).cast(VIOLATIONS)
    if malformed is None:
        return broken
    alone = F.array(F.struct(F.lit(PAYLOAD).alias("field"), F.lit("malformed").alias("reason"))).cast(VIOLATIONS)
    return F.when(malformed, alone).otherwise(broken)


def observed(checked: DataFrame, name: str, rules: tuple[FieldRule, ...] = SERVING_RULES) -> DataFrame:
    """The frame with its rows and broken rules counted as it is computed.

    One metric per (field, reason), named ``field__reason``: a streaming query
    reports them with the progress of each micro-batch, at no extra pass.
    """
    pairs = [(PAYLOAD, "malformed"), *[(r.name, reason) for r in rules for reason in REASONS]]

    def times(field: str, reason: str) -> Column:
        hit = F.exists("violations", lambda v: (v["field"] == field) & (v["reason"] == reason))
        return F.count(F.when(hit, 1)).alias(f"{field}__{reason}")

    broken = [times(f, r) for f, r in pairs]
    rejected = F.count(F.when(F.size("violations") > 0, 1)).alias("n_rejected")
    return checked.observe(name, F.count(F.lit(1)).alias("n_rows"), rejected, *broken)
