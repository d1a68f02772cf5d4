"""Queries over features, labels, split, contracts, scoring, metrics and audit."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clinsignal.functions.numeric import percent_text
from clinsignal.operators import attribution, contract
from clinsignal.operators.auc import roc_auc
from clinsignal.operators.features import (
    add_label,
    align_features,
    pack_features,
    select_features,
    split,
    training_frame,
)
from clinsignal.operators.ingest import parse_payload
from clinsignal.operators.ensemble import Node, TreeEnsemble
from clinsignal.operators.ledger import load_model, record_run
from clinsignal.operators.newton import Settings, train_newton
from clinsignal.operators.scoring import (
    DEFAULT_SCORECARD,
    GBT_PARAMS,
    NumpyScorecard,
    Scorecard,
    log_odds,
    score,
    score_python_model,
    train_gbt,
    triage,
)
from clinsignal.plans import layers as P
from clinsignal.plans.registry import query
from clinsignal.plans.sql_base import margin_sql, sigmoid_sql, test_side_sql, with_base
from clinsignal.plans.sql_trees import applied_ctes, explained_ctes, newton_ctes
from clinsignal.schemas import FEATURE_CONTRACT_V4, FEATURES
from clinsignal.session import scratch_path
from clinsignal.sources.tables import literal_vector

FEAT_COLS = ", ".join(FEATURES)
ROUND = 9

# Registered queries train the model with its full settings.
QUERY_GBT = {k: GBT_PARAMS[k] for k in ("max_depth", "max_iter")}


def _r(c):
    return F.round(F.col(c) if isinstance(c, str) else c, ROUND)


# -- feature tables ----------------------------------------------------------------


@query("feature_select", with_base(f"SELECT {FEAT_COLS} FROM gold"))
def feature_select_q(spark: SparkSession, sf_dir: str):
    selected, _ = select_features(P.gold_table(spark, sf_dir))
    return selected


@query("coerce_features", with_base(f"SELECT event_id, {FEAT_COLS} FROM feats"))
def coerce_features_q(spark: SparkSession, sf_dir: str):
    return P.features(spark, sf_dir).drop("label")


@query("label_threshold", with_base("SELECT event_id, systolic_bp, label FROM feats"))
def label_threshold_q(spark: SparkSession, sf_dir: str):
    return P.features(spark, sf_dir).select("event_id", "systolic_bp", "label")


@query(
    "label_existing",
    with_base(
        "SELECT event_id, snomed_code, COALESCE(CASE WHEN snomed_code = 709044004 THEN 1 WHEN snomed_code = 0 "
        "THEN NULL ELSE 0 END, 0) AS label FROM feats"
    ),
)
def label_existing_q(spark: SparkSession, sf_dir: str):
    frame, _ = training_frame(P.labelled_gold(spark, sf_dir))
    return frame.select("event_id", "snomed_code", "label")


@query(
    "label_random",
    with_base("SELECT event_id, CAST(md5('42:' || event_id) < '8' AS INTEGER) AS label FROM gold"),
)
def label_random_q(spark: SparkSession, sf_dir: str):
    """No target and no threshold column: the seeded hash coin."""
    return add_label(P.gold_table(spark, sf_dir).select("event_id")).select("event_id", "label")


@query(
    "align_features",
    with_base(
        "SELECT event_id, CAST(0 AS BIGINT) AS rxnorm_id, CAST(0 AS BIGINT) AS snomed_code, "
        "CAST(systolic_bp AS BIGINT) AS systolic_bp, CAST(diastolic_bp AS BIGINT) AS diastolic_bp FROM clinical_raw"
    ),
)
def align_features_q(spark: SparkSession, sf_dir: str):
    """Serving alignment of the raw payload (codes absent -> 0, BPs double -> int64)."""
    return align_features(parse_payload(P.raw_topic(spark, sf_dir)))


@query(
    "pack_features",
    with_base(
        "SELECT event_id, to_json({'rxnorm_id': rxnorm_id, 'snomed_code': snomed_code, "
        "'systolic_bp': systolic_bp, 'diastolic_bp': diastolic_bp})::VARCHAR AS features_json FROM feats"
    ),
)
def pack_features_q(spark: SparkSession, sf_dir: str):
    f = P.features(spark, sf_dir)
    return f.select("event_id", F.to_json(pack_features()).alias("features_json"))


@query(
    "indicator_features",
    with_base(
        "SELECT event_id, CAST(systolic_bp AS DOUBLE) AS systolic_bp, CAST(diastolic_bp AS DOUBLE) AS diastolic_bp, "
        "CAST(rxnorm_id = '17767' AS INTEGER) AS rxnorm_17767_amlodipine, "
        "CAST(snomed_code = '709044004' AS INTEGER) AS snomed_709044004_kidney_injury FROM gold"
    ),
)
def indicator_features_q(spark: SparkSession, sf_dir: str):
    return P.v1_features(spark, sf_dir).drop("label")


# -- split / contract ----------------------------------------------------------------


@query("split_train", with_base(f"SELECT event_id, {FEAT_COLS}, label FROM feats WHERE NOT {test_side_sql()}"))
def split_train_q(spark: SparkSession, sf_dir: str):
    train, _ = split(P.features(spark, sf_dir))
    return train


@query("split_test", with_base(f"SELECT event_id, {FEAT_COLS}, label FROM feats WHERE {test_side_sql()}"))
def split_test_q(spark: SparkSession, sf_dir: str):
    _, test = split(P.features(spark, sf_dir))
    return test


def _profile_sql() -> str:
    parts = []
    for i, f in enumerate(FEATURES):
        parts.append(
            f"SELECT '{f}' AS field, CAST({i} AS INTEGER) AS position, 'bigint' AS dtype, "
            f"CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) - count({f}) AS BIGINT) AS n_nulls, "
            f"CAST(min({f}) AS DOUBLE) AS min_value, CAST(max({f}) AS DOUBLE) AS max_value "
            f"FROM feats WHERE NOT {test_side_sql()}"
        )
    return with_base(" UNION ALL ".join(parts))


@query("contract_schema", _profile_sql())
def contract_schema_q(spark: SparkSession, sf_dir: str):
    """Contract inferred from the training side: field types plus observed ranges."""
    train, _ = split(P.features(spark, sf_dir))
    return contract.contract_profile(train, FEATURES)


@query(
    "contract_example",
    with_base(f"SELECT event_id, {FEAT_COLS}, label FROM feats WHERE NOT {test_side_sql()} ORDER BY event_id LIMIT 3"),
)
def contract_example_q(spark: SparkSession, sf_dir: str):
    train, _ = split(P.features(spark, sf_dir))
    return train.orderBy("event_id").limit(3)


@query("contract_enforce", with_base(f"SELECT {FEAT_COLS} FROM feats"))
def contract_enforce_q(spark: SparkSession, sf_dir: str):
    """Columns arrive in another order with extras; the contract reorders and projects."""
    f = P.features(spark, sf_dir).select("label", "diastolic_bp", "event_id", "systolic_bp", "snomed_code", "rxnorm_id")
    return contract.enforce(f, FEATURE_CONTRACT_V4)


# -- scorecard scoring, metrics, audit ------------------------------------------------


@query(
    "sigmoid_margin",
    with_base(
        f"SELECT event_id, round({margin_sql()}, {ROUND}) AS margin, "
        f"round({sigmoid_sql(margin_sql())}, {ROUND}) AS risk_probability FROM feats"
    ),
)
def sigmoid_margin_q(spark: SparkSession, sf_dir: str):
    scored = attribution.linear_attribution(P.features(spark, sf_dir), DEFAULT_SCORECARD)
    return scored.select("event_id", _r("margin").alias("margin"), _r("risk_probability").alias("risk_probability"))


@query(
    "contract_serve",
    with_base(
        f"SELECT event_id, {FEAT_COLS}, round({sigmoid_sql(margin_sql())}, {ROUND}) AS risk_probability, "
        f"CAST({sigmoid_sql(margin_sql())} > 0.5 AS DOUBLE) AS adverse_event_risk_score FROM feats"
    ),
)
def contract_serve_q(spark: SparkSession, sf_dir: str):
    """Rows in another order, with narrower types and an extra column, scored
    after the contract read back from the ledger has put them right."""
    root = scratch_path(spark, "registry")
    run = record_run(
        spark, root, "scorecard", {"intercept": DEFAULT_SCORECARD.intercept},
        {"terms": len(DEFAULT_SCORECARD.terms)}, contract.contract_json(FEATURE_CONTRACT_V4),
    ).first()
    sent = P.features(spark, sf_dir).select(
        "label", F.col("diastolic_bp").cast("int").alias("diastolic_bp"), "event_id",
        F.col("systolic_bp").cast("int").alias("systolic_bp"), "snomed_code", "rxnorm_id",
    )
    served = contract.enforce_inputs(sent, contract.input_contract(run["contract"]))
    return score(served, DEFAULT_SCORECARD).select(
        "event_id", *FEATURES, _r("risk_probability").alias("risk_probability"), "adverse_event_risk_score"
    )


def _auc_ctes(source: str) -> str:
    """CTEs s (score, label) -> g (counts per distinct score) -> r (negatives below)."""
    return f"""
, s AS ({source}),
g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s WHERE score IS NOT NULL GROUP BY score),
r AS (SELECT pos, neg, COALESCE(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)"""


_AUC_VALUE = (
    "round(CAST(sum(pos * (below + neg / 2.0)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), "
    f"{ROUND})"
)


def _auc_sql(source: str) -> str:
    return _auc_ctes(source) + f"""
SELECT {_AUC_VALUE} AS roc_auc, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM r"""


# AUC ranks by the log-odds margin: the same ranking as the probability in
# exact arithmetic, without ties that the sigmoid's rounding introduces.
_TEST_SCORES = f"SELECT {margin_sql()} AS score, label FROM feats WHERE {test_side_sql()}"

# The fallback label is ``systolic_bp > 140`` and systolic pressure is itself a
# feature (label leakage); the check scores without the label-defining term.
NO_LEAK_SCORECARD = Scorecard(
    terms=tuple(t for t in DEFAULT_SCORECARD.terms if t.feature != "systolic_bp"),
    intercept=DEFAULT_SCORECARD.intercept,
    name="scorecard_without_label_feature",
)
_TEST_SCORES_NO_LEAK = f"SELECT {margin_sql(NO_LEAK_SCORECARD)} AS score, label FROM feats WHERE {test_side_sql()}"


@query("roc_auc", with_base(_auc_sql(_TEST_SCORES)))
def roc_auc_q(spark: SparkSession, sf_dir: str):
    """Exact AUC of the scorecard on the test side (label = systolic > 140)."""
    _, test = split(P.features(spark, sf_dir))
    scored = log_odds(test, DEFAULT_SCORECARD)
    auc = roc_auc(scored, "margin", "label")
    return auc.select(_r("roc_auc").alias("roc_auc"), "n_pos", "n_neg")


@query("roc_auc_without_label_feature", with_base(_auc_sql(_TEST_SCORES_NO_LEAK)))
def roc_auc_no_leak_q(spark: SparkSession, sf_dir: str):
    """Leakage check: AUC of the scorecard without the feature that defines the label."""
    _, test = split(P.features(spark, sf_dir))
    auc = roc_auc(log_odds(test, NO_LEAK_SCORECARD), "margin", "label")
    return auc.select(_r("roc_auc").alias("roc_auc"), "n_pos", "n_neg")


def _phi_sql() -> str:
    cols = []
    for t in DEFAULT_SCORECARD.terms:
        if t.equals is not None:
            value = f"CAST(CAST({t.feature} AS BIGINT) = {t.equals} AS DOUBLE)"
        else:
            value = f"CAST({t.feature} AS DOUBLE)"
        cols.append(f"round(CAST({t.weight!r} AS DOUBLE) * ({value} - CAST({t.center!r} AS DOUBLE)), {ROUND}) AS phi_{t.feature}")
    return ", ".join(cols)


@query(
    "audit_delta_p",
    with_base(
        f"SELECT event_id, {_phi_sql()}, CAST({DEFAULT_SCORECARD.intercept!r} AS DOUBLE) AS base_value, "
        f"round({margin_sql()}, {ROUND}) AS margin, "
        f"round({sigmoid_sql(margin_sql())} - {sigmoid_sql(repr(DEFAULT_SCORECARD.intercept))}, {ROUND}) AS delta_p "
        f"FROM feats WHERE {test_side_sql()}"
    ),
)
def audit_delta_p_q(spark: SparkSession, sf_dir: str):
    """Per-feature attribution and delta-P for every test row (scorecard)."""
    _, test = split(P.features(spark, sf_dir))
    a = attribution.linear_attribution(test, DEFAULT_SCORECARD)
    phis = [f"phi_{t.feature}" for t in DEFAULT_SCORECARD.terms]
    return a.select(
        "event_id",
        *[_r(c).alias(c) for c in phis],
        "base_value",
        _r("margin").alias("margin"),
        _r("delta_p").alias("delta_p"),
    )


_RUN_LEDGER_SQL = with_base(
    _auc_ctes(_TEST_SCORES)
    + f""",
tr AS (SELECT CAST(count(*) AS DOUBLE) AS n_train, round(avg(label), {ROUND}) AS positive_rate FROM feats WHERE NOT {test_side_sql()})
SELECT 'scorecard' AS name, CAST(1 AS INTEGER) AS version, {_AUC_VALUE} AS roc_auc,
  (SELECT n_train FROM tr) AS n_train, CAST(sum(pos) + sum(neg) AS DOUBLE) AS n_test,
  (SELECT positive_rate FROM tr) AS positive_rate
FROM r"""
)


@query("run_ledger", _RUN_LEDGER_SQL)
def run_ledger_q(spark: SparkSession, sf_dir: str):
    """Evaluate the scorecard, append the run to a fresh ledger, read the row back."""
    train, test = split(P.features(spark, sf_dir))
    auc = roc_auc(log_odds(test, DEFAULT_SCORECARD), "margin", "label")
    train_stats = train.agg(F.count(F.lit(1)).alias("n_train"), F.avg("label").alias("positive_rate"))
    # train statistics enter as scalar subqueries of the one-row AUC frame
    metrics = auc.select(
        F.col("roc_auc"),
        (F.col("n_pos") + F.col("n_neg")).alias("n_test"),
        train_stats.select("n_train").scalar().alias("n_train"),
        train_stats.select("positive_rate").scalar().alias("positive_rate"),
    )
    root = scratch_path(spark, "registry")
    params = {t.feature: f"{t.weight}*(x-{t.center})" for t in DEFAULT_SCORECARD.terms}
    params["intercept"] = DEFAULT_SCORECARD.intercept
    row = record_run(spark, root, "scorecard", params, metrics, contract.contract_json(FEATURE_CONTRACT_V4))
    m = F.col("metrics")
    return row.select(
        "name",
        "version",
        _r(m["roc_auc"]).alias("roc_auc"),
        m["n_train"].alias("n_train"),
        m["n_test"].alias("n_test"),
        _r(m["positive_rate"]).alias("positive_rate"),
    )


@query(
    "score_python_model",
    with_base(
        f"SELECT event_id, round({sigmoid_sql(margin_sql())}, {ROUND}) AS risk_probability, "
        f"CASE WHEN {sigmoid_sql(margin_sql())} > 0.5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END "
        "AS adverse_event_risk_score FROM feats"
    ),
)
def score_python_model_q(spark: SparkSession, sf_dir: str):
    """A Python-only model applied through an Arrow-batched pandas UDF (here a
    NumPy form of the scorecard, so the result is SQL-checkable)."""
    scored = score_python_model(P.features(spark, sf_dir), NumpyScorecard(DEFAULT_SCORECARD))
    return scored.select("event_id", _r("risk_probability").alias("risk_probability"), "adverse_event_risk_score")


# -- gradient-boosted trees (rows-only: scores differ by engine) ----------------------

_MODELS: dict[tuple, object] = {}


def _gbt_for(spark: SparkSession, sf_dir: str):
    key = P.layer_key(spark, sf_dir, "gbt")
    with P.BUILD_LOCK:
        if key not in _MODELS:
            train, _ = split(P.features(spark, sf_dir))
            _MODELS[key] = (train_gbt(train, FEATURES, **QUERY_GBT), FEATURES)
    return _MODELS[key]


# The label is a threshold on one of the features, so the test side is ranked perfectly.
@query(
    "train_gbt",
    "SELECT 'gbt_signal' AS name, CAST(1 AS INTEGER) AS version, CAST(1 AS DOUBLE) AS roc_auc, TRUE AS saved",
)
def train_gbt_q(spark: SparkSession, sf_dir: str):
    """Fit boosted trees on the train side, evaluate on test, register in a ledger."""
    model, feats = _gbt_for(spark, sf_dir)
    _, test = split(P.features(spark, sf_dir))
    auc = roc_auc(log_odds(test, model), "margin", "label")
    root = scratch_path(spark, "registry")
    params = {"max_depth": QUERY_GBT["max_depth"], "max_iter": QUERY_GBT["max_iter"], "step_size": 0.1, "seed": 42}
    row = record_run(spark, root, "gbt_signal", params, auc, contract.contract_json(FEATURE_CONTRACT_V4), model)
    return row.select(
        "name", "version", F.round(F.col("metrics")["roc_auc"], 9).alias("roc_auc"), F.col("path").isNotNull().alias("saved")
    )


# Decisions of a model that found the label's threshold are the labels.
@query(
    "score_batch",
    with_base(
        "SELECT event_id, CAST(label AS DOUBLE) AS adverse_event_risk_score, label = 1 AS likely "
        f"FROM feats WHERE {test_side_sql()}"
    ),
)
def score_batch_q(spark: SparkSession, sf_dir: str):
    model, _ = _gbt_for(spark, sf_dir)
    _, test = split(P.features(spark, sf_dir))
    return score(test, model).select(
        "event_id", "adverse_event_risk_score", (F.col("risk_probability") > 0.5).alias("likely")
    )


# A fixed two-tree model (our own): a path that meets a feature twice, unequal
# depths and covers; features are numbered as in FEATURES.
_RX, _SNOMED, _SYS, _DIA = (FEATURES.index(f) for f in ("rxnorm_id", "snomed_code", "systolic_bp", "diastolic_bp"))
LITERAL_TREES = TreeEnsemble(
    [
        Node(0, 1, _SYS, 140.5, 2, 3, cover=1000),
        Node(0, 2, _DIA, 85.0, 4, 5, cover=620),
        Node(0, 3, _SNOMED, 709044004.0, 6, 7, cover=380),
        Node(0, 4, value=-0.9, cover=400),
        Node(0, 5, value=-0.25, cover=220),
        Node(0, 6, value=0.4, cover=300),
        Node(0, 7, value=1.1, cover=80),
        Node(1, 1, _RX, 17767.0, 2, 3, cover=1000),
        Node(1, 2, _SYS, 120.0, 4, 5, cover=350),
        Node(1, 3, value=0.15, cover=650),
        Node(1, 4, value=-0.3, cover=100),
        Node(1, 5, _SYS, 150.0, 6, 7, cover=250),
        Node(1, 6, value=0.05, cover=200),
        Node(1, 7, value=0.6, cover=50),
    ],
    FEATURES,
    base=-0.125,
)


def _audit_sql() -> str:
    phis = [f"phi_{i}" for i in range(len(FEATURES))]
    named = ", ".join(f"round({p}, {ROUND}) AS phi_{f}" for p, f in zip(phis, FEATURES))
    margin = f"(base_value + {' + '.join(phis)})"
    source = f"SELECT event_id, {FEAT_COLS} FROM feats WHERE {test_side_sql()}"
    return with_base(
        explained_ctes(source, LITERAL_TREES)
        + f" SELECT event_id, {named}, round(base_value, {ROUND}) AS base_value, round({margin}, {ROUND}) AS margin, "
        f"round({sigmoid_sql(margin)}, {ROUND}) AS risk_probability, "
        f"round({sigmoid_sql(margin)} - {sigmoid_sql('0.0')}, {ROUND}) AS delta_p FROM explained"
    ).replace("WITH clinical_raw", "WITH RECURSIVE clinical_raw", 1)


@query("audit_attribution", _audit_sql())
def audit_attribution_q(spark: SparkSession, sf_dir: str):
    """Exact path-dependent Tree SHAP + delta-P of the fixed two-tree model for every test row."""
    _, test = split(P.features(spark, sf_dir))
    told = attribution.tree_attribution(test, LITERAL_TREES, FEATURES)
    numbers = [*[f"phi_{f}" for f in FEATURES], "base_value", "margin", "risk_probability", "delta_p"]
    return told.select("event_id", *[_r(c).alias(c) for c in numbers])


@query("audit_attribution_trained")
def audit_attribution_trained_q(spark: SparkSession, sf_dir: str):
    """Exact path-dependent Tree SHAP + delta-P of the trained model for every test row."""
    model, feats = _gbt_for(spark, sf_dir)
    _, test = split(P.features(spark, sf_dir))
    return attribution.tree_attribution(test, model, feats).select(
        "event_id", *[f"phi_{f}" for f in feats], "base_value", "margin", "risk_probability", "delta_p"
    )


# -- second-order trees ------------------------------------------------------------

# Without the pressure that defines the label, so that every level has real splits.
NEWTON_FEATURES = ["rxnorm_id", "snomed_code", "diastolic_bp"]
SHORT = Settings(max_depth=2, rounds=1)
TRIAGE = Settings(max_depth=2, rounds=3)


def _newton_nodes_sql() -> str:
    source = f"SELECT event_id, {FEAT_COLS}, label FROM feats WHERE NOT {test_side_sql()}"
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(NEWTON_FEATURES)) + " END"
    return with_base(
        newton_ctes(source, NEWTON_FEATURES, SHORT)
        + f" SELECT CAST(node AS INTEGER) AS node, {names} AS feature, threshold, round(gain, {ROUND}) AS gain, "
        "CAST(NULL AS DOUBLE) AS value, cover FROM found UNION ALL "
        f"SELECT CAST(node AS INTEGER), NULL, NULL, NULL, round(value, {ROUND}), cover FROM ended"
    )


@query("train_newton_trees", _newton_nodes_sql())
def train_newton_trees_q(spark: SparkSession, sf_dir: str):
    """One second-order round of depth 2 on the whole train side: splits, gains, leaf values."""
    train, _ = split(P.features(spark, sf_dir))
    nodes = train_newton(train, NEWTON_FEATURES, settings=SHORT).frame(spark)
    names = F.array(*[F.lit(f) for f in NEWTON_FEATURES])
    leaf = F.col("feature").isNull()
    return nodes.select(
        "node",
        F.get(names, F.col("feature")).alias("feature"),
        "threshold",
        _r("gain").alias("gain"),
        F.when(leaf, _r("value")).alias("value"),
        "cover",
    )


@query(
    "score_newton_trees",
    with_base(
        newton_ctes(f"SELECT event_id, {FEAT_COLS}, label FROM feats WHERE NOT {test_side_sql()}", NEWTON_FEATURES, TRIAGE)
        + applied_ctes(f"SELECT * FROM feats WHERE {test_side_sql()}", NEWTON_FEATURES, TRIAGE)
        + f" SELECT event_id, round(margin, {ROUND}) AS margin, round({sigmoid_sql('margin')}, {ROUND}) AS risk_probability, "
        f"CAST({sigmoid_sql('margin')} > 0.5 AS DOUBLE) AS adverse_event_risk_score FROM scored"
    ),
)
def score_newton_trees_q(spark: SparkSession, sf_dir: str):
    """Probabilities of three second-order rounds for every test row."""
    train, test = split(P.features(spark, sf_dir))
    model = train_newton(train, NEWTON_FEATURES, settings=TRIAGE)
    scored = score(log_odds(test, model), model)
    return scored.select(
        "event_id", _r("margin").alias("margin"), _r("risk_probability").alias("risk_probability"), "adverse_event_risk_score"
    )


_V1_SQL = (
    "SELECT event_id, CAST(systolic_bp AS DOUBLE) AS systolic_bp, CAST(diastolic_bp AS DOUBLE) AS diastolic_bp, "
    "CAST(rxnorm_id = '17767' AS INTEGER) AS rxnorm_17767_amlodipine, "
    "CAST(snomed_code = '709044004' AS INTEGER) AS snomed_709044004_kidney_injury, "
    "CAST(systolic_bp > 140 AS INTEGER) AS label FROM gold"
)
V1_FEATURES = ["systolic_bp", "diastolic_bp", "rxnorm_17767_amlodipine", "snomed_709044004_kidney_injury"]
_LITERAL_SQL = (
    "SELECT 'inline' AS event_id, CAST(145.0 AS DOUBLE) AS systolic_bp, CAST(92.0 AS DOUBLE) AS diastolic_bp, "
    "1 AS rxnorm_17767_amlodipine, 1 AS snomed_709044004_kidney_injury, 0 AS label"
)


@query(
    "score_literal",
    with_base(
        newton_ctes(_V1_SQL, V1_FEATURES, TRIAGE)
        + applied_ctes(f"{_V1_SQL} UNION ALL {_LITERAL_SQL}", V1_FEATURES, TRIAGE)
        + f" SELECT event_id, {', '.join(V1_FEATURES)}, round({sigmoid_sql('margin')}, {ROUND}) AS risk_probability, "
        f"printf('%.2f%%', round({sigmoid_sql('margin')} * 100, 2)) AS risk_pct, "
        f"CASE WHEN {sigmoid_sql('margin')} > 0.5 THEN 'ALERT' ELSE 'NORMAL' END AS status FROM scored"
    ),
)
def score_literal_q(spark: SparkSession, sf_dir: str):
    """Triage of the whole v1 table and the inline vector by a registered model, loaded by version."""
    frame = P.v1_features(spark, sf_dir)
    root = scratch_path(spark, "registry")
    for rounds in (1, TRIAGE.rounds):  # versions 1 and 2
        settings = Settings(max_depth=TRIAGE.max_depth, rounds=rounds)
        model = train_newton(frame, V1_FEATURES, settings=settings)
        record_run(spark, root, "triage", {"rounds": rounds}, {"trees": len(model.trees)}, model=model)
    inline = literal_vector(spark).withColumn("event_id", F.lit("inline"))
    rows = frame.select("event_id", *V1_FEATURES).unionByName(inline.select("event_id", *V1_FEATURES))
    scored = score(rows, load_model(spark, root, "triage", version=2))
    return triage(scored, alerts_only=False).select(
        "event_id",
        *V1_FEATURES,
        _r("risk_probability").alias("risk_probability"),
        percent_text(F.col("risk_probability") * 100, 2).alias("risk_pct"),
        "status",
    )
