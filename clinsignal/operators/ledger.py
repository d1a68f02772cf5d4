"""Run ledger and model registry on plain tables.

Each training run appends one row (params and metrics as maps, the input
contract as JSON, the saved model path) to a ledger table.  A model version
is resolved through the ledger; the model itself is a saved Spark ML pipeline or
the node table of a tree ensemble.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clinsignal.operators.contract import input_contract
from clinsignal.operators.ensemble import TreeEnsemble
from clinsignal.schemas import RUN_LEDGER_SCHEMA
from clinsignal.sources.sinks import append_alone, claim_number
from clinsignal.sources.tables import read_table_or_empty


class ModelNotFound(LookupError):
    pass


def ledger_path(root: str) -> str:
    return f"{root.rstrip('/')}/_ledger"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return read_table_or_empty(spark, ledger_path(root), RUN_LEDGER_SCHEMA).select(*RUN_LEDGER_SCHEMA.names)


def next_version(spark: SparkSession, root: str, name: str) -> int:
    row = read_ledger(spark, root).where(F.col("name") == name).agg(F.max("version").alias("v")).first()
    return 1 if row is None or row["v"] is None else int(row["v"]) + 1


def record_run(
    spark: SparkSession,
    root: str,
    name: str,
    params: dict[str, object],
    metrics: DataFrame | dict[str, float],
    contract: str | None = None,
    model: PipelineModel | TreeEnsemble | None = None,
) -> DataFrame:
    """Append one run row; returns it as a one-row DataFrame.

    ``metrics`` may be a one-row DataFrame of numeric columns (computed on the
    cluster); it is turned into the metrics map without leaving Spark.
    """
    run_id = uuid.uuid4().hex
    path = None
    if model is not None:
        # named by the run: a crash before the ledger row blocks no later run
        path = f"{root.rstrip('/')}/models/{name}/run={run_id}"
        if isinstance(model, TreeEnsemble):
            model.save(spark, path)
        else:
            model.write().save(path)
    # two runs that saw the same latest version get numbers of their own
    version = claim_number(spark, f"{root.rstrip('/')}/_claims/{name}", next_version(spark, root, name))
    if isinstance(metrics, dict):
        metrics = spark.createDataFrame([tuple(float(v) for v in metrics.values())], list(metrics))
    metric_map = F.create_map(*[x for c in metrics.columns for x in (F.lit(c), F.col(c).cast("double"))])
    param_map = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))])
    row = metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(name).alias("name"),
        F.lit(version).cast("int").alias("version"),
        F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp").alias("started_at"),
        param_map.alias("params"),
        metric_map.alias("metrics"),
        F.lit(contract).cast("string").alias("contract"),
        F.lit(path).cast("string").alias("path"),
    ).to(RUN_LEDGER_SCHEMA)
    append_alone(row, ledger_path(root))
    return read_ledger(spark, root).where((F.col("name") == name) & (F.col("version") == version))


def _registered(spark: SparkSession, root: str, name: str, version: int | None):
    """Path and contract of a registered version (default: the latest)."""
    runs = read_ledger(spark, root).where((F.col("name") == name) & F.col("path").isNotNull())
    if version is not None:
        runs = runs.where(F.col("version") == version)
    row = runs.agg(F.max_by(F.struct("path", "contract"), "version").alias("m")).first()
    if row is None or row["m"] is None:
        raise ModelNotFound(f"model {name} version {version or 'latest'} is not registered under {root}")
    return row["m"]


def _load(spark: SparkSession, path: str) -> PipelineModel | TreeEnsemble:
    """A saved model of either kind; a node table is told by its folders."""
    spec = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/spec")
    if spec.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(spec):
        return TreeEnsemble.load(spark, path)
    return PipelineModel.load(path)


def load_model(spark: SparkSession, root: str, name: str, version: int | None = None) -> PipelineModel | TreeEnsemble:
    """Resolve name (+ version, default latest) through the ledger and load it."""
    return _load(spark, _registered(spark, root, name, version)["path"])


def load_serving(
    spark: SparkSession, root: str, name: str, version: int | None = None
) -> tuple[PipelineModel | TreeEnsemble, StructType | None]:
    """A registered model and the input contract stored with it."""
    found = _registered(spark, root, name, version)
    contract = input_contract(found["contract"]) if found["contract"] else None
    return _load(spark, found["path"]), contract
