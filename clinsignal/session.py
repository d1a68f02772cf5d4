"""Session helpers: runtime configuration and the shared work folder.

The caller owns the SparkSession (cluster builders differ); we only set
runtime SQL confs and find the shared folder for checkpoints and
intermediate tables.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime confs every job relies on.  Time zone: the pipeline stores
# instants and formats clock text from them, so it is pinned to UTC.
RUNTIME_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a second start of a query on a live checkpoint must fail, not
    # silently stop the running one
    "spark.sql.streaming.stopActiveRunOnRestart": "false",
    # texts can be long: Arrow batches to Python are bounded by rows and bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONFS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "clinsignal",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, bench and the smoke entry point (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint
    dir).  Only a local master may go without: a folder is created for it and
    registered as the checkpoint dir.  Elsewhere a machine-local folder would
    be a different folder on every executor, so that raises.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises on some versions
            configured = None
    if not configured:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        configured = tempfile.mkdtemp(prefix="clinsignal-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


_OWNED: list[str] = []  # scratch paths this process made and has not removed


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique sub-path of the shared work folder, owned by this process."""
    path = f"{work_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"
    _OWNED.append(path)
    return path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Remove scratch paths made by this process (others are refused)."""
    for path in paths:
        if path not in _OWNED:
            raise ValueError(f"{path} is not a scratch path of this process")
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        _OWNED.remove(path)


def clean_scratch(spark: SparkSession) -> int:
    """Remove every scratch path this process still owns; call when its results
    are no longer read (jobs do so at their end).  Returns the number removed."""
    paths = list(_OWNED)
    drop_scratch(spark, *paths)
    return len(paths)
