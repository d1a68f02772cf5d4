"""Scans of the given tables and of tables this pipeline writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinsignal.schemas import FEATURE_CONTRACT_V1


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided parquet tables (``<sf_dir>/<name>.parquet``)."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def table_stamp(spark: SparkSession, sf_dir: str, name: str) -> tuple[int, int, int]:
    """Bytes, files and time of last change of a provided table."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = fs.getContentSummary(path)
    return held.getLength(), held.getFileCount(), fs.getFileStatus(path).getModificationTime()


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Make sure a scan feeds every core.

    A large table already scans as many splits (one per file / row group) and is
    returned unchanged -- no shuffle.  A small table stored as one row group
    scans as a single task; it is redistributed round-robin to the cluster's
    default parallelism (a by-number repartition, which AQE does not coalesce).
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Snapshot scan of a table this pipeline wrote (parquet or delta)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _is_missing_path(exc: Exception) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text or "UNABLE_TO_INFER_SCHEMA" in text or "DELTA_TABLE_NOT_FOUND" in text


def read_table_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Scan with a contract schema; an absent table reads as an empty frame.

    A parquet directory written by a file sink is read through its commit log
    (``_spark_metadata``), so files of an uncommitted micro-batch are never seen.
    Only "path not found" is mapped to empty; other errors propagate.
    """
    try:
        reader = spark.read.format(fmt)
        # a Delta table has its own schema and refuses another
        df = (reader if fmt == "delta" else reader.schema(schema)).load(path)
        df.schema  # noqa: B018 - resolves the relation, raising for a missing path
        return df
    except Exception as exc:  # noqa: BLE001
        if _is_missing_path(exc):
            return spark.createDataFrame([], schema)
        raise


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_TIMES = [T.DateType(), T.TimestampNTZType(), T.TimestampType()]


def common_type(types: list[T.DataType]) -> T.DataType:
    """The narrowest type that holds all: whole numbers widen, mixed numbers become
    double, dates become timestamps, anything else becomes text."""
    kinds = list(dict.fromkeys(t for t in types if not isinstance(t, T.NullType)))
    if len(kinds) <= 1:
        return kinds[0] if kinds else T.StringType()
    for ladder in (_WHOLE, _TIMES):
        if all(k in ladder for k in kinds):
            return max(kinds, key=ladder.index)
    if all(isinstance(k, T.NumericType) for k in kinds):
        return T.DoubleType()
    return T.StringType()


def schema_groups(spark: SparkSession, files: list[str], base: str) -> list[tuple[list[str], T.StructType]]:
    """Groups of files whose column types agree, with the union of their columns.

    Footers are read by Spark's own distributed schema merge.  Where it meets two
    types of a column, the list is halved; files are listed by age, so those of one
    version of a job lie together and a drift costs the logarithm of their number.
    """
    reader = spark.read.option("mergeSchema", "true").option("basePath", base)
    try:
        return [(files, reader.parquet(*files).schema)]
    except Exception as exc:  # noqa: BLE001
        if "CANNOT_MERGE" not in str(exc) or len(files) == 1:
            raise
    half = len(files) // 2
    found = schema_groups(spark, files[:half], base) + schema_groups(spark, files[half:], base)
    return [([f for some, s in found if s == schema for f in some], schema) for schema in _distinct([s for _, s in found])]


def _distinct(schemas: list[T.StructType]) -> list[T.StructType]:
    out: list[T.StructType] = []
    for s in schemas:
        if s not in out:
            out.append(s)
    return out


def union_drifted(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a folder of parquet files whose columns and types changed over time.

    Columns are matched by name (absent ones are null) and cast to their common
    type; each group of files keeps its own scan, so pruning still reaches it.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    files = [r["path"] for r in listed.load(path).select("path", "modificationTime").orderBy("modificationTime", "path").collect()]
    if not files:
        raise FileNotFoundError(f"no files under {path}")
    groups = schema_groups(spark, files, path)
    names = list(dict.fromkeys(n for _, schema in groups for n in schema.names))
    kinds = {n: common_type([s[n].dataType for _, s in groups if n in s.names]) for n in names}
    union = None
    for some, schema in groups:
        rows = spark.read.schema(schema).option("basePath", path).parquet(*some)
        rows = rows.select(*[(F.col(n) if n in schema.names else F.lit(None)).cast(kinds[n]).alias(n) for n in names])
        union = rows if union is None else union.unionByName(rows)
    return union


def literal_vector(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """Inline v1 feature rows (the ad hoc triage vector by default)."""
    # The triage sample vector.
    default_rows = [(145.0, 92.0, 1, 1)]
    return spark.createDataFrame(rows or default_rows, FEATURE_CONTRACT_V1)


def newest_partitions(table: DataFrame, rows: int, date_col: str) -> DataFrame:
    """Restrict a date-partitioned table to the newest partitions that hold at
    least ``rows`` rows (exact for a newest-first top-k).

    Counting rows per partition value reads no column data (empty read
    schema: row counts come from parquet metadata); the driver sees one row
    per date, then the filter on the partition column prunes every older
    partition from the scan.
    """
    counts = table.groupBy(date_col).agg(F.count(F.lit(1)).alias("n")).collect()
    dated = sorted(((r[date_col], r["n"]) for r in counts if r[date_col] is not None), reverse=True)
    total = 0
    for day, n in dated:
        total += n
        if total >= rows:
            return table.where(F.col(date_col) >= F.lit(day))
    return table  # fewer than ``rows`` dated rows: undated ones are needed too
