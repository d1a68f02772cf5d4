"""Table writers: atomic snapshot replacement and appends.

Delta overwrites are atomic by themselves.  A parquet overwrite is not (a
reader can see a half-deleted directory), so parquet snapshots are written to
a new directory and published by a small file that names it; readers take the
highest published version.  The file of a version must not exist before, so no
two writers publish the same one: the loser of a race takes the next number.

Two jobs that append to one folder share its temporary folder and can break each
other, so appends of independent writers go to folders of their own.

Micro-batch sinks keep one ``batch_id=`` folder per batch; the helpers here list
the folders and drop the ones that a later merge has made useless.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
def _fs(spark: SparkSession, path: str):
    """(file system, path object) of a path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def claim_number(spark: SparkSession, folder: str, first: int, text: str = "") -> int:
    """The lowest number from ``first`` on that nobody has claimed, now claimed with ``text``.

    A claim is a file that must not exist yet.  The owner's token is read back, for
    stores whose check and creation are two steps.
    """
    number, body = first, f"{uuid.uuid4().hex}\n{text}"
    while True:
        path = f"{folder.rstrip('/')}/{number:08d}"
        fs, target = _fs(spark, path)
        try:
            out = fs.create(target, False)
            try:
                out.write(bytearray(body, "utf-8"))
            finally:
                out.close()
        except Py4JJavaError as exc:
            if not fs.exists(target):
                raise exc
        else:
            if _read_text(spark, path) == body:
                return number
        number += 1


def _read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def claimed(spark: SparkSession, folder: str) -> list[int]:
    """Claimed numbers, ascending."""
    fs, target = _fs(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return sorted(int(n) for n in names if n.isdigit())


def folder_values(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the ``key=`` folders under a path, ascending as text."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{key}="))


def batch_ids(spark: SparkSession, path: str, key: str = "batch_id") -> list[int]:
    """Numbers of the micro-batch folders of a sink, ascending."""
    return sorted(int(v) for v in folder_values(spark, path, key))


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _fs(spark, path)
    return fs.getContentSummary(target).getLength()


def drop_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, target = _fs(spark, path)
        fs.delete(target, True)


def _versions(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def current_version(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Latest published (version, path) of a snapshot table; (0, None) if none."""
    for number in reversed(claimed(spark, _versions(root))):
        _, _, path = _read_text(spark, f"{_versions(root)}/{number:08d}").partition("\n")
        if path:  # empty while its writer is at it
            return number, path
    return 0, None


def write_snapshot(df: DataFrame, root: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Replace the table at ``root`` with ``df``; returns the path now current."""
    spark = df.sparkSession
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "delta":
        writer.mode("overwrite").save(root)
        return root
    # a path of its own: writers never share one, and a crash blocks no later run
    path = f"{root.rstrip('/')}/data-{uuid.uuid4().hex[:12]}"
    writer.mode("errorifexists").save(path)
    # claimed once the data is whole: numbers follow the order of publication
    claim_number(spark, _versions(root), current_version(spark, root)[0] + 1, path)
    return path


def read_snapshot(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Read the current snapshot written by ``write_snapshot``."""
    if fmt == "delta":
        return spark.read.format("delta").load(root)
    _, path = current_version(spark, root)
    if path is None:
        raise FileNotFoundError(f"no published snapshot under {root}")
    return spark.read.format(fmt).load(path)


def write_by_date(df: DataFrame, date_col: str, path: str) -> None:
    """A new table partitioned by date, with as many files a day as its bytes need.

    Rows are rebalanced by date first (large days are split, small ones share a
    task); without it every task would write a file for every date it meets.
    """
    df.hint("rebalance", date_col).write.mode("errorifexists").partitionBy(date_col).parquet(path)


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_alone(df: DataFrame, path: str) -> None:
    """Append rows in a folder of their own, so that writers do not meet."""
    df.coalesce(1).write.mode("errorifexists").parquet(f"{path.rstrip('/')}/writer={uuid.uuid4().hex}")


def compact(spark: SparkSession, source_path: str, root: str, n_files: int, fmt: str = "parquet", schema=None) -> str:
    """Rewrite a many-small-files table (one file set per micro-batch) as
    ``n_files`` files, published as a new snapshot version under ``root``.

    The source is scanned through its commit log (file sink) when it has one;
    readers of ``root`` switch to the compacted version atomically.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return write_snapshot(reader.load(source_path).repartition(n_files), root, fmt)
