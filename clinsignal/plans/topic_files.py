"""A topic as Kafka-shaped files in time order: what tests and registered queries replay."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsignal.sources.sinks import drop_folders, folder_bytes, write_by_date


@dataclass(frozen=True)
class FileTopic:
    """A file-backed topic: ``path`` holds ``n_slices`` time slices written in
    time order, each of ``files_per_slice`` files."""

    path: str
    n_slices: int
    files_per_slice: int

    def stream_options(self) -> dict[str, str]:
        """One time slice per micro-batch."""
        return {"maxFilesPerTrigger": str(self.files_per_slice)}


SLICE = "time_slice"
FILE_BYTES = 8 << 20  # of one topic file (compressed JSON): tasks stay small and all cores busy as topics grow


def _slice_number(time: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds a time has reached, by halving; 0 without a time."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(time >= bounds[middle], among(middle + 1, high)).otherwise(among(low, middle))

    return among(0, len(bounds))


def write_time_ordered_files(
    rows: DataFrame, path: str, n_slices: int, time_col: str = "timestamp", bounds: list[int] | None = None
) -> FileTopic:
    """Persist rows as ``n_slices`` time slices written one after another in
    time order (a file-backed topic for tests and replays).

    A file stream source picks files by modification time, so later slices are
    never seen before earlier ones and a watermark never drops them.  Rows are
    staged once, partitioned by slice, and every slice is dealt from its own
    staging files: the work is two writes of the rows, whatever the number of
    slices.  All slices have the same number of files, one for every
    ``FILE_BYTES`` of the largest; none has more files than the smallest has rows.
    Slice bounds are ``n_slices - 1`` approximate quantiles (a bounded fetch), or
    ``bounds`` in microseconds since 1970; a slice without rows is left out.
    """
    spark = rows.sparkSession
    t = F.unix_micros(F.col(time_col).cast("timestamp"))
    if bounds is None and n_slices > 1:
        probs = [i / n_slices for i in range(1, n_slices)]
        row = rows.agg(F.percentile_approx(t, probs, 10_000).alias("b")).first()
        bounds = [b for b in (row["b"] or []) if b is not None]
    staging = f"{path.rstrip('/')}-staging"
    write_by_date(rows.withColumn(SLICE, _slice_number(t, sorted(set(bounds or [])))), SLICE, staging)
    held = {r[SLICE]: r["n"] for r in spark.read.parquet(staging).groupBy(SLICE).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not held:
        rows.limit(0).write.mode("append").parquet(path)
        return FileTopic(path, 0, 1)
    largest = max(folder_bytes(spark, f"{staging}/{SLICE}={s}") for s in held)
    spread = spark.sparkContext.defaultParallelism
    files_per_slice = min(max(-(-spread // len(held)), -(-largest // FILE_BYTES)), *held.values())
    for s in sorted(held):
        part = spark.read.parquet(f"{staging}/{SLICE}={s}")
        if held[s] < files_per_slice * part.rdd.getNumPartitions():
            part = part.coalesce(1)  # so few rows are dealt in turn, so that no file is left out
        part.repartition(files_per_slice).write.mode("append").parquet(path)
    drop_folders(spark, [staging])
    return FileTopic(path, len(held), files_per_slice)
