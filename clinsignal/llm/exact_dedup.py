"""Exact deduplication with two-pass Bloom filtering.

Pass 1 inserts the hash of every text into a blocked Bloom filter and records
the bits that are hit at least twice.  Pass 2 tests every row against those
bits: a row whose bits were not all hit twice is unique beyond doubt and passes
straight through; only the others -- the repeated texts and about one unique
text in a hundred -- are shuffled and grouped by the full SHA-256.

The filter is split into segments of 8 KiB.  Tasks send a segment's set
positions (each at most twice, so a text that fills a third of the table costs
no more than any other), a segment is merged in one task, and its size is
fixed.  The number of segments grows with the rows; at most ``filter_bytes``
of them are broadcast at a time, and a larger filter is applied in several
waves over the stored hash table.

Defined results: a null text equals the empty text.  Of equal texts the
largest id stays (null ids only stay when the whole group has none).  Rows
that repeat the same id and text are one document and share its decision.
An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinsignal.llm.common import store

SEGMENT_BITS = 1 << 16
SEGMENT_BYTES = SEGMENT_BITS // 8
PROBES = 4
BITS_PER_ROW = 12
FILTER_BYTES = 32 << 20  # bound of one broadcast filter


def probe_positions(h2: np.ndarray) -> np.ndarray:
    """(rows, PROBES) positions inside a segment, 16 bits of the hash each."""
    bits = h2.astype(np.uint64)
    return np.stack([(bits >> np.uint64(16 * i)) & np.uint64(0xFFFF) for i in range(PROBES)], axis=1).astype(np.int64)


def insert(batches):
    """mapInArrow: (segment, h2) -> (segment, positions), each position at most twice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        segment = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        cell = (segment[:, None] * SEGMENT_BITS + probe_positions(batch.column(1).to_numpy(zero_copy_only=False))).ravel()
        cell, times = np.unique(cell, return_counts=True)
        cell = np.repeat(cell, np.minimum(times, 2))
        owner = cell // SEGMENT_BITS
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        parts = np.split((cell % SEGMENT_BITS).astype("<u2"), starts[1:])
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner[starts], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
            names=["segment", "positions"],
        )


def merge(key, rows):
    """applyInArrow: the bits of one segment that are hit at least twice."""
    times = np.zeros(SEGMENT_BITS, np.uint8)
    for piece in rows.column("positions").to_pylist():
        at, n = np.unique(np.frombuffer(piece, "<u2"), return_counts=True)
        times[at] = np.minimum(times[at] + n, 2)
    bits = np.packbits(times >= 2, bitorder="little").tobytes()
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits], pa.binary())})


def tester(first: int, filter_bc, columns: list[str]):
    """mapInArrow kernel: adds ``maybe`` -- all the row's bits were hit twice."""

    def test(batches):
        bits = np.frombuffer(filter_bc.value, np.uint8)
        for batch in batches:
            segment = batch.column("segment").to_numpy(zero_copy_only=False).astype(np.int64) - first
            at = segment[:, None] * SEGMENT_BITS + probe_positions(batch.column("h2").to_numpy(zero_copy_only=False))
            hit = ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1) if len(segment) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(hit)], names=[*columns, "maybe"])

    return test


def possibly_repeated(hashed: DataFrame, rows: int, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``hashed`` (id, sha) with ``maybe``: false only for texts that occur once."""
    spark = hashed.sparkSession
    segments = max(1, -(-rows * BITS_PER_ROW // SEGMENT_BITS))
    keyed = hashed.select(
        "id",
        "sha",
        F.pmod(F.xxhash64("sha"), F.lit(segments)).cast("bigint").alias("segment"),
        F.xxhash64(F.lit("probe"), "sha").alias("h2"),
    )
    at_once = max(1, filter_bytes // SEGMENT_BYTES)
    id_type = dict(keyed.dtypes)["id"]
    parts = []
    for first in range(0, segments, at_once):
        count = min(at_once, segments - first)
        wave = keyed.where(F.col("segment").between(first, first + count - 1)) if count < segments else keyed
        repeated = (
            wave.select("segment", "h2")
            .mapInArrow(insert, "segment bigint, positions binary")
            .groupBy("segment")
            .applyInArrow(merge, "segment bigint, bits binary")
        )
        filled = bytearray(count * SEGMENT_BYTES)  # at most filter_bytes
        for row in repeated.toLocalIterator():
            at = (row["segment"] - first) * SEGMENT_BYTES
            filled[at : at + SEGMENT_BYTES] = row["bits"]
        kernel = tester(first, spark.sparkContext.broadcast(bytes(filled)), ["id", "sha"])
        parts.append(wave.mapInArrow(kernel, f"id {id_type}, sha string, maybe boolean"))
    return reduce(DataFrame.unionByName, parts)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    hashed, _ = store(
        docs.select(F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("sha")), "hashes"
    )
    marked, _ = store(possibly_repeated(hashed, hashed.count(), filter_bytes), "marked")
    through = marked.where(~F.col("maybe")).select("id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"))
    suspects = marked.where("maybe").select("id", "sha")
    # written first, so the join below is a plain one and AQE can split a hot group's rows
    groups, _ = store(
        suspects.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "copy-groups"
    )
    grouped = suspects.join(groups, "sha").select("id", "sha", "keep_id", "group_size")
    return through.unionByName(grouped).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
