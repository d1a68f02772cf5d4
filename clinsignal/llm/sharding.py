"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has RING positions; every shard owns ``vnodes`` pseudo-random ones.  A
document hashes to a position and belongs to the next virtual node clockwise.
Each shard has a capacity in rows -- floor or ceiling of rows / shards, the
first (rows mod shards) shards taking the ceiling -- and keys that overflow a
full shard continue clockwise to the next virtual node whose shard has room.
So counts differ by at most one, and only overflow ever leaves its ring owner.

Rows are counted per ring position (at most RING counts reach the driver,
whatever the table's size); the walk over those counts gives each position's
ranks to shards and slots, and rows pick theirs by their rank inside the
position.  Positions that hold many rows are ranked in several tasks.

Defined results: a null or empty text has size 1; rows with equal ids share a
ring position and are told apart by their hash and size; null ids share one position;
an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinsignal.llm.common import salted, store

RING = 1 << 16
VNODES = 128


def ring_owners(shards: int, vnodes: int = VNODES, ring: int = RING) -> list[tuple[int, int]]:
    """Virtual nodes as sorted (position, shard); a position taken twice goes to the lower shard."""
    at: dict[int, int] = {}
    for shard in range(shards):
        for v in range(vnodes):
            digest = hashlib.sha256(f"shard-{shard}-vnode-{v}".encode()).digest()
            position = int.from_bytes(digest[:8], "big") % ring
            at[position] = min(at.get(position, shard), shard)
    return sorted(at.items())


def walk(counts: dict[int, int], shards: int, vnodes: int = VNODES, ring: int = RING) -> list[tuple[int, int, int, int]]:
    """Bounded-load walk over rows per ring position.

    Returns (position, first rank, rows, shard) pieces that cover every rank of
    every position once.  Rounds: every waiting piece asks the shard of its
    virtual node, in ring order; what does not fit moves on to the next node.
    """
    nodes = ring_owners(shards, vnodes, ring)
    places = [p for p, _ in nodes]
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    waiting = [(bisect.bisect_left(places, pos) % len(nodes), pos, 0, n) for pos, n in sorted(counts.items())]
    pieces = []
    while waiting:
        rest = []
        for node, pos, first, n in waiting:
            shard = nodes[node][1]
            fit = min(n, room[shard])
            if fit:
                room[shard] -= fit
                pieces.append((pos, first, fit, shard))
            if n > fit:
                step = (node + 1) % len(nodes)
                while not room[nodes[step][1]] and step != node:
                    step = (step + 1) % len(nodes)
                rest.append((step, pos, first + fit, n - fit))
        # ring order from the node that is asked next
        waiting = sorted(rest)
    return sorted(pieces)


def with_slots(pieces: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Adds each piece's first slot: slots of a shard follow ring order without gaps."""
    used: dict[int, int] = defaultdict(int)
    out = []
    for pos, first, n, shard in pieces:
        out.append((pos, first, n, shard, used[shard]))
        used[shard] += n
    return out


def shard_rows(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", vnodes: int = VNODES
) -> DataFrame:
    """One row per document: id, size, text_crc32, shard, slot."""
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows, _ = store(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text).alias("crc"),
            F.xxhash64(F.lit("ring"), F.col(id_col).cast("string")).alias("h"),
        ).withColumn("position", F.pmod("h", F.lit(RING)).cast("int")),
        "shard-keys",
    )
    counts = {r["position"]: r["n"] for r in rows.groupBy("position").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    spread = F.xxhash64("h", "size", "crc")
    split = salted(rows, ["position"], spread, total)
    # rank of a row inside its position: rows before its salt plus its rank inside
    salts = split.groupBy("position", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(
        F.sum("n").over(W.partitionBy("position").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    salts = salts.select("position", "salt", before.alias("before"))
    inside = F.row_number().over(W.partitionBy("position", "salt").orderBy("h", "id", "crc", "size"))
    ranked = (
        split.withColumn("inside", inside)
        .join(salts, ["position", "salt"])
        .withColumn("rank", F.col("before") + F.col("inside") - 1)
    )
    schema = "position int, first bigint, n bigint, shard int, slot0 bigint"
    # a piece per ring position and shard boundary: at most RING + shards * vnodes rows
    pieces = spark.createDataFrame(with_slots(walk(counts, shards, vnodes)), schema)
    placed = ranked.join(F.broadcast(pieces), "position").where(
        (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))
    )
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("slot0") + F.col("rank") - F.col("first")).cast("bigint").alias("slot"),
    )
