"""Near-duplicate detection with circulant MinHash.

A document is the set of its distinct word shingles, each a 64-bit hash.  Two
permutations of the 32-bit numbers give all signature coordinates: the first
(sigma) scatters the shingles once, the second (pi) is circularly shifted by k
for coordinate k, so h_k = min pi(sigma(s) - k).  Rows of coordinates are
hashed to bands; documents that share a band are candidates, and a link needs
an exact Jaccard similarity of at least 80 / 100 on the full sets.

Copies (equal sets) are one node, named by their smallest id.  Within a band
bucket no pairs are spelled out: in two rounds every node is compared with one
centre of the bucket -- first the member with the most bucket mates, which is
the original where edited copies resemble it more than each other, then one
drawn at random -- and the verified links are closed to components.  Only buckets that still hold several
components go on to the last round, where members of different components are
compared with each other, so no link that the bands offer is left out.  There
each member carries a parity sketch of its set (every shingle flips one bit):
the exclusive-or of two sketches has at most as many ones as the sets differ
in, so a pair with more ones than a link allows is no link, for certain, and
the join itself leaves it out; the others are compared on the full sets.  With
ROWS = 6 and BANDS = 40 a pair of similarity 0.8 shares no band with
probability 5e-6.

Defined results: texts without words (or null) have an empty set, no links and
stay; a single word is its own shingle; rows that repeat an id and text share
their result; rows with a null id are not linked and stay; an empty table gives
an empty result.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsignal.llm.common import store
from clinsignal.session import drop_scratch

ROWS = 6
BANDS = 40
PERCENT = 80
SKETCH_WORDS = 16  # 64-bit words of a parity sketch
SMALL_IDS = 1_000_000  # ids broadcast to pick texts for verification, 8 bytes each


# ---------------------------------------------------------------- shingles
def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and the number of words of each text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = flat.dictionary_encode()
    names = coded.dictionary.to_pylist()
    table = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))
    hashes = table[coded.indices.to_numpy(zero_copy_only=False)] if len(names) else np.zeros(0, np.uint64)
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(sizes)), sizes)[full]
    return hashes[full], np.bincount(owner, minlength=len(sizes)).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles of one document; fewer words than ``width`` are one shingle."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = mix64(out * np.uint64(0x100000001B3) + hashes[i : i + n])
    return np.unique(out)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    hashes, sizes = word_hashes(texts)
    return [shingle_set(part, width) for part in np.split(hashes, np.cumsum(sizes)[:-1])]


def fingerprint(sets: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(sets.tobytes())
    return tuple(np.frombuffer(digest, "<i8").tolist())


# --------------------------------------------------------------- signatures
def permute32(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place (each step is a bijection)."""
    x *= np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    x ^= x >> np.uint32(13)
    return x


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """h_k = min over shingles of pi(sigma(s) - k), k = 0 .. size - 1."""
    scattered = permute32((shingles >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995))
    shift = np.arange(size, dtype=np.uint32)[:, None]
    best = np.full(size, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(scattered), 1024):
        shifted = permute32(scattered[None, i : i + 1024] - shift)
        np.minimum(best, shifted.min(axis=1), out=best)
    return best


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of the key."""
    bands = sig.reshape(-1, rows).astype(np.uint64)
    key = np.arange(len(bands), dtype=np.uint64)
    for i in range(rows):
        key = mix64(key * np.uint64(0x100000001B3) + bands[:, i])
    return key.astype(np.int64)


def parity_sketch(shingles: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Bit b tells whether an odd number of the set's shingles fall on b."""
    bits = (mix64(shingles) % np.uint64(64 * words)).astype(np.int64)
    odd = (np.bincount(bits, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8")


def signer(width: int, rows: int, bands: int):
    """mapInArrow kernel: (id, text) -> id, n, fingerprint, band keys, parity sketch."""

    def sign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sets = shingle_sets(batch.column(1).cast(pa.string()), width)
            marks = [fingerprint(s) for s in sets]
            keys = [band_keys(signature(s, rows * bands), rows) if len(s) else np.zeros(0, np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([a for a, _ in marks], pa.int64()),
                    pa.array([b for _, b in marks], pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array([parity_sketch(s) for s in sets], pa.list_(pa.int64())),
                ],
                names=["id", "n", "f1", "f2", "keys", "sketch"],
            )

    return sign


def setter(width: int):
    """mapInArrow kernel: (node, f1, f2, text) -> node, shingle set, where the text has the fingerprint."""

    def sets_of(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sets = shingle_sets(batch.column("text").cast(pa.string()), width)
            wanted = zip(batch.column("f1").to_pylist(), batch.column("f2").to_pylist())
            keep = [i for i, (s, f) in enumerate(zip(sets, wanted)) if fingerprint(s) == f]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(pa.array(keep, pa.int64())),
                    pa.array([sets[i].astype(np.int64) for i in keep], pa.list_(pa.int64())),
                ],
                names=["node", "shingles"],
            )

    return sets_of


# --------------------------------------------------------------- components
def components(links: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(node, comp): smallest node reachable over the links (u, v).

    Each round takes the least label among the neighbours and then the label's
    own label, so chains shorten by half; tables are written every round.
    Labels only fall, so the rounds end by themselves; with ``max_rounds``, labels
    that have not settled by then are an error.
    """
    spark = links.sparkSession
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both, both_path = store(both, "links")
    labels, path = store(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("comp")).withColumnRenamed("u", "node"), "labels")
    changed, rounds = 1, 0
    while changed:
        if rounds == max_rounds:
            raise RuntimeError(f"components have not settled after {max_rounds} rounds")
        rounds += 1
        near = (
            both.join(labels.withColumnRenamed("node", "v"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("comp").alias("low"))
        )
        lowered = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "low").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        moved, new_path = store(
            lowered.join(jump, "comp", "left").select("node", "old", F.least("comp", "far").alias("comp")), "labels"
        )
        changed = moved.where(F.col("old") != F.col("comp")).limit(1).count()
        drop_scratch(spark, path)
        labels, path = moved.select("node", "comp"), new_path
    drop_scratch(spark, both_path)
    return labels


# -------------------------------------------------------------------- links
class Verifier:
    """Exact similarity of candidate pairs; shingle sets are fetched once per node."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, width: int, percent: int):
        self.docs, self.nodes, self.width, self.percent = docs, nodes, width, percent
        self.sets: DataFrame | None = None

    def _fetch(self, pairs: DataFrame) -> None:
        wanted = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("node").distinct(), "node", "left_anti")
        wanted, path = store(wanted.join(self.nodes.select("node", "f1", "f2"), "node"), "wanted")
        picked = F.broadcast(wanted) if wanted.count() <= SMALL_IDS else wanted
        node_type = dict(self.nodes.dtypes)["node"]
        fetched, _ = store(
            self.docs.join(picked, self.docs["id"] == picked["node"])
            .select("node", "f1", "f2", "text")
            .mapInArrow(setter(self.width), f"node {node_type}, shingles array<bigint>")
            .dropDuplicates(["node", "shingles"]),
            "sets",
        )
        self.sets = fetched if self.sets is None else self.sets.unionByName(fetched)

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) whose sets are similar enough, stored."""
        self._fetch(pairs)
        a = self.sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
        b = self.sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
        shared = F.size(F.array_intersect("a", "b"))
        close = 100 * shared >= self.percent * (F.size("a") + F.size("b") - shared)
        found, _ = store(pairs.join(a, "u").join(b, "v").where(close).select("u", "v").distinct(), "near")
        return found


def size_fits(n1: Column, n2: Column, percent: int) -> Column:
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def star_pairs(members: DataFrame, labels: DataFrame | None, rank: Column, percent: int) -> DataFrame:
    """Members of a bucket against its centre -- the least ``rank`` -- where the components differ."""
    labelled = members if labels is None else members.join(labels, "node", "left")
    comp = F.col("node") if labels is None else F.coalesce(F.col("comp"), F.col("node"))
    labelled = labelled.withColumn("comp", comp)
    centres, _ = store(
        labelled.groupBy("key")
        .agg(
            F.min(F.struct(rank.alias("rank"), "node", "n", "comp")).alias("c"),
            F.min("comp").alias("least"),
            F.max("comp").alias("most"),
        )
        .where(F.col("least") != F.col("most"))
        .select("key", F.col("c.node").alias("centre"), F.col("c.n").alias("m"), F.col("c.comp").alias("centre_comp")),
        "centres",
    )
    pairs = labelled.join(centres, "key").where(
        (F.col("comp") != F.col("centre_comp")) & size_fits(F.col("n"), F.col("m"), percent)
    )
    return pairs.select(F.least("node", "centre").alias("u"), F.greatest("node", "centre").alias("v"))


def sketch_fits(a: Column, b: Column, n1: Column, n2: Column, percent: int) -> Column:
    """False only for sets that differ in more shingles than a link allows."""
    ones = sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SKETCH_WORDS)), F.lit(0))
    return (100 + percent) * ones <= (100 - percent) * (n1 + n2)


def cross_pairs(members: DataFrame, labels: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Members of one bucket in different components whose sketches allow a link."""
    labelled = members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed, _ = store(
        labelled.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least != most").select("key"),
        "mixed",
    )
    apart, _ = store(labelled.join(mixed, "key"), "mixed-members")
    needed = sketches.join(apart.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    left, _ = store(apart.join(needed, "node"), "sketched-members")
    right = left.select(
        "key", F.col("node").alias("v"), F.col("n").alias("m"), F.col("comp").alias("other"), F.col("sketch").alias("sketch_v")
    )
    return (
        left.join(right, "key")
        .where(
            (F.col("node") < F.col("v"))
            & (F.col("comp") != F.col("other"))
            & size_fits(F.col("n"), F.col("m"), percent)
            & sketch_fits(F.col("sketch"), F.col("sketch_v"), F.col("n"), F.col("m"), percent)
        )
        .select(F.col("node").alias("u"), "v")
    )


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = PERCENT,
    rows: int = ROWS,
    bands: int = BANDS,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = dict(texts.dtypes)["id"]
    signed, _ = store(
        texts.mapInArrow(
            signer(width, rows, bands), f"id {id_type}, n bigint, f1 bigint, f2 bigint, keys array<bigint>, sketch array<bigint>"
        ),
        "signed",
    )
    usable = signed.where((F.col("n") > 0) & F.col("id").isNotNull())
    # copies collapse to one node; the aggregation combines before it shuffles
    nodes, _ = store(usable.groupBy("f1", "f2").agg(F.min("id").alias("node"), F.max("n").alias("n")), "nodes")
    first = usable.join(nodes.select("f1", "f2", F.col("node").alias("id")), ["f1", "f2", "id"], "left_semi")
    sketches = first.select(F.col("id").alias("node"), "sketch")
    keyed = first.select(F.col("id").alias("node"), "n", F.explode("keys").alias("key"))
    entries, entries_path = store(keyed.distinct(), "bands")
    crowded, _ = store(entries.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "crowded")
    sharing, _ = store(entries.join(crowded, "key"), "sharing")
    mates = sharing.groupBy("node").agg(F.sum("c").alias("mates"))
    members, _ = store(sharing.drop("c").join(mates, "node"), "members")
    drop_scratch(docs.sparkSession, entries_path)

    verifier = Verifier(texts, nodes, width, percent)
    # round 1: every node against the centre it shares most bands with
    counted = star_pairs(members, None, -F.col("mates"), percent).groupBy("u", "v").agg(F.count(F.lit(1)).alias("c"))
    tried, _ = store(counted, "pairs")
    ends = tried.select(F.col("u").alias("node"), "u", "v", "c").union(tried.select(F.col("v").alias("node"), "u", "v", "c"))
    best = ends.groupBy("node").agg(F.max(F.struct("c", F.xxhash64("u", "v").alias("h"), "u", "v")).alias("p"))
    seen, _ = store(best.select("p.u", "p.v").distinct(), "pairs")
    links = verifier.links(seen)
    labels = components(links)
    # round 2: all centres, new ones, between components; round 3: whoever is still apart
    draw = F.xxhash64("node", "key")
    for pairs in (lambda: star_pairs(members, labels, draw, percent), lambda: cross_pairs(members, labels, sketches, percent)):
        fresh, _ = store(pairs().distinct().join(seen, ["u", "v"], "left_anti"), "pairs")
        links = links.unionByName(verifier.links(fresh))
        seen = seen.unionByName(fresh)
        labels = components(links)

    grouped = nodes.join(labels, "node", "left").select("f1", "f2", F.coalesce("comp", "node").alias("component_id"))
    linked = usable.select("id", "n", "f1", "f2").join(grouped, ["f1", "f2"]).select("id", "n", "component_id")
    alone = signed.where((F.col("n") == 0) | F.col("id").isNull()).select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
