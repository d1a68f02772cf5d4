"""Merkle manifest of a dataset by time-forward processing.

A row's leaf is the SHA-256 of its named fields, each with its length.  The rows
of a group (of one language, say) form a binary hash tree in id order; the
groups' subroots, in group order, form one more tree, whose top is the root.

Time-forward processing: nodes are labelled so that children come before their
parent, and digests are messages in a priority queue ordered by the label of the
node they go to.  The queue is external: it is a written table, range-partitioned
and sorted by label (Spark's external sort).  A round takes from it the messages
for all nodes of LEVELS levels; a task sweeps its run of labels with a small heap
(one block of at most 2 ** LEVELS messages at a time) and puts what goes to
higher nodes back as the next round's table, 2 ** LEVELS times smaller.  The
reversed sweep takes the rounds backwards: the message to a node is its proof
(siblings and sides up to the root), from which each child gets its own by
putting its sibling in front, down to the leaves.

No group is ever held by one task: a hot group is many blocks, and positions in
it come from running counts within the sorted partitions plus one offset a
partition (the only broadcast; a partition has one group that began earlier).

Defined results: null fields are ``-``; rows with equal ids are ordered by leaf
(equal rows are interchangeable); null ids and the null group come first; a lone
leaf is its group's subroot and a lone subroot the root; the last node of a level
without a partner is hashed alone; an empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinsignal.llm.common import store

LEVELS = 6  # tree levels that one round works through
BATCH = 4096  # rows a kernel gives out at once
LEFT, RIGHT, ALONE = "L", "R", "O"  # where a step's sibling stands


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


Label = tuple[int, int]  # (level, index); smaller labels come first


def sweep_up(leaves: list[str]) -> dict[Label, str]:
    """Digests of all nodes of a block, by label."""
    height = (len(leaves) - 1).bit_length()
    queue = [(0, i, 0, d) for i, d in enumerate(leaves)]  # to level, to index, side, digest
    done: dict[Label, str] = {}
    while queue:
        level, index, _, got = heapq.heappop(queue)
        parts = [got]
        while queue and queue[0][:2] == (level, index):
            parts.append(heapq.heappop(queue)[3])
        done[level, index] = sent = got if level == 0 else digest(parts)
        if level < height:
            heapq.heappush(queue, (level + 1, index >> 1, index & 1, sent))
    return done


def lift(top: str, levels: int) -> str:
    """The digest after some levels without a partner."""
    for _ in range(levels):
        top = digest([top])
    return top


def sweep_down(done: dict[Label, str], n: int, lifted: int) -> list[list[str]]:
    """Steps from every leaf of a block to its top, lowest first."""
    height = (n - 1).bit_length()
    queue = [(-height, 0, [ALONE] * lifted)]  # reversed labels
    proofs: list[list[str]] = [[]] * n
    while queue:
        level, index, steps = heapq.heappop(queue)
        level, index = -level, -index
        if level == 0:
            proofs[index] = steps
            continue
        left, right = done[level - 1, 2 * index], done.get((level - 1, 2 * index + 1))
        if right is None:
            heapq.heappush(queue, (1 - level, -2 * index, [ALONE, *steps]))
        else:
            heapq.heappush(queue, (1 - level, -2 * index, [RIGHT + right, *steps]))
            heapq.heappush(queue, (1 - level, -2 * index - 1, [LEFT + left, *steps]))
    return proofs


def siblings(steps: list[str]) -> str:
    return "".join(s[1:] for s in steps)


def fold(leaf: str, steps: list[str]) -> str:
    """The digest that a leaf and its proof lead to."""
    for s in steps:
        leaf = digest([s[1:], leaf] if s[0] == LEFT else [leaf, s[1:]])
    return leaf


def blocks(batches, names: list[str]) -> Iterator[tuple[tuple[str, int], list[tuple]]]:
    """(tree, block) and the named values of its rows; rows come sorted by tree and block."""
    key, held = None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        for tree, block, *row in zip(batch.column("tree").to_pylist(), batch.column("block").to_pylist(), *columns):
            if (tree, block) != key:
                if held:
                    yield key, held
                key, held = (tree, block), []
            held.append(row)
    if held:
        yield key, held


def in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def pack(held):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    held = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH:
            yield pack(held)
            held = []
    if held:
        yield pack(held)


def lifted_levels(block: int, n: int) -> int:
    """Levels above a block's own top that its round still works through: none for the
    only block of a tree, else up to those of a whole block."""
    return LEVELS - (n - 1).bit_length() if block else 0


UP = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("digest", pa.string())])


def rising(batches):
    """mapInArrow kernel: a round's nodes in label order -> one message a block."""

    def rows():
        for (tree, block), held in blocks(batches, ["digest"]):
            leaves = [d for (d,) in held]
            top = sweep_up(leaves)[(len(leaves) - 1).bit_length(), 0]
            yield tree, block, lift(top, lifted_levels(block, len(leaves)))

    return in_batches(rows(), UP)


DOWN = ["steps", "subroot", "root", "pos", "digest", "other", "id"]


def falling(last: bool, with_proof: bool = False):
    """mapInArrow kernel: the message to each block, then its nodes -> messages to the nodes.

    In the last round the nodes are leaves: out come proof, proof hash and folded root.
    """

    def rows(batches):
        for (tree, block), held in blocks(batches, DOWN):
            steps, subroot, root = held[0][:3]
            above = steps.split(",") if steps else []
            leaves = [r[4] for r in held[1:]]
            proofs = sweep_down(sweep_up(leaves), len(leaves), lifted_levels(block, len(leaves)))
            tail, folded = siblings(above), {}
            for (_, _, _, pos, leaf, other, ident), proof in zip(held[1:], proofs):
                if not last:
                    yield tree, pos, ",".join([*proof, *above]), subroot, root, leaf, ident
                    continue
                top = fold(other or leaf, proof)
                if top not in folded:  # leaves that were not altered meet at the block's top
                    folded[top] = fold(top, above)
                shown = hashlib.sha256((siblings(proof) + tail).encode()).hexdigest()
                whole = ",".join([*proof, *above]) if with_proof else None
                yield ident, leaf, subroot, root, shown, folded[top], whole

    def deliver(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        ident = ("id", first.schema.field("id").type)
        names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "proof"]
        between = [("tree", pa.string()), ("block", pa.int64()), *[(n, pa.string()) for n in (*DOWN[:3], "digest")], ident]
        schema = pa.schema([ident, *[(n, pa.string()) for n in names]] if last else between)
        yield from in_batches(rows(itertools.chain([first], batches)), schema)

    return deliver


def counting(batches):
    """mapInArrow kernel over sorted partitions: each row's position in its tree within
    the partition, and whether the tree is the partition's first."""
    tree, n, lead = None, 0, True
    for batch in batches:
        at, leads = [], []
        for t in batch.column("tree").to_pylist():
            if t != tree:
                lead = tree is None
                tree, n = t, 0
            at.append(n)
            leads.append(lead)
            n += 1
        arrays = [*batch.columns, pa.array(at, pa.int64()), pa.array(leads, pa.bool_())]
        yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "at", "lead"])


def positions(rows: DataFrame, *order) -> DataFrame:
    """Rows of every ``tree`` numbered from 0 in ``order`` (``pos``), without a task per tree.

    ``order`` must tell all rows apart, so ranges can be cut anywhere.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = ranged.withColumn("part", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("at", T.LongType()), T.StructField("lead", T.BooleanType())])
    numbered, _ = store(ranged.mapInArrow(counting, schema), "manifest-order")
    runs = numbered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.max("lead").alias("lead"))
    earlier = F.sum("n").over(W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    # at most one row per partition: only its first tree can have begun before
    offsets = runs.withColumn("before", earlier).where(F.col("lead") & F.col("before").isNotNull()).select("part", "before")
    before = F.when(F.col("lead"), F.coalesce("before", F.lit(0))).otherwise(0)
    return numbered.join(F.broadcast(offsets), "part", "left").withColumn("pos", F.col("at") + before)


def by_label(nodes: DataFrame) -> DataFrame:
    """The queue's next messages: sorted by the label of the block they go to."""
    return nodes.repartitionByRange("tree", "block").sortWithinPartitions("tree", "block", "pos")


def block_of(pos: Column) -> Column:
    return F.shiftright(pos, LEVELS)


def rounds_up(nodes: DataFrame) -> list[DataFrame]:
    """The nodes that each round begins with; in the last frame every tree has one."""
    rounds = [nodes]
    while True:
        waiting = rounds[-1].select("tree", block_of(F.col("pos")).alias("block"), "pos", "digest")
        up, _ = store(by_label(waiting).mapInArrow(rising, "tree string, pos bigint, digest string"), "manifest-up")
        rounds.append(up)
        if not up.agg(F.max("pos")).first()[0]:
            return rounds


def rounds_down(rounds: list[DataFrame], messages: DataFrame, with_proof: bool = False, leaves: bool = True) -> DataFrame:
    """Deliver ``messages`` (tree, block, steps, subroot, root) for the trees' tops to the first round's nodes."""
    id_type = rounds[0].schema["id"].dataType
    for k, nodes in reversed(list(enumerate(rounds[:-1]))):
        last = k == 0 and leaves
        told = messages.select(
            "tree", "block", *DOWN[:3], F.lit(-1).cast("bigint").alias("pos"), *[F.lit(None).cast("string").alias(c) for c in DOWN[4:6]]
        ).withColumn("id", F.lit(None).cast(id_type))
        nodes = nodes if k == 0 else nodes.withColumns({"other": F.lit(None).cast("string"), "id": F.lit(None).cast(id_type)})
        asked = nodes.select(
            "tree", block_of(F.col("pos")).alias("block"), *[F.lit(None).cast("string").alias(c) for c in DOWN[:3]], *DOWN[3:]
        )
        texts = [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root", "proof")]
        between = T.StructType.fromDDL("tree string, block bigint, steps string, subroot string, root string, digest string")
        ident = T.StructField("id", id_type)
        schema = T.StructType([ident, *texts] if last else [*between.fields, ident])
        # the tables of the queue are written, so a round is computed once
        messages, _ = store(by_label(told.unionByName(asked)).mapInArrow(falling(last, with_proof), schema), "manifest-down")
    return messages


def manifest(
    docs: DataFrame,
    fields: list[str],
    tree_col: str,
    id_col: str = "doc_id",
    altered: dict[str, Column] | None = None,
    where: Column | None = None,
    with_proof: bool = False,
) -> DataFrame:
    """Leaf, subroot, root and proof of every row, checked against the root.

    ``altered`` gives other values of fields for the rows of ``where``; their root
    is recomputed from the altered leaf, so that ``verified`` tells tampering.
    ``with_proof`` adds the proof itself: steps from the leaf to the root, each L or R
    (the side of its sibling) and the sibling, or O for a node hashed alone.
    """
    now = [F.col(f) for f in fields]
    then = [altered.get(f, F.col(f)) if altered else F.col(f) for f in fields]
    changed = F.when(where, leaf_digest(then)) if altered and where is not None else F.lit(None).cast("string")
    tree = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))  # null first, then bytewise
    leaves, _ = store(
        docs.select(
            tree.alias("tree"),
            F.col(id_col).alias("id"),
            leaf_digest(now).alias("digest"),
            changed.alias("other"),
            F.monotonically_increasing_id().alias("row"),  # tells equal rows apart; stored, so it stays
        ),
        "manifest-leaves",
    )
    groups = rounds_up(positions(leaves, F.col("id").asc_nulls_first(), "digest", "row"))
    subroots = groups[-1].select(
        F.lit("").alias("tree"), F.col("tree").alias("id"), "digest", F.lit(None).cast("string").alias("other")
    )
    above = rounds_up(positions(subroots, "id"))
    nothing = F.lit(None).cast("string")
    root = above[-1].select("tree", F.lit(0).cast("bigint").alias("block"), F.lit("").alias("steps"), nothing.alias("subroot"), F.col("digest").alias("root"))
    told = rounds_down(above, root, leaves=False)
    to_groups = told.select(F.col("id").alias("tree"), F.lit(0).cast("bigint").alias("block"), "steps", F.col("digest").alias("subroot"), "root")
    out = rounds_down(groups, to_groups, with_proof)
    return out.select(
        F.col("id").alias(id_col),
        *["leaf", "subroot", "root", "proof_sha256", "folded_root"],
        (F.col("folded_root") == F.col("root")).alias("verified"),
        *(["proof"] if with_proof else []),
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
