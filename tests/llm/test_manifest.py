"""Merkle manifest: against a literal tree, on edge rows and across block bounds."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from clinsignal.llm import manifest, queries
from tests.llm.conftest import SCHEMA


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, extra=0) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    if values[3] is not None:
        values[3] += extra
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves):
    """(top, for every leaf its [(sibling stands left, sibling or None)])."""
    steps, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for leaf, pos in enumerate(at):
            other = pos ^ 1
            steps[leaf].append((pos & 1 == 1, nodes[other] if other < len(nodes) else None))
        nodes = [H(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at = [pos // 2 for pos in at]
    return (nodes[0] if nodes else None), steps


def brute(rows):
    """Result rows by a literal reading of the manifest."""
    rows = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    groups = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    low = {g: tree([leaf_of(r) for r in rows if r["lang"] == g]) for g in groups}
    root, high = tree([low[g][0] for g in groups])
    out = []
    for g, above in zip(groups, high):
        for r, below in zip([r for r in rows if r["lang"] == g], low[g][1]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            x = leaf_of(r, 1 if hit else 0)
            for left, sibling in below + above:
                x = H(x) if sibling is None else H(sibling, x) if left else H(x, sibling)
            proof = H(*[s for _, s in below + above if s])
            out.append((r["doc_id"], leaf_of(r), low[g][0], root, proof, x, x == root))
    return out


def op(docs):
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    return manifest.manifest(
        docs, queries.MANIFEST_FIELDS, "lang", altered={"n_chars": more}, where=F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    )


def in_order(rows):
    return sorted([tuple(r) for r in rows], key=str)


def test_edge_rows(edge):
    got = in_order(op(edge).collect())
    want = in_order(brute(edge.collect()))
    assert got == want


def test_documents(docs):
    assert in_order(op(docs).collect()) == in_order(brute(docs.collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 129])
def test_sizes_around_blocks(spark, n):
    rows = [(i // 2, f"text {i}", None if i % 3 else "x", "s", i, "k", 0, 0, 0) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert in_order(op(docs).collect()) == in_order(brute(docs.collect()))


def test_one_hot_group_of_equal_rows(spark):
    rows = [(7, "same", "en", "s", 4, "k", 0, 0, 0)] * 5000
    got = op(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 5000 and len({r["root"] for r in got}) == 1
    assert in_order(got) == in_order(brute(spark.createDataFrame(rows, SCHEMA).collect()))


def test_empty(empty):
    assert op(empty).count() == 0


def test_proofs_can_be_checked_alone(docs):
    out = manifest.manifest(docs, queries.MANIFEST_FIELDS, "lang", with_proof=True).collect()
    for r in out:
        assert manifest.fold(r["leaf"], r["proof"].split(",")) == r["root"] and r["verified"]


def test_sweeps_against_a_literal_tree():
    for n in range(1, 40):
        leaves = [H(str(i)) for i in range(n)]
        done, (top, steps) = manifest.sweep_up(leaves), tree(leaves)
        assert done[(n - 1).bit_length(), 0] == top
        for proof, want in zip(manifest.sweep_down(done, n, 0), steps):
            assert [s[1:] or None for s in proof] == [s for _, s in want]
            assert [s[0] == "L" for s in proof if s != "O"] == [left for left, s in want if s]
