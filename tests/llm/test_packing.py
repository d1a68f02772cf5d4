"""Packing: every id in one piece, all limits kept, little padding."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from clinsignal.llm import packing, queries
from clinsignal.llm.packing import Limits

END = np.array([2], "<u4")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.tokenizer_file())


def ids_of(tokenizer, text):
    ids = tokenizer.encode(text, add_special_tokens=False).ids if text else []
    return np.array(ids, "<u4")


def check(out, want, limits):
    """want: per id the (prompt size, ids) of its rows.  Returns the share of padding."""
    at, seqs = defaultdict(list), defaultdict(list)
    for r in out:
        at[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append(r)
    assert set(at) == set(want)
    for ident, rows in at.items():
        left = [[prompt, ids, 0] for prompt, ids in want[ident]]
        for r in sorted(rows, key=lambda r: r["start"]):
            a, b = r["start"], r["start"] + r["length"]
            fits = [x for x in left if x[2] == a and len(x[1]) == r["doc_tokens"] and zlib.crc32(x[1][a:b].tobytes()) == r["ids_crc32"]]
            assert fits
            assert r["loss_tokens"] == max(0, b - max(a, fits[0][0]))
            fits[0][2] = b
        assert all(x[2] == len(x[1]) for x in left)
    assert sorted(seqs) == list(range(len(seqs)))
    padding = total = 0
    for rows in seqs.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == np.cumsum([0] + [r["length"] for r in rows])[:-1].tolist()
        length = sum(r["length"] for r in rows)
        assert 0 < length <= limits.tokens and len(rows) <= limits.segments
        assert sum(r["loss_tokens"] for r in rows) <= limits.loss
        padding += limits.tokens - length if length & (length - 1) else 0
        total += length
    return padding / max(total, 1)


def wanted(tokenizer, rows):
    want = defaultdict(list)
    for ident, prompt, text in rows:
        lead = ids_of(tokenizer, prompt)
        want[ident].append((len(lead), np.concatenate([lead, ids_of(tokenizer, text), END])))
    return want


def test_documents(spark, docs, doc_rows, sf_oracle, tokenizer):
    out = queries.op12_packing(spark, sf_oracle).collect()
    want = wanted(tokenizer, [(i, None, t) for i, t, _ in doc_rows])
    assert check(out, want, Limits()) < 0.002


def test_edge_rows(edge, tokenizer):
    out = packing.pack_sequences(edge, queries.tokenizer_file()).collect()
    want = wanted(tokenizer, [(r["doc_id"], None, r["text"]) for r in edge.collect()])
    check(out, want, Limits())


def test_empty(empty):
    assert packing.pack_sequences(empty, queries.tokenizer_file()).count() == 0


@pytest.mark.parametrize(
    "limits", [Limits(256, 256, 64), Limits(512, 4, 512), Limits(1024, 16, 300), Limits(64, 64, 64)], ids=str
)
def test_instructions_under_three_limits(spark, limits, tokenizer):
    rng = random.Random(5)
    words = ["when", "the", "patient", "took", "aspirin", "twice", "daily", "report", "signal"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(60))), " ".join(rng.choices(words, k=rng.randrange(200)))) for i in range(600)]
    rows += [(1000, "x " * 3000, "short"), (1001, "", "y " * 5000), (1002, None, None), (1002, "again", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, prompt string, text string").repartition(3)
    out = packing.pack_sequences(docs, queries.tokenizer_file(), prompt_col="prompt", limits=limits).collect()
    check(out, wanted(tokenizer, rows), limits)


def test_many_tiny_texts_need_no_padding(spark, tokenizer):
    rows = [(i, None if i % 2 else "a b c") for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = packing.pack_sequences(docs, queries.tokenizer_file()).collect()
    assert check(out, wanted(tokenizer, [(i, None, t) for i, t in rows]), Limits()) < 0.02


def test_reruns_agree_and_ids_are_those_packed(docs):
    path = queries.tokenizer_file()
    out = sorted(packing.pack_sequences(docs, path, with_ids=True).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    again = sorted(packing.pack_sequences(docs, path).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    for r, s in zip(out, again, strict=True):
        assert all(r[c] == s[c] for c in s.__fields__)
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]


def test_largest_dot_product_goes_first():
    def piece(ident, n, prompt=0):
        return packing.Piece(ident, n, 0, np.zeros(n, "<u4"), prompt)

    packer = packing.Packer(Limits(1024, 4, 512))
    assert packer.add([piece("a", 500, 400), piece("b", 400, 0), piece("c", 120, 120)]) == []
    # brute force: at every step the fitting piece of the largest weighted product
    names = [p.ident for p in packer.bin()]
    demand = {"a": (500 / 1024, 0.25, 100 / 512), "b": (400 / 1024, 0.25, 400 / 512), "c": (120 / 1024, 0.25, 0)}
    mean = [sum(v[d] for v in demand.values()) / 3 for d in range(3)]
    left, order = [1.0, 1.0, 1.0], []
    while demand:
        best = max(demand, key=lambda k: sum(m * v * x for m, v, x in zip(mean, demand[k], left)))
        order.append(best)
        left = [x - v for x, v in zip(left, demand.pop(best))]
    assert names == order
