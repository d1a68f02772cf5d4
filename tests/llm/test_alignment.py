"""Alignment of two tokenizers: against whole-text tokenisation and literal counting."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from clinsignal.llm import alignment, queries
from tests.llm.conftest import SCHEMA

PATHS = [queries.tokenizer_file(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
PARTS = [
    *" \n\t.,'_-()/", "  ", "\n\n", "\n\n\n", " \n", "\r\n", "a", "b", "The", "don't", "'s", "'tis", "I'll", "é", "ß", "İ", "ﬁ", "中文",
    "\U0001f600", "▁", "\x00", "\x01", "\xa0", " ", "​", "　", "\x85", "\x1c", "...", "!?", "<s>", "</s>", "<|endoftext|>",
    "<0x41>", "12", "3.5", "न", "ि", "é", "http://x.y/z?q=1", "“q”", "¿", "Ⅷ", "²", "٣", "word.Word", "Thatndou",
]


@pytest.fixture(scope="module")
def tools():
    return alignment.Tokenizers(*PATHS)


def literal(tools, text):
    """(A ids, B ids, groups, links) of a whole text."""
    if not text:
        return [], [], "", []
    a, b, raw = tools.encode_a([" " + text])[0], tools.encode_b([text])[0], (" " + text).encode()
    if b"".join(tools.a_bytes[i] for i in a) != raw or b"".join(tools.b_bytes[i] for i in b) != raw:
        return [], [], "", []
    ends_a = np.cumsum([len(tools.a_bytes[i]) for i in a]).tolist()
    ends_b = np.cumsum([len(tools.b_bytes[i]) for i in b]).tolist()
    groups, links, i, j = [], [], 0, 0
    place_a, place_b = ({end: k for k, end in enumerate(ends, 1)} for ends in (ends_a, ends_b))
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = place_a[end], place_b[end]
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        links.append((a[x - 1], b[y - 1]))
        i, j = x, y
    return a, b, ";".join(groups), links


def brute(tools, rows):
    done = [(i, *literal(tools, t)) for i, t in rows]
    count = Counter(link for *_, links in done for link in links)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for ident, a, b, groups, links in done:
        n_best = sum(count[x] == best[x[1]] for x in links)
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((ident, len(a), len(b), len(links), len(links), n_best, sum(count[x] for x in links), sha))
    return sorted(out, key=str), count


def rows_of(frame):
    return sorted([tuple(r) for r in frame.collect()], key=str)


def test_documents_and_pairs(docs, doc_rows, tools):
    found = alignment.Alignment(docs, *PATHS)
    want, count = brute(tools, [(i, t) for i, t, _ in doc_rows])
    assert rows_of(found.documents()) == want
    assert {(r["a"], r["b"]): r["links"] for r in found.pairs.collect()} == dict(count)


def test_edge_rows(edge, tools):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert rows_of(alignment.Alignment(edge, *PATHS).documents()) == brute(tools, rows)[0]


def test_odd_texts(spark, tools):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(14)))) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert rows_of(alignment.Alignment(docs, *PATHS).documents()) == brute(tools, rows)[0]


def test_small_segments_and_forgotten_pieces(spark, tools, monkeypatch):
    monkeypatch.setattr(alignment, "SEGMENT_PIECES", 50)
    monkeypatch.setattr(alignment, "KEPT_PIECES", 30)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(PARTS) for _ in range(rng.randrange(14))) for _ in range(300)]
    work = alignment.aligning(*PATHS)
    batches = [
        pa.RecordBatch.from_arrays([pa.array([0] * 20, pa.int32()), pa.array(range(i, i + 20)), pa.array(texts[i : i + 20])], ["part", "id", "text"])
        for i in range(0, 300, 20)
    ]
    out = list(work(iter(batches)))
    assert len(out) > 15
    count = Counter()
    for s in out:
        exact, pairs = s.column("exact")[0].as_py(), s.column("pairs")[0].as_py()
        count.update({(a, tools.same[a]): n for a, n in zip(exact, s.column("exact_counts")[0].as_py())})
        code = [divmod(p - tools.n_a, tools.n_b) for p in pairs]
        count.update(dict(zip(code, s.column("pair_counts")[0].as_py())))
    alignment._ALIGNERS.clear()
    assert count == brute(tools, enumerate(texts))[1]


def test_more_pairs_than_are_broadcast(spark, docs, tools, monkeypatch):
    monkeypatch.setattr(alignment, "SHARED_PAIRS", 0)
    some = docs.where("length(text) < 2000")
    rows = [tuple(r) for r in some.select("doc_id", "text").collect()]
    found = alignment.Alignment(some, *PATHS)
    assert rows_of(found.documents()) == brute(tools, rows)[0]


def test_repeated_rows_and_one_hot_text(spark, tools):
    rows = [(1, "the same words again and again")] * 3000 + [(None, "others \n\n here"), (2, "the same")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert rows_of(alignment.Alignment(docs, *PATHS).documents()) == brute(tools, rows)[0]


def test_empty(spark, empty):
    found = alignment.Alignment(empty, *PATHS)
    assert found.documents().count() == 0 and found.pairs.count() == 0
    nothing = spark.createDataFrame([(1, None, None, None, None, "k", 0, 0, 0), (2, "", None, None, None, "k", 0, 0, 0)], SCHEMA)
    assert rows_of(alignment.Alignment(nothing, *PATHS).documents()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_identity_map_names_equal_bytes(tools):
    assert len(tools.same) == tools.n_a
    assert all(b < 0 or tools.a_bytes[a] == tools.b_bytes[b] for a, b in enumerate(tools.same))
    assert tools.splits
