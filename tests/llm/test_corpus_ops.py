"""Operators over the whole corpus: mixing, language, copies, shards, token files, pipeline."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clinsignal.llm import coder, exact_dedup, langid, minhash, mixing, queries, sharding, tokens
from tests.llm.conftest import edge_rows

SMALL = "/root/testdata/sf0.001"


# ------------------------------------------------------------------------- mixing
def brute_targets(sizes):
    """Share out by weight, cap, and share the excess again until nothing is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] >= 3 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


def check_mix(rows, out, slack):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = brute_targets(sizes)
    taken = Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack(s, want[s])
    return taken


def test_mix_meets_targets_and_reruns_agree(docs, doc_rows):
    out = mixing.mix(docs).collect()
    check_mix(doc_rows, out, lambda s, t: 0.05 * t)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in out) == sorted((r["doc_id"], r["copies"]) for r in again)


def test_mix_solves_the_dual(docs):
    """Expected tokens at the solved rates equal the targets, and rates are exp(lambda x) cut at 3."""
    by_source = defaultdict(list)
    for r in mixing.mix(docs).collect():
        by_source[r["source"]].append(r)
    for rows in by_source.values():
        assert sum(r["size"] * r["rate"] for r in rows) == pytest.approx(rows[0]["target"], rel=1e-6)
        free = [r for r in rows if 0 < r["rate"] < 3 and r["size"]]
        slopes = [np.log(r["rate"]) / r["size"] for r in free]
        assert not slopes or np.ptp(slopes) <= 1e-9 + 1e-6 * abs(np.mean(slopes))


def test_mix_edges(edge, empty):
    rows = [(r[0], r[1], r[3]) for r in edge_rows()]
    out = mixing.mix(edge).collect()
    assert len(out) == len(rows)
    longest = max(r["size"] for r in out)
    check_mix(rows, out, lambda s, t: 1.5 * longest)
    assert mixing.mix(empty).count() == 0


# ------------------------------------------------------------------------ language
def test_language_held_out_accuracy(spark, sf_oracle, docs):
    labels = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.select("doc_id", "lang", "text").collect()}
    out = queries.op3_language(spark, sf_oracle).collect()
    assert len(out) == len(labels)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    held = [r for r in out if r["held_out"] and langid.has_letter(labels[r["doc_id"]][1])]
    right = sum(r["lang_pred"] == labels[r["doc_id"]][0] for r in held)
    assert right >= 0.98 * len(held) and all(0 <= r["score"] <= 1 for r in out)


def test_language_edges(spark, docs, edge, empty):
    model = langid.train(docs, epochs=2)
    out = langid.identify(edge, model).collect()
    assert len(out) == len(edge_rows())
    for r in out:
        assert (r["lang_pred"] == "und") == (not langid.has_letter(r["text"]))
        assert r["lang_pred"] != "und" or r["score"] == 0
    assert langid.train(empty) is None
    assert langid.identify(empty, None).count() == 0
    assert {r["lang_pred"] for r in langid.identify(edge, None).select("lang_pred").collect()} == {"und"}


def test_every_byte_is_in_one_window():
    buffer = np.frombuffer(b"Ab" * 700, np.uint8)
    first, owner, size = langid.places(np.array([0, 0, 300, 301]), np.array([0, 300, 301, 1400]))
    assert Counter(owner.tolist()) == {1: 2, 2: 1, 3: 5} and size.sum() == 1400
    assert bytes(langid.cut(buffer, first, size)[0]) == b"ab" * 128


# ---------------------------------------------------------------------- exact copies
def brute_copies(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            out[(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("filter_bytes", [exact_dedup.FILTER_BYTES, exact_dedup.SEGMENT_BYTES])
def test_exact_groups_against_brute_force(spark, edge, docs, doc_rows, filter_bytes):
    got = Counter(tuple(r) for r in exact_dedup.exact_groups(edge, filter_bytes=filter_bytes).collect())
    assert got == brute_copies(edge_rows())
    got = Counter(tuple(r) for r in exact_dedup.exact_groups(docs, filter_bytes=filter_bytes).collect())
    assert got == brute_copies(doc_rows)


def test_filter_passes_unique_rows_and_never_a_repeated_one(spark):
    rows = [(i, hashlib.sha256(str(i if i % 5 else i % 100).encode()).hexdigest()) for i in range(30_000)]
    frame = spark.createDataFrame(rows, "id bigint, sha string").repartition(9)
    marked = exact_dedup.possibly_repeated(frame, len(rows), 2 * exact_dedup.SEGMENT_BYTES).collect()
    times = Counter(sha for _, sha in rows)
    assert len(marked) == len(rows)
    assert all(r["maybe"] for r in marked if times[r["sha"]] > 1)
    unique = [r["maybe"] for r in marked if times[r["sha"]] == 1]
    assert sum(unique) < 0.05 * len(unique)


def test_exact_groups_of_an_empty_table(empty):
    assert exact_dedup.exact_groups(empty).count() == 0


# -------------------------------------------------------------------------- shards
def check_shards(rows, out, shards):
    assert len(out) == len(rows)
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_are_even_and_gapless(spark, edge, empty, docs, doc_rows):
    check_shards(edge_rows(), sharding.shard_rows(edge, 4).collect(), 4)
    out = sharding.shard_rows(docs, 16).collect()
    check_shards(doc_rows, out, 16)
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_rows(docs.repartition(5), 16).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in out}
    assert sharding.shard_rows(empty, 4).count() == 0


def test_hot_ring_position_is_split(spark):
    rows = [(7, f"text {i}") for i in range(3000)] + [(i, "x") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    check_shards(rows, sharding.shard_rows(frame, 5).collect(), 5)


def test_walk_covers_ranks_and_moves_little():
    rng = np.random.default_rng(3)
    counts = {int(p): int(n) for p, n in zip(rng.choice(sharding.RING, 5000, False), rng.integers(1, 9, 5000))}

    def owners(shards):
        out = {}
        for pos, first, n, shard in sharding.walk(counts, shards):
            for rank in range(first, first + n):
                assert (pos, rank) not in out
                out[pos, rank] = shard
        return out

    a, b = owners(16), owners(17)
    assert len(a) == sum(counts.values()) == len(b)
    # a new shard needs a seventeenth of the rows; plain modulo would move sixteen
    assert sum(a[k] != b[k] for k in a) < 0.45 * len(a)


# ----------------------------------------------------------------------- near copies
def shingles(text, width):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", folded) if x]
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def test_components_that_have_not_settled_are_an_error(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)], "u bigint, v bigint")
    with pytest.raises(RuntimeError, match="not settled"):
        minhash.components(links, max_rounds=1)
    assert {r["comp"] for r in minhash.components(links).collect()} == {0}


def brute_components(rows, width=2):
    sets = {d: shingles(t, width) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    shared = Counter()
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_near_groups_against_brute_force(docs, doc_rows):
    short = [(d, t) for d, t, _ in doc_rows if len(t) < 6000]
    frame = docs.where(F.length("text") < 6000)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_groups(frame, width=2).collect()}
    assert got == brute_components(short)


def test_near_groups_of_a_chain_and_a_large_group(spark):
    base = [f"w{i}" for i in range(100)]
    chain = [(i, " ".join(base[: 100 - 5 * i] + [f"c{j}" for j in range(5 * i)])) for i in range(8)]
    rng = np.random.default_rng(5)
    group = []
    for i in range(150):
        words = [f"g{j}" for j in range(80)]
        for j in rng.choice(80, int(rng.integers(0, 7)), False):
            words[j] = f"x{i}_{j}"
        group.append((1000 + i, " ".join(words)))
    rows = chain + group + [(5000 + i, group[0][1]) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_groups(frame, width=2).collect()}
    assert got == brute_components(rows)


def test_near_groups_edges(edge, empty):
    out = minhash.near_groups(edge, width=2).collect()
    assert len(out) == len(edge_rows())
    by_id = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert by_id[5]["component_id"] == by_id[6]["component_id"] == 5
    assert by_id[8]["component_id"] == 7 and not by_id[8]["kept"]
    assert all(by_id[i]["kept"] and by_id[i]["n_shingles"] == 0 for i in (1, 2, 3))
    assert by_id[4]["n_shingles"] == 1
    assert all(r["kept"] for r in out if r["doc_id"] is None)
    assert minhash.near_groups(empty, width=2).count() == 0


def test_signature_is_circulant_minhash():
    s = np.random.default_rng(0).integers(0, 1 << 63, 500).astype(np.uint64)
    sigma = minhash.permute32((s >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995)).astype(np.int64)
    sig = minhash.signature(s, 20)
    for k in range(20):
        assert sig[k] == minhash.permute32(((sigma - k) % (1 << 32)).astype(np.uint32)).min()


def test_parity_sketches_never_count_more_than_the_sets_differ_in():
    rng = np.random.default_rng(4)
    for n in (1, 5, 150, 4000):
        pool = np.unique(rng.integers(0, 1 << 63, 2 * n).astype(np.uint64))
        for share in (0.0, 0.1, 0.5):
            a = pool[:n]
            b = np.unique(np.concatenate([a[int(share * n) :], pool[n : n + int(share * n)]]))
            ones = np.unpackbits((minhash.parity_sketch(a) ^ minhash.parity_sketch(b)).view(np.uint8)).sum()
            assert ones <= len(np.setxor1d(a, b))
    assert not minhash.parity_sketch(np.zeros(0, np.uint64)).any()


# ------------------------------------------------------------------------ token files
def test_coder_round_trips():
    rng = np.random.default_rng(1)
    for ids in (
        np.zeros(0, int),
        np.array([5]),
        np.zeros(5000, int),
        rng.integers(0, coder.MAX_ID, 3 * coder.BLOCK + 17),
        np.tile(rng.integers(0, 49_408, 300), 20),
        (rng.zipf(1.3, 40_000) % 49_408),
    ):
        assert (coder.decode(coder.encode(ids)) == ids).all()
    assert len(coder.encode(np.tile(rng.integers(0, 49_408, 300), 20))) < 2 * 6000 / 2


def test_coder_notices_damage_and_keeps_other_blocks():
    ids = np.random.default_rng(2).integers(0, 49_408, 3 * coder.BLOCK)
    data = bytearray(coder.encode(ids))
    first = coder.split_blocks(bytes(data))[0]
    data[12 + len(first[2]) // 2] ^= 1
    with pytest.raises(coder.Damaged):
        coder.decode(bytes(data))
    rest = bytes(data[12 + len(first[2]) :])
    assert (coder.decode(rest) == ids[coder.BLOCK :]).all()
    with pytest.raises(coder.Damaged):
        coder.decode(rest[:-3])
    with pytest.raises(ValueError):
        coder.encode(np.array([coder.MAX_ID]))


def brute_tokens(rows):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(queries.tokenizer_file())
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array(tk.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


ODD = ["é ́x <|endoftext|>a'S don't  \u0085x　y", "ẞİΣς Å\n̊", "a​﻿b\x1cc\x00d 12½٣"]


def test_token_files_against_the_library(spark, docs, doc_rows, edge):
    for frame, rows in ((docs, sorted((d, t) for d, t, _ in doc_rows)),):
        _, path = tokens.write_tokens(frame, queries.tokenizer_file())
        assert sorted(tuple(r) for r in tokens.read_tokens(spark, path).collect()) == brute_tokens(rows)
    odd = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    _, path = tokens.write_tokens(odd, queries.tokenizer_file())
    got = sorted(tuple(r) for r in tokens.read_tokens(spark, path, with_ids=True).collect())
    assert [g[:4] for g in got] == brute_tokens(list(enumerate(ODD)))


def test_pieces_are_the_tokens_of_whole_texts():
    """Every Latin letter before and after every ASCII mark, random mixes, names of special tokens."""
    draw = random.Random(5)
    parts = [*"aZé,.;:!?'\"<|>$()=\0\t\x1f\x85\xa0\u0301\u0338İſ中9", "'s", "'LL,", "<|startoftext|>", "<|STARTOFTEXT|>", "ΑΣ.", " "]
    texts = ["".join(draw.choices(parts, k=draw.randrange(20))) for _ in range(3000)]
    texts += [chr(c) + "".join(m + chr(c) for m in map(chr, range(33, 127))) for c in range(1, 0x250)]
    pieces = tokens.Pieces(queries.tokenizer_file())
    for _ in range(2):  # learned, then known
        got, sizes = tokens.tokenise(pa.array(texts), pieces)
        for text, ids in zip(texts, np.split(got, np.cumsum(sizes)[:-1])):
            assert ids.tolist() == [*pieces.tokenizer.encode(text, add_special_tokens=False).ids, tokens.END_ID], text


def test_token_files_edges(spark, edge, empty):
    _, path = tokens.write_tokens(edge, queries.tokenizer_file())
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in tokens.read_tokens(spark, path).collect())
    want = Counter((d, n, c) for d, _, n, c in brute_tokens([(r[0], r[1]) for r in edge_rows()]))
    assert got == want
    starts = sorted((r["start"], r["n_tokens"]) for r in tokens.read_tokens(spark, path).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    _, path = tokens.write_tokens(empty, queries.tokenizer_file())
    assert tokens.read_tokens(spark, path).count() == 0


def test_coder_learns_a_chunk_at_a_time(monkeypatch):
    calls, learn = [], coder.Model.learn
    monkeypatch.setattr(coder.Model, "learn", lambda *a: (calls.append(1), learn(*a))[1])
    ids = np.random.default_rng(3).zipf(1.3, 3 * coder.BLOCK + 100) % 49_408
    data = coder.encode(ids)
    assert len(calls) <= coder.BLOCK // 16
    assert (coder.decode(data) == ids).all() and len(calls) <= 2 * coder.BLOCK // 16


def test_known_pieces_outlive_a_task(spark):
    """Tasks get the module by value, but a worker's tasks share one table: it grows from task to task."""
    cached, path = tokens.cached_pieces, queries.tokenizer_file()

    def sizes(batches):
        for batch in batches:
            table = cached(path)
            table.numbers([f"piece{x}" for x in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "size": [len(table.known)]})

    rows = spark.range(0, 40, 1, 40).mapInArrow(sizes, "pid bigint, size bigint").collect()
    assert len({(r["pid"], r["size"]) for r in rows}) == len(rows) == 40


def test_a_full_table_keeps_the_pieces_of_most_batches(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 100)
    pieces, new = tokens.Pieces(queries.tokenizer_file()), []
    learn = pieces._learn
    monkeypatch.setattr(pieces, "_learn", lambda texts: (new.extend(texts), learn(texts))[1])
    common = [f"{a}{b}" for a in "abcdé" for b in "fghij"]
    for i in range(20):
        batch = common + [f"{c}x{i}" for c in "klmnopq"]
        found = pieces.numbers(batch)
        starts = np.cumsum(pieces.sizes) - pieces.sizes
        for text, n in zip(batch, found.tolist()):
            want = pieces.tokenizer.encode(text, add_special_tokens=False).ids
            assert pieces.flat[starts[n] : starts[n] + pieces.sizes[n]].tolist() == want
    assert sum(p in common for p in new) == len(common) and len(pieces.known) <= 110


def test_segments_are_filled_across_batches(monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT_IDS", 50)
    texts = ["a b c d e f g h i"] * 17  # ten ids each
    batches = [
        pa.RecordBatch.from_arrays([pa.array([3] * len(t), pa.int32()), pa.array(range(len(t))), pa.array(t)], names=["shard", "id", "text"])
        for t in (texts[i : i + 3] for i in range(0, 17, 3))
    ]
    out = list(tokens.writer(queries.tokenizer_file())(iter(batches)))
    assert [b["n_ids"][0].as_py() for b in out] == [50, 50, 50, 20]
    assert [b["at"][0].as_py() for b in out] == [0, 50, 100, 150]


# -------------------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, sf_oracle, docs, edge):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontaminate", "mix_sources", "token_files"]
    stage = dict(corpus_pipeline.STAGES)
    columns = docs.columns
    total = docs.count()
    spoken = stage["language_id"](spark, docs, sf_oracle)
    assert spoken.columns == columns and spoken.count() >= 0.99 * total
    single = stage["near_dedup"](spark, docs, sf_oracle)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"]) < 6000]
    kept = {r["doc_id"] for r in single.collect()}
    want = {d for d, (_, c) in brute_components(rows, 5).items() if d == c}
    assert single.columns == columns and {d for d, _ in rows} & kept == want
    clean = stage["decontaminate"](spark, docs, sf_oracle)
    hits = {r["doc_id"] for r in queries.op1_decontaminate(spark, sf_oracle).where("contaminated").collect()}
    assert {r["doc_id"] for r in clean.collect()} == {d for d, *_ in docs.select("doc_id").collect()} - hits
    mixed = stage["mix_sources"](spark, docs, sf_oracle)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    got = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert mixed.columns == columns and max(got.values()) <= 3
    assert abs(sum(got.values()) - sum(copies.values())) <= 0.1 * total


def test_pipeline_stages_on_edge_cases(spark, sf_oracle, edge, empty):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge, sf_oracle)
        assert name == "token_files" or out.columns == edge.columns
        out.count()
        if name != "language_id":
            assert stage(spark, empty, sf_oracle).count() == 0
    single = dict(corpus_pipeline.STAGES)["near_dedup"](spark, edge, sf_oracle).collect()
    assert sum(r["text"] == "same text twice over and over again" for r in single) == 1


def test_pipeline_query(spark):
    assert corpus_pipeline.run(spark, SMALL).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
