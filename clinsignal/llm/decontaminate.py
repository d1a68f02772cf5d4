"""Benchmark decontamination over a distributed positional inverted index.

The training texts are indexed in blocks of documents: a block is one row that
holds, for every term, the positions at which it occurs, and is written to the
shared folder.  Postings never leave their block, so nothing is shuffled.  The
benchmark is a stated query set: its texts are cut into windows of ``WINDOW``
words, each window's terms are ordered by their count over all blocks, and a
block is searched from the rarest term on -- its positions are kept while every
next term has a position in reach (a proximity match: all terms within
``slop`` extra words of the rarest one), then lists adjusted by the terms'
offsets are intersected (an exact phrase match).

The index stores the postings of the query set's vocabulary; other terms cannot
take part in a match.  A query set of more than ``MAX_WORDS`` words is run in
blocks of items, each with an index of its own.

Defined results: a null text has no words and is clean; items without words
are ignored, rows with one item id are one item, a null item id reads ``null``;
an item of fewer than WINDOW words is one window; repeated rows and ids are
reported row by row; empty tables give empty or clean results.
"""

from __future__ import annotations

import sys
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinsignal.llm.common import store, text_key

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after folding A-Z: everything but a-z, 0-9 and non-ASCII
WINDOW = 10
SLOP = 5
MAX_WORDS = 2_000_000
GAP = 64  # positions between documents, more than any reach


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and the number of words of each text."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BREAK)
    flat, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)[full.to_numpy(zero_copy_only=False)]
    return flat.filter(full), np.bincount(owner, minlength=len(sizes)).astype(np.int64)


def indexer(vocabulary_bc):
    """mapInArrow kernel: a batch of (id, text) -> one index block."""

    def index(batches):
        vocabulary = pa.array(vocabulary_bc.value, pa.string())
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, n_words = words(batch.column(1).cast(pa.string()))
            first = np.concatenate([[0], np.cumsum(n_words + GAP)[:-1]])
            place = np.arange(len(flat)) + np.repeat(first - np.concatenate([[0], np.cumsum(n_words)[:-1]]), n_words)
            known = pc.index_in(flat, value_set=vocabulary)
            there = pc.is_valid(known).to_numpy(zero_copy_only=False)
            term, place = known.filter(pc.is_valid(known)).to_numpy(zero_copy_only=False), place[there]
            order = np.argsort(term, kind="stable")
            term, place = term[order], place[order]
            terms, counts = np.unique(term, return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "ids": pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0)),
                    "n_words": pa.array([n_words], pa.list_(pa.int64())),
                    "terms": pa.array([terms], pa.list_(pa.int32())),
                    "counts": pa.array([counts], pa.list_(pa.int32())),
                    "positions": pa.array([place], pa.list_(pa.int64())),
                }
            )

    return index


def windows_of(items: list[tuple[str, list[int]]], size: int) -> dict[tuple[int, ...], list[str]]:
    """Distinct windows of term numbers and the items that hold them."""
    out: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for item, terms in items:
        for i in range(max(1, len(terms) - size + 1)):
            if terms:
                out[tuple(terms[i : i + size])].add(item)
    return {w: sorted(names) for w, names in out.items()}


def plan_windows(windows: dict[tuple[int, ...], list[str]], counts: dict[int, int]):
    """By rarest term: (offset of it, other terms from rare to common, terms by offset, items)."""
    plans: dict[int, list] = defaultdict(list)
    for window, names in windows.items():
        distinct = sorted(set(window), key=lambda t: (counts.get(t, 0), t))
        if counts.get(distinct[0], 0):  # else a term occurs nowhere
            plans[distinct[0]].append((window.index(distinct[0]), distinct[1:], window, names))
    return dict(plans)


def search_block(lists: dict[int, np.ndarray], plans, slop: int):
    """Yields (window length, exact start positions, proximity positions, items)."""
    for rarest in lists.keys() & plans.keys():
        for offset, others, window, names in plans[rarest]:
            near = lists[rarest]
            reach = len(window) - 1 + slop
            for term in others:
                held = lists.get(term)
                if held is None:
                    near = near[:0]
                    break
                at = np.searchsorted(held, near - reach)
                near = near[(at < len(held)) & (held[np.minimum(at, len(held) - 1)] <= near + reach)]
                if not len(near):
                    break
            if not len(near):
                continue
            start = near - offset
            for i, term in enumerate(window):
                held = lists[term]
                at = np.minimum(np.searchsorted(held, start + i), len(held) - 1)
                start = start[held[at] == start + i]
            yield len(window), start, near, names


def searcher(plans_bc, slop: int):
    """mapInArrow kernel: index blocks -> one row per document."""

    def search(batches):
        plans = plans_bc.value
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                n_words = batch.column("n_words")[i].values.to_numpy()
                terms = batch.column("terms")[i].values.to_numpy()
                ends = np.cumsum(batch.column("counts")[i].values.to_numpy())
                places = np.split(batch.column("positions")[i].values.to_numpy(), ends[:-1])
                lists = dict(zip(terms.tolist(), places))
                first = np.concatenate([[0], np.cumsum(n_words + GAP)])
                edge = np.zeros(first[-1] + GAP, np.int32)
                exact, close = defaultdict(set), defaultdict(set)
                for length, start, near, names in search_block(lists, plans, slop):
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + length, -1)
                    for doc in np.unique(np.searchsorted(first, start, "right") - 1).tolist():
                        exact[doc].update(names)
                    for doc in np.unique(np.searchsorted(first, near, "right") - 1).tolist():
                        close[doc].update(names)
                hit = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]])
                opens, closes = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1)
                spans: list[list[dict]] = [[] for _ in range(len(n_words))]
                for a, b, doc in zip(opens.tolist(), closes.tolist(), (np.searchsorted(first, opens, "right") - 1).tolist()):
                    spans[doc].append({"start": a - int(first[doc]), "end": b - int(first[doc])})
                docs = range(len(n_words))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(n_words),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array([sorted(exact[d]) if d in exact else [] for d in docs], pa.list_(pa.string())),
                        pa.array([sorted(close[d]) if d in close else [] for d in docs], pa.list_(pa.string())),
                    ],
                    names=["id", "n_words", "spans", "items", "near_items"],
                )

    return search


def search_items(docs: DataFrame, items: list[tuple[str, list[str]]], window: int, slop: int) -> DataFrame:
    """Index and search one block of the query set (items in memory, bounded)."""
    spark = docs.sparkSession
    vocabulary = sorted({w for _, ws in items for w in ws})
    number = {w: i for i, w in enumerate(vocabulary)}
    id_type = dict(docs.dtypes)["id"]
    blocks = f"ids array<{id_type}>, n_words array<bigint>, terms array<int>, counts array<int>, positions array<bigint>"
    index, _ = store(docs.mapInArrow(indexer(spark.sparkContext.broadcast(vocabulary)), blocks), "positions")
    # one count per term of the query set
    pair = F.explode(F.arrays_zip("terms", "counts")).alias("p")
    counts = {
        r["t"]: r["n"]
        for r in index.select(pair).groupBy(F.col("p.terms").alias("t")).agg(F.sum("p.counts").alias("n")).collect()
    }
    plans = plan_windows(windows_of([(k, [number[w] for w in ws]) for k, ws in items], window), counts)
    found = "n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>, near_items array<string>"
    return index.mapInArrow(searcher(spark.sparkContext.broadcast(plans), slop), f"id {id_type}, {found}")


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words) with the same word rule, natively."""
    fold = F.regexp_replace(
        F.coalesce(F.col(text_col), F.lit("")), BREAK.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60"), " "
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    split = F.filter(F.split(F.translate(fold, upper, lower), " "), lambda w: w != "")
    return items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), split.alias("words"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slop: int = SLOP,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """One row per document: id, n_words, spans (word positions inside exact
    matches, merged), items (exact) and near_items (proximity), as strings."""
    if window - 1 + slop >= GAP:
        raise ValueError(f"window + slop must stay below {GAP}")
    queries, _ = store(item_words(items, item_col, item_text_col).where(F.size("words") > 0), "items")
    total = queries.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, -(-total // max_words))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = []
    for b in range(blocks):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        taken = [(r["item"], r["words"]) for r in part.collect()]
        if blocks > 1:
            # rows are told apart by id and text: equal ones have equal results
            keyed = rows.select(F.struct("id", F.xxhash64("text").alias("th")).alias("id"), "text")
            parts.append(search_items(keyed, taken, window, slop))
        else:
            return search_items(rows, taken, window, slop).withColumnRenamed("id", id_col)
    return merged(parts).withColumnRenamed("id", id_col)


def merged(parts: list[DataFrame]) -> DataFrame:
    """Results of several item blocks as one row per document row."""
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    n = len(parts)
    grouped = out.groupBy(text_key(F.col("id.id")).alias("k"), F.col("id.th").alias("th")).agg(
        F.first("id.id").alias("id"),
        F.first("n_words").alias("n_words"),
        F.count(F.lit(1)).alias("rows"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("all_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("near_items")))).alias("near_items"),
    )
    start = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    joined = F.aggregate(
        "all_spans",
        start,
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["start"].alias("start"),
                        F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    repeated = grouped.withColumn("spans", joined).withColumn("_copy", F.explode(F.sequence(F.lit(1), (F.col("rows") / n).cast("int"))))
    return repeated.select("id", "n_words", "spans", "items", "near_items")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
