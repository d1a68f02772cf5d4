"""Packing of examples into training sequences: vector bin packing by dot products.

An example is a text's token ids with the end id after them, after its prompt's ids
if it has one (instruction data); only the ids after the prompt bear loss.  A
sequence is a bin with three capacities at once -- tokens, segments (pieces) and
loss-bearing tokens -- and an example a vector of its demands as shares of them.

Dot-product heuristic: one bin is open at a time.  Of the examples that fit all
three capacities, it takes the one whose demand vector has the largest dot product
with what is left of the capacities, each dimension weighted by the mean demand of
the waiting examples.  When nothing fits, the example of the largest product is cut
so that its head fills the bin, unless a piece would be shorter than MIN_PIECE.

Tasks pack the rows of their split as they tokenise them, so neither texts nor ids
are shuffled.  A pool of WINDOW to about twice as many pieces waits for bins; full
pieces of longer texts are sequences at once.  A piece holds a copy of its ids only,
so memory is bounded whatever the texts' lengths.  Sequences are numbered through by
the counts of the tasks before (one row per task, broadcast).

Sequences are padded to the token limit by the trainer, except those whose length is
a power of two.  A bin that closes with more than MIN_PIECE tokens of padding (the
last ones of a task, or those that a limit of segments or loss closes) is therefore
given out as several sequences, its length written as a sum of powers of two.

Defined results: a null or empty text without prompt is just the end id; every id is
in exactly one piece; rows with equal ids are packed each; null ids are kept; an
empty table gives an empty result.  Reruns over the same files agree; other splits
of the input give other, equally valid sequences.
"""

from __future__ import annotations

import sys
import zlib
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinsignal.llm import coder, tokens
from clinsignal.llm.common import store

WINDOW = 2048  # pieces that wait for a bin, at least, while there is input
MIN_PIECE = 32  # no cut leaves a shorter piece; no sequence has more padding


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most; ``tokens`` is a power of two."""

    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


@dataclass
class Piece:
    """A run of one example's ids; ``prompt`` counts its leading ids without loss."""

    ident: Any
    doc_tokens: int
    start: int
    ids: np.ndarray
    prompt: int

    def head(self, n: int) -> Piece:
        return Piece(self.ident, self.doc_tokens, self.start, self.ids[:n], min(self.prompt, n))

    def tail(self, n: int) -> Piece:
        return Piece(self.ident, self.doc_tokens, self.start + n, self.ids[n:].copy(), max(0, self.prompt - n))

    @property
    def loss(self) -> int:
        return len(self.ids) - self.prompt


class Packer:
    """The waiting pieces of one task, and the bins made of them."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.capacity = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.waiting: list[Piece | None] = []
        self.size = np.zeros(0, np.int64)  # 0: no longer waiting
        self.loss = np.zeros(0, np.int64)
        self.left = 0

    def add(self, examples: list[Piece]) -> list[list[Piece]]:
        """Let examples wait, cut to what a bin can hold; full pieces are bins at once."""
        full, new = [], []
        for x in examples:
            while len(x.ids) > self.limits.tokens or x.loss > self.limits.loss:
                n = min(self.limits.tokens, x.prompt + self.limits.loss)
                piece, x = x.head(n), x.tail(n)
                if n == self.limits.tokens:
                    full.append([piece])
                else:
                    new.append(piece)
            (full if len(x.ids) == self.limits.tokens else new).append([x] if len(x.ids) == self.limits.tokens else x)
        kept = np.flatnonzero(self.size)
        self.waiting = [self.waiting[i] for i in kept] + new
        self.size = np.concatenate([self.size[kept], [len(x.ids) for x in new]]).astype(np.int64)
        self.loss = np.concatenate([self.loss[kept], [x.loss for x in new]]).astype(np.int64)
        self.prompt = self.size - self.loss
        self.demand = np.stack([self.size, np.ones(len(self.size)), self.loss], axis=1) / self.capacity
        self.left = len(self.waiting)
        return full

    def _take(self, i: int) -> Piece:
        piece, self.waiting[i] = self.waiting[i], None
        self.size[i] = 0
        self.left -= 1
        return piece

    def _cut(self, i: int, n: int) -> Piece:
        whole = self.waiting[i]
        self.waiting[i] = rest = whole.tail(n)
        self.size[i], self.loss[i], self.prompt[i] = len(rest.ids), rest.loss, rest.prompt
        self.demand[i] = np.array([len(rest.ids), 1, rest.loss]) / self.capacity
        return whole.head(n)

    def bin(self) -> list[Piece]:
        """The next bin, filled from the waiting pieces."""
        tokens, segments, loss = self.limits.tokens, self.limits.segments, self.limits.loss
        weight = self.demand[self.size > 0].mean(axis=0) / self.capacity
        out: list[Piece] = []
        while tokens and segments and self.left:
            product = self.demand @ (weight * (tokens, segments, loss))
            fits = (self.size <= tokens) & (self.loss <= loss) & (self.size > 0)
            i = int(np.argmax(np.where(fits, product, -1.0)))
            if fits[i]:
                piece = self._take(i)
            else:
                # the longest head of each that the bin still holds, and what it leaves
                n = np.minimum(np.minimum(self.size, tokens), self.prompt + loss)
                can = (n >= MIN_PIECE) & (self.size - n >= MIN_PIECE)
                i = int(np.argmax(np.where(can, product, -1.0)))
                if not can[i]:
                    break
                piece = self._cut(i, int(n[i]))
            tokens, segments, loss = tokens - len(piece.ids), segments - 1, loss - piece.loss
            out.append(piece)
        return out


def sequences(pieces: list[Piece], limit: int) -> list[list[Piece]]:
    """A bin as one sequence, or as several whose lengths are powers of two."""
    length = sum(len(p.ids) for p in pieces)
    if limit - length <= MIN_PIECE:
        return [pieces]
    out, queue = [], list(reversed(pieces))
    for bit in reversed(range(length.bit_length())):
        room = length & (1 << bit)
        if room:
            out.append([])
        while room:
            piece = queue.pop()
            if len(piece.ids) > room:
                queue.append(piece.tail(room))
                piece = piece.head(room)
            out[-1].append(piece)
            room -= len(piece.ids)
    return out


def examples(batch: pa.RecordBatch, pieces: tokens.Pieces) -> list[Piece]:
    """The rows of a batch (part, id, text[, prompt]) with their ids."""
    flat, sizes = tokens.tokenise(batch.column(2).cast(pa.string()), pieces)
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    prompts = [flat[:0]] * len(parts)
    if batch.num_columns > 3:
        flat, sizes = tokens.tokenise(batch.column(3).cast(pa.string()), pieces)
        prompts = [p[:-1] for p in np.split(flat, np.cumsum(sizes)[:-1])]
    out = []
    for ident, prompt, ids in zip(batch.column(1).to_pylist(), prompts, parts):
        ids = np.concatenate([prompt, ids]).astype("<u4")
        out.append(Piece(ident, len(ids), 0, ids, len(prompt)))
    return out


COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence", "offset"]


def packing(tokenizer_path: str, limits: Limits, with_ids: bool):
    """mapInArrow kernel: rows of a split -> pieces with their places."""

    def pack(batches):
        pieces, packer, made = tokens.cached_pieces(tokenizer_path), Packer(limits), 0

        def rows(part, id_type, bins):
            nonlocal made
            held = []
            for one in bins:
                for sequence in sequences(one, limits.tokens):
                    offset = 0
                    for p in sequence:
                        held.append((p.ident, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.doc_tokens, p.loss, made, offset, p.ids))
                        offset += len(p.ids)
                    made += 1
            if held:
                ident, *numbers, ids = zip(*held)
                arrays = [pa.array([part] * len(held), pa.int32()), pa.array(ident, id_type), *[pa.array(c, pa.int64()) for c in numbers]]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "id", *COLUMNS, *["ids"] * with_ids])

        part, id_type = 0, pa.int64()
        for batch in batches:
            if not batch.num_rows:
                continue
            part, id_type = batch.column(0)[0].as_py(), batch.schema.field(1).type
            yield from rows(part, id_type, packer.add(examples(batch, pieces)))
            while packer.left >= WINDOW:
                yield from rows(part, id_type, [packer.bin() for _ in range(64) if packer.left >= WINDOW])
        while packer.left:
            yield from rows(part, id_type, [packer.bin() for _ in range(64) if packer.left])

    return pack


def pack_sequences(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    limits: Limits = Limits(),
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all examples: id, start, length, ids_crc32, doc_tokens, loss_tokens,
    sequence_id and offset in it; with ``with_ids`` also the ids themselves."""
    if limits.tokens & (limits.tokens - 1) or min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("limits are positive, that of tokens a power of two")
    rows = docs.select(
        F.spark_partition_id().alias("part"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        *([F.col(prompt_col).alias("prompt")] if prompt_col else []),
    )
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), rows.schema["id"]]
        + [T.StructField(c, T.LongType()) for c in COLUMNS]
        + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids
    )
    placed, _ = store(rows.mapInArrow(packing(tokenizer_path, limits, with_ids), schema), "packing")
    # one row per task
    made = placed.groupBy("part").agg((F.max("sequence") + 1).alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    tasks = made.select("part", before.alias("before"))
    return placed.join(F.broadcast(tasks), "part").select(
        F.col("id").alias(id_col),
        *COLUMNS[:5],
        (F.col("before") + F.col("sequence")).alias("sequence_id"),
        "offset",
        *(["ids"] if with_ids else []),
    )


for _module in (sys.modules[__name__], tokens, coder):
    cloudpickle.register_pickle_by_value(_module)
