"""Token files: texts as ids of a public tokenizer, in range-coded blocks.

Documents are range-partitioned and sorted by id; a partition is a shard.  Every
task tokenises its documents with the tokenizers library, appends the end id to
each and writes segments: a row with the documents' ids and lengths and their
concatenated token ids as independently reset, checksummed blocks of the
context-mixing coder (``coder``).  A document is never split over segments; a
segment holds about SEGMENT_IDS ids or one longer document.

The tokenizer's rules never look across ASCII white space nor from a letter to
the comma or full stop after it, and lower-case what they read, so a task
tokenises each distinct lower-cased piece once and puts texts together from the
pieces' ids; pieces seen before are kept in a bounded table, the half that most
batches held when it is full.  Words of Latin-1 letters go to the tokenizer's
model without the rules that come before it, which leave them as they are.

Reading back decodes every block, checks it, and cuts the stream at the stored
lengths.  A document's position in the whole corpus is its position in the
shard plus the sizes of the shards before it (one row per shard).

Defined results: a null or empty text is just the end id; rows with equal ids
are ordered by text and all written; null ids come first; an empty table gives
an empty result.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinsignal.llm import coder
from clinsignal.llm.common import store

END_ID = 2
SEGMENT_IDS = 1 << 22
KEPT_PIECES = 400_000  # pieces whose ids a Python worker keeps between batches
JOINED, WORDS = 64, 1024  # new pieces, and new words, tokenised as one text
MARK = "\0"
# Latin letters whose lower case is one letter, and ASCII marks that start no contraction
LETTERS = r"a-zA-ZÀ-ÖØ-öø-\x{12F}\x{131}-\x{24F}"
PUNCTUATION = r"""!"#$%&()*+,\-./:;=?@\[\\\]^_`{}~"""
# a lower-cased piece of these letters is one word to the tokenizer, and stays as it is
WORD = re.compile("[a-zß-öø-ÿ]+").fullmatch
TOKENIZER = "word_bpe_49k.json"


class Pieces:
    """Ids of pieces, each tokenised once; the table of known pieces is bounded."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self._words(Tokenizer)
        self.clear()

    def _words(self, kind) -> None:
        """The same model for runs of WORD letters: the rules before it leave those whole and as they are.

        Its last token of a word has a name of its own, so words are told apart without marks.
        """
        rules = json.loads(self.tokenizer.to_str())
        end = rules["model"].get("end_of_word_suffix")
        self.words = None
        if end:
            steps = [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
            rules |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}, "added_tokens": []}
            self.words = kind.from_str(json.dumps(rules))
            vocab = rules["model"]["vocab"]
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for name, i in vocab.items() if name.endswith(end)]] = True

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.met = np.zeros(0, np.int64)  # batches that held the piece

    def _forget(self) -> None:
        """Keep the half of the table that most batches held."""
        kept = np.sort(np.argsort(-self.met, kind="stable")[: KEPT_PIECES // 2])
        pieces = list(self.known)  # numbered as they were put in
        starts = np.cumsum(self.sizes) - self.sizes
        self.known = {pieces[i]: n for n, i in enumerate(kept.tolist())}
        self.flat = gather(self.flat, starts[kept], self.sizes[kept])
        # what was met long ago counts less and less
        self.sizes, self.met = self.sizes[kept], self.met[kept] >> 1

    @staticmethod
    def _encode(tokenizer, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Tokenise pieces, many in one call; words as such, others with a mark after each.

        The mark is a code point that no other text contains bytes of, so its id
        stands for nothing else; pieces that hold it are tokenised alone.
        """
        plain = [p for p in new if WORD(p)] if self.words is not None else []
        rest = [p for p in new if not WORD(p)] if self.words is not None else new
        alone = rest if self.mark is None else [p for p in rest if MARK in p]
        joint = [] if self.mark is None else [p for p in rest if MARK not in p]
        flat, sizes = [self.flat], [self.sizes]
        for ids in self._encode(self.words, [" ".join(plain[i : i + WORDS]) for i in range(0, len(plain), WORDS)]):
            flat.append(ids)
            sizes.append(np.diff(np.flatnonzero(self.last[ids]), prepend=-1))
        runs = [joint[i : i + JOINED] for i in range(0, len(joint), JOINED)]
        for ids in self._encode(self.tokenizer, [f" {MARK} ".join([*run, ""]) for run in runs]):
            ends = np.flatnonzero(ids == self.mark)
            flat.append(ids[ids != self.mark])
            sizes.append(np.diff(ends, prepend=-1) - 1)
        for ids in self._encode(self.tokenizer, alone):
            flat.append(ids)
            sizes.append(np.array([len(ids)], np.int64))
        self.known.update(zip((*plain, *joint, *alone), count(len(self.known))))
        self.flat, self.sizes = np.concatenate(flat), np.concatenate(sizes)
        self.met = np.append(self.met, np.zeros(len(new), np.int64))
        if len(self.sizes) != len(self.known) or self.sizes.sum() != len(self.flat):
            raise ValueError("the tokenizer does not keep the pieces apart")

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """Number of every (distinct) piece; ids of number i are its run of ``flat``."""
        if len(self.known) > KEPT_PIECES:
            self._forget()
        found = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(found < 0)
        if len(new):
            texts = [pieces[i] for i in new.tolist()]
            self._learn(texts)
            found[new] = [self.known[p] for p in texts]
        self.met[found] += 1
        return found


def split_pieces(texts: pa.Array) -> pa.Array:
    """Pieces of every text whose ids, one after the other, are those of the text.

    White space always parts words, and so does the step from one of LETTERS to
    one of PUNCTUATION; ASCII capitals are lower-cased by the tokenizer itself.
    Texts that may hold a special token's name are only cut at white space.
    """
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), f"([{LETTERS}])([{PUNCTUATION}])", r"\1 \2")
    named = pc.match_substring(texts, "<|")
    return pc.ascii_split_whitespace(pc.if_else(named, texts, plain) if pc.any(named).as_py() else plain)


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + size], one after the other."""
    total = int(sizes.sum())
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    shift += np.arange(total)
    return flat.take(shift)


def tokenise(texts: pa.Array, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all the texts with the end id after each, and the number of ids of each."""
    parts = split_pieces(pc.fill_null(texts, ""))
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    numbers = pieces.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    which = numbers[coded.indices.to_numpy(zero_copy_only=False)]
    # the end id is one more piece, put after the pieces of every text
    sizes, flat = np.append(pieces.sizes, 1), np.append(pieces.flat, np.int32(END_ID))
    ends = np.cumsum(counts)
    which = np.insert(which, ends, len(sizes) - 1)
    starts = np.cumsum(sizes) - sizes
    run = sizes[which]
    done = np.concatenate([[0], np.cumsum(run)])
    edge = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
    return gather(flat, starts[which], run).astype(np.int32), np.diff(done[edge])


def cached_pieces(path: str) -> Pieces:
    """The table of this Python worker: this module goes to the tasks by value and begins
    anew with each of them, so the table is kept where it outlives the task."""
    kept = sys.__dict__.setdefault("_clinsignal_pieces", {})
    if path not in kept:
        kept[path] = Pieces(path)
    return kept[path]


def segments(n_ids: np.ndarray) -> list[tuple[int, int]]:
    """Runs of documents of about SEGMENT_IDS ids."""
    out, first, held = [], 0, 0
    for i, n in enumerate(n_ids.tolist()):
        if held and held + n > SEGMENT_IDS:
            out.append((first, i))
            first, held = i, 0
        held += n
    if first < len(n_ids):
        out.append((first, len(n_ids)))
    return out


def writer(tokenizer_path: str):
    """mapInArrow kernel: (shard, id, text) in order -> segments."""

    def pack(shard, at, ids, tokens, n_ids):
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()),
                pa.array([at], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([n_ids], pa.list_(pa.int64())),
                pa.array([len(tokens)], pa.int64()),
                pa.array([coder.encode(tokens)], pa.binary()),
            ],
            names=["shard", "at", "ids", "lengths", "n_ids", "blocks"],
        )

    def write(batches):
        pieces = cached_pieces(tokenizer_path)
        shard, at, held = 0, 0, []

        def flush(last: bool):
            """Write whole segments; what does not fill one is held, unless it is the last."""
            nonlocal at, held
            ids = pa.concat_arrays([h[0] for h in held])
            tokens = np.concatenate([h[1] for h in held])
            n_ids = np.concatenate([h[2] for h in held])
            held = []
            edge = np.concatenate([[0], np.cumsum(n_ids)])
            for a, b in segments(n_ids):
                if b == len(n_ids) and not last:
                    held = [(ids.slice(a), tokens[edge[a] :].copy(), n_ids[a:])]
                    return
                yield pack(shard, at, ids.slice(a, b - a), tokens[edge[a] : edge[b]], n_ids[a:b])
                at += int(edge[b] - edge[a])

        # batches are gathered to whole segments: more blocks are coded in step
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column(0)[0].as_py()
            held.append((batch.column(1), *tokenise(batch.column(2).cast(pa.string()), pieces)))
            if sum(len(h[1]) for h in held) > SEGMENT_IDS:
                yield from flush(False)
        if held:
            yield from flush(True)

    return write


def write_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """Write the documents as a token table; returns (table, path)."""
    id_type = dict(docs.dtypes)[id_col]
    ordered = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange(F.col("id").asc_nulls_first())
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
        .select(F.spark_partition_id().alias("shard"), "id", "text")
    )
    schema = f"shard int, at bigint, ids array<{id_type}>, lengths array<bigint>, n_ids bigint, blocks binary"
    return store(ordered.mapInArrow(writer(tokenizer_path), schema), "tokens")


def reader(with_ids: bool):
    """mapInArrow kernel: segments -> one row per document."""

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                lengths = batch.column("lengths")[i].values.to_numpy()
                tokens = coder.decode(batch.column("blocks")[i].as_py()).astype("<u4")
                edge = np.concatenate([[0], np.cumsum(lengths)])
                if edge[-1] != len(tokens):
                    raise coder.Damaged("lengths do not add up to the ids of the segment")
                parts = [tokens[a:b] for a, b in zip(edge[:-1], edge[1:])]
                columns = {
                    "id": batch.column("ids")[i].values,
                    "shard": pa.array(np.full(len(parts), batch.column("shard")[i].as_py()), pa.int32()),
                    "at": pa.array(batch.column("at")[i].as_py() + edge[:-1], pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                }
                if with_ids:
                    columns["tokens"] = pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return read


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Decode a token table: id, start, n_tokens, ids_crc32 and, if asked, the ids."""
    table = spark.read.parquet(path)
    id_type = dict(table.dtypes)["ids"][len("array<") : -1]
    schema = f"id {id_type}, shard int, at bigint, n_tokens bigint, ids_crc32 bigint"
    rows = table.mapInArrow(reader(with_ids), schema + (", tokens array<bigint>" if with_ids else ""))
    # one row per shard; shards are numbered in id order
    before = F.coalesce(F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards = table.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", before.alias("before"))
    return rows.join(F.broadcast(shards), "shard").select(
        F.col("id").alias(id_col),
        (F.col("before") + F.col("at")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["tokens"] if with_ids else []),
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(coder)
