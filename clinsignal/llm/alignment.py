"""Alignment of two tokenizers' ids over a corpus, with an identity-map fast path.

Every text is tokenised by A (byte-level BPE) and by B (sentencepiece).  Byte offsets
at which a token of A and one of B both end cut the tokens into groups; the last A
and the last B token of a group end together and are a link.  The corpus-wide count
of a pair of ids is the number of its links; a document's links are judged by them.

Identity map: an array from each A id to the B id of the same bytes.  A group of one
A and one B token whose ids the map names is exact; such groups are counted in a
vector as long as A's vocabulary.  Only the links of the other, irregular groups are
pairs that need a shuffle, pre-counted per segment (a run of documents of one task),
so a pair has at most one row per segment and no key is hot.

Texts are split where neither tokenizer's tokens reach across: before a single blank
between two visible characters, between a Latin letter and an ASCII mark after it,
and around one or two newlines between visible characters.  Each distinct
piece is tokenised and aligned once; what is known is kept in a bounded table.  The split is used only if B's vocabulary allows it
(no piece joins a letter and a mark, holds a newline, or a blank after another
character), else pieces are whole texts.

A segment's documents are written as lists of piece numbers; a second pass gets the
corpus-wide counts of the segment's pairs and sums per document.  Up to SHARED_PAIRS
pairs are broadcast after they have been counted; more are joined to the segments.
The counts per A id and the best count per B id are vocabulary-length arrays.

Defined results: null and empty texts, and texts whose tokens do not give back a
blank and the text (as those with U+2581), have no tokens: zeros and ''.  Rows with
equal ids are rows of their own, null ids are kept; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterable
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinsignal.llm import coder, tokens
from clinsignal.llm.common import store
from clinsignal.llm.tokens import gather

SEGMENT_PIECES = 1 << 17  # piece occurrences of a segment, or one longer document
SLICE_BYTES = 1 << 21  # text that a task cuts into pieces at once
SHARED_PAIRS = 1 << 20  # irregular pairs whose counts (16 MB) are broadcast; more are joined
KEPT_PIECES = 120_000  # pieces that a Python worker keeps between the batches of a task
JOINED = 64  # new pieces tokenised as one text

BLANK = "▁"
LETTERS = "a-zA-ZÀ-ÖØ-öø-ɏ"  # Latin letters
MARKS = r"!-/:-@\[-`{-~"  # ASCII punctuation
SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"  # anything that may count as white space
VISIBLE = f"[^{SPACE}]"
UNEVEN = f"^[{SPACE}]|[{SPACE}]$| [{SPACE}]|[{SPACE}] |\x01"  # a blank that is not single or not inside
LETTER_MARK = f"([{LETTERS}])([{MARKS}])"
NEWLINES = f"({VISIBLE})(\n)(\n?)({VISIBLE})"
#: the same bounds for texts with other blanks, where Python's regular expressions look around
BOUND = re.compile(
    rf"(?<=\S)(?= \S)|(?<=[{LETTERS}])(?=[{MARKS}])"
    r"|(?<=\S)(?=\n\n?\S)|(?<=\S\n)(?=\n?\S)|(?<=\S\n\n)(?=\S)"
)
SIMPLE = re.compile(r" ?\S+\Z")  # no white space but a blank in front
CUT = b"\xff"  # in no UTF-8 text


def byte_alphabet() -> dict[str, int]:
    """The byte-level BPE alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_bytes(model, i: int) -> bytes:
    """Bytes of B's id."""
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(BLANK, " ").encode()


class Tokenizers:
    """A and B, the bytes of their ids, and the identity map between them."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        special = {i: t.content for i, t in self.a.get_added_tokens_decoder().items()}
        self.a_bytes = [
            special[i].encode() if i in special else bytes(alphabet[c] for c in self.a.id_to_token(i))
            for i in range(self.a.get_vocab_size())
        ]
        n_b = self.b.get_piece_size()
        self.b_bytes = [piece_bytes(self.b, i) for i in range(n_b)]
        self.n_a, self.n_b = len(self.a_bytes), n_b
        usable = [i for i in range(n_b) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i))]
        # pieces of a byte's own win over byte tokens, which only stand in where there is none
        named = {self.b_bytes[i]: i for i in sorted(usable, key=lambda i: not self.b.is_byte(i))}
        self.same = [named.get(b, -1) for b in self.a_bytes]
        inner = re.compile(rf"[{LETTERS}][{MARKS}]|\n|[^{BLANK}]{BLANK}")
        newline_a, newline_b = self.encode_a(["\n"])[0], self.b.encode("\n")
        self.splits = len(newline_a) == 1 and len(newline_b) == 2 and not any(
            inner.search(self.b.id_to_piece(i)) for i in usable if not self.b.is_byte(i)
        )
        if self.splits:
            self.line_a, self.lead_b, self.line_b = newline_a[0], newline_b[0], newline_b[1]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)


def runs(ids: list[int], bound: int) -> list[list[int]]:
    """The ids between the bounds."""
    out: list[list[int]] = [[]]
    for i in ids:
        if i == bound:
            out.append([])
        else:
            out[-1].append(i)
    return out


class Aligner:
    """Aligned pieces, each worked out once; the table of known ones is bounded."""

    def __init__(self, a_path: str, b_path: str):
        self.tools = Tokenizers(a_path, b_path)
        self.size_a, self.size_b = [len(x) for x in self.tools.a_bytes], [len(x) for x in self.tools.b_bytes]
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        #: per known piece: numbers of A ids, B ids and links (-1: not given back), groups as text
        self.n_a, self.n_b, self.n_links, self.text = array("q"), array("q"), array("q"), []
        #: links of all known pieces, one after the other, and where each piece's begin
        self.links, self.first = array("q"), array("q")

    def full(self) -> bool:
        return len(self.known) > KEPT_PIECES

    def column(self, name: str) -> np.ndarray:
        return np.array(getattr(self, name), np.int64)

    def add(self, piece: bytes, a: list[int], b: list[int]) -> None:
        """Align one piece's ids: cut where tokens of both end."""
        t = self.tools
        self.known[piece] = len(self.known)
        self.first.append(len(self.links))
        if b"".join([t.a_bytes[i] for i in a]) != piece or b"".join([t.b_bytes[i] for i in b]) != piece:
            self.n_a.append(0)
            self.n_b.append(0)
            self.n_links.append(-1)
            self.text.append("")
            return
        self.n_a.append(len(a))
        self.n_b.append(len(b))
        ends_b = {end: j for j, end in enumerate(accumulate([self.size_b[j] for j in b]), 1)}
        groups, first_a, first_b = [], 0, 0
        for i, end in enumerate(accumulate([self.size_a[i] for i in a]), 1):
            j = ends_b.get(end)
            if j is None:
                continue
            last_a, last_b = a[i - 1], b[j - 1]
            if i - first_a == 1 and j - first_b == 1:
                groups.append(f"{last_a}|{last_b}")
                exact = t.same[last_a] == last_b
            else:
                groups.append(f"{','.join(map(str, a[first_a:i]))}|{','.join(map(str, b[first_b:j]))}")
                exact = False
            self.links.append(last_a if exact else t.n_a + last_a * t.n_b + last_b)
            first_a, first_b = i, j
        self.n_links.append(len(groups))
        self.text.append(";".join(groups))

    def learn(self, new: list[bytes]) -> None:
        """Tokenise pieces, many in one call with a newline before each."""
        t = self.tools
        texts = {p: p.decode() for p in new}
        simple = [p for p in new if t.splits and SIMPLE.match(texts[p])]
        for k in range(0, len(simple), JOINED * 64):
            some = simple[k : k + JOINED * 64]
            lines = ["\n".join([texts[p] for p in some[i : i + JOINED]]) for i in range(0, len(some), JOINED)]
            ids_a = [r for ids in t.encode_a(lines) for r in runs(ids, t.line_a)]
            ids_b = [r for ids in t.encode_b(["\n" + x for x in lines]) for r in runs(ids[2:], t.line_b)]
            for p, a, b in zip(some, ids_a, ids_b, strict=True):
                self.add(p, a, b)
        alone = [p for p in new if p not in self.known]
        if t.splits:
            ids_b = [ids[2:] for ids in t.encode_b(["\n" + texts[p] for p in alone])]
        else:  # whole texts, to which B adds the blank itself
            ids_b = t.encode_b([texts[p][1:] for p in alone])
        for p, a, b in zip(alone, t.encode_a([texts[p] for p in alone]), ids_b, strict=True):
            self.add(p, a, b)

    def numbers(self, keys: list[bytes]) -> np.ndarray:
        new = [k for k in keys if k not in self.known]
        if new:
            self.learn(new)
        return np.fromiter((self.known[k] for k in keys), np.int64, len(keys))

    def cut(self, texts: pa.Array) -> pa.Array:
        """A blank and the text, with CUT where pieces part; null for texts without any."""
        full = pc.if_else(pc.equal(pc.binary_length(texts), 0), None, pc.binary_join_element_wise(" ", texts, ""))
        if not self.tools.splits:
            return full.cast(pa.binary())
        even = pc.replace_substring_regex(full, LETTER_MARK, "\\1\x01\\2")
        even = pc.replace_substring_regex(even, NEWLINES, "\\1\x01\\2\x01\\3\x01\\4")
        even = pc.replace_substring(even.cast(pa.binary()), pattern=b"\x01", replacement=CUT)
        even = pc.replace_substring(even, pattern=b" ", replacement=CUT + b" ")
        odd = pc.fill_null(pc.match_substring_regex(texts, UNEVEN), False)
        if not pc.any(odd).as_py():
            return even
        looked = [None if x is None else CUT.join([p.encode() for p in BOUND.split(x)]) for x in pc.if_else(odd, full, None).to_pylist()]
        return pc.if_else(odd, pa.array(looked, pa.binary()), even)

    def pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts, one after the other, and how many each text has."""
        lists = pc.split_pattern(self.cut(texts), pattern=CUT)
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        keys, which = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        if b"" in keys:  # next to a cut that is a blank's as well
            keep = which != keys.index(b"")
            counts = np.diff(np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(counts)])])
            which = which[keep]
        return self.numbers(keys)[which], counts


_ALIGNERS: dict[tuple[str, str], Aligner] = {}  # per Python worker


def cached_aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


PER_DOC = ["n_a", "n_b", "n_groups", "groups_sha256", "n_pieces"]
PACKED = ["pieces", "piece_links", "links"]  # long lists of int32, kept as bytes


def aligning(a_path: str, b_path: str):
    """mapInArrow kernel: (part, id, text) -> segments.

    A segment lists its documents' figures and pieces (numbered within the segment),
    the links of each piece (numbered likewise), and the links with their counts:
    exact ones, below the size of A's vocabulary, then pairs.
    """

    def summary(known: Aligner, numbers: np.ndarray, counts: np.ndarray) -> dict:
        edge = np.concatenate([[0], np.cumsum(counts)])
        n_links = known.column("n_links")[numbers]

        def per_doc(x):
            return np.diff(np.concatenate([[0], np.cumsum(x)])[edge])

        lost = per_doc(n_links < 0) > 0
        hashes = [
            hashlib.sha256(";".join([known.text[i] for i in numbers[a:b].tolist()]).encode()).hexdigest() if b > a and not bad else ""
            for a, b, bad in zip(edge[:-1].tolist(), edge[1:].tolist(), lost.tolist())
        ]
        figures = {"n_a": known.column("n_a")[numbers], "n_b": known.column("n_b")[numbers], "n_groups": n_links}
        out = {name: np.where(lost, 0, per_doc(x)) for name, x in figures.items()}
        keep = np.repeat(~lost, counts)
        return out | {"groups_sha256": hashes, "n_pieces": np.where(lost, 0, counts), "pieces": numbers[keep].astype(np.int32)}

    def segment(known: Aligner, part: int, at: int, ids: pa.Array, docs: dict) -> pa.RecordBatch:
        pieces = docs.pop("pieces")
        times = np.bincount(pieces, minlength=len(known.known))
        local = np.flatnonzero(times)
        renumbered = np.zeros(len(times), np.int32)
        renumbered[local] = np.arange(len(local))
        pieces = renumbered[pieces]
        sizes = known.column("n_links")[local]
        flat = gather(known.column("links"), known.column("first")[local], sizes)
        distinct, which = np.unique(flat, return_inverse=True)
        counts = np.bincount(which, weights=np.repeat(times[local], sizes), minlength=len(distinct)).astype(np.int64)
        n_exact = int(np.searchsorted(distinct, known.tools.n_a))
        vector = np.zeros(known.tools.n_a, np.int64)  # as long as A's vocabulary
        vector[distinct[:n_exact]] = counts[:n_exact]
        found = np.flatnonzero(vector)

        def ints(x, kind=pa.int64()):
            return pa.array([x], pa.list_(kind))

        columns = {
            "segment": pa.array([(part << 32) + at], pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            **{n: ints(docs[n]) for n in PER_DOC if n != "groups_sha256"},
            "groups_sha256": pa.array([docs["groups_sha256"]], pa.list_(pa.string())),
            **{n: pa.array([x.astype("<i4").tobytes()], pa.binary()) for n, x in zip(PACKED, (pieces, sizes, which))},
            "exact": ints(found, pa.int32()),
            "exact_counts": ints(vector[found]),
            "pairs": ints(distinct[n_exact:]),
            "pair_counts": ints(counts[n_exact:]),
        }
        return pa.RecordBatch.from_pydict(columns)

    def work(batches):
        known, at = cached_aligner(a_path, b_path), 0
        for batch in (part for whole in batches for part in byte_slices(whole)):
            numbers, counts = known.pieces(batch.column(2).cast(pa.string()))
            docs = summary(known, numbers, counts)
            edge = np.concatenate([[0], np.cumsum(docs["n_pieces"])])
            for a, b in document_runs(docs["n_pieces"].tolist()):
                some = {n: docs[n][a:b] for n in PER_DOC} | {"pieces": docs["pieces"][edge[a] : edge[b]]}
                yield segment(known, batch.column(0)[0].as_py(), at, batch.column(1).slice(a, b - a), some)
                at += 1
            if known.full():  # numbers of pieces end with the batch
                known.clear()
        # an idle worker keeps no pieces beside the next stage's memory
        known.clear()
        pa.default_memory_pool().release_unused()

    return work


def byte_slices(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """Runs of rows of at most about SLICE_BYTES of text, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    edge = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
    return [batch.slice(a, b - a) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()) if b > a]


def document_runs(sizes: list[int]) -> list[tuple[int, int]]:
    """Runs of documents of at most SEGMENT_PIECES pieces, or one longer document."""
    out, first, held = [], 0, 0
    for i, n in enumerate(sizes):
        if i > first and held + n > SEGMENT_PIECES:
            out.append((first, i))
            first, held = i, 0
        held += n
    return [*out, (first, len(sizes))]


def judging(count_of: np.ndarray, best_of: np.ndarray, same: np.ndarray, n_b: int, shared=None):
    """mapInArrow kernel: segments with the corpus-wide counts of their pairs -> one row per document.

    The counts come in each segment's ``totals``, or all of them as the broadcast
    pair of arrays ``shared`` (pairs ascending, counts).
    """

    def judge(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):

                def values(name):
                    return batch.column(name)[i].values.to_numpy(zero_copy_only=False)

                exact, pairs = values("exact"), values("pairs")
                if shared is not None:
                    known, counts = shared.value
                    at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
                    totals = counts[at][known[at] == pairs] if len(pairs) else pairs
                else:
                    totals = values("totals") if len(pairs) else pairs
                if len(totals) != len(pairs):
                    raise ValueError("a pair of the segment has no count")
                b = np.concatenate([same[exact], (pairs - len(same)) % n_b])
                count = np.concatenate([count_of[exact], totals]).astype(np.int64)
                best = count == best_of[b]
                pieces, sizes, which = (np.frombuffer(batch.column(n)[i].as_buffer(), "<i4") for n in PACKED)
                edge = np.concatenate([[0], np.cumsum(sizes)])
                doc_edge = np.concatenate([[0], np.cumsum(values("n_pieces"))])

                def per_doc(x):
                    per_piece = np.diff(np.concatenate([[0], np.cumsum(x[which])])[edge])
                    return np.diff(np.concatenate([[0], np.cumsum(per_piece[pieces])])[doc_edge])

                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column("ids")[i].values,
                        **{n: pa.array(values(n), pa.int64()) for n in PER_DOC[:3]},
                        "n_links": pa.array(values("n_groups"), pa.int64()),
                        "n_best": pa.array(per_doc(best.astype(np.int64)), pa.int64()),
                        "count_sum": pa.array(per_doc(count), pa.int64()),
                        "groups_sha256": batch.column("groups_sha256")[i].values,
                    }
                )

    return judge


class Alignment:
    """The alignment of a corpus: ``pairs`` (a, b, links) and ``documents``."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"):
        self.id_col, self.tools = id_col, Tokenizers(a_path, b_path)
        rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        self.id_type = rows.schema["id"].dataType
        longs = T.ArrayType(T.LongType())
        schema = T.StructType(
            [T.StructField("segment", T.LongType()), T.StructField("ids", T.ArrayType(self.id_type))]
            + [T.StructField(n, longs) for n in PER_DOC if n != "groups_sha256"]
            + [T.StructField("groups_sha256", T.ArrayType(T.StringType()))]
            + [T.StructField(n, T.BinaryType()) for n in PACKED]
            + [T.StructField("exact", T.ArrayType(T.IntegerType()))]
            + [T.StructField(n, longs) for n in ("exact_counts", "pairs", "pair_counts")]
        )
        self.segments, _ = store(rows.mapInArrow(aligning(a_path, b_path), schema), "alignment")
        # one row per segment and irregular pair
        found = self.segments.select("segment", F.posexplode(F.arrays_zip("pairs", "pair_counts")).alias("place", "x"))
        self.places = found.select("segment", "place", F.col("x.pairs").alias("pair"), F.col("x.pair_counts").alias("n"))
        self.totals, _ = store(self.places.groupBy("pair").agg(F.sum("n").alias("total")), "alignment-pairs")
        exact = self.segments.select(F.explode(F.arrays_zip("exact", "exact_counts")).alias("x"))
        #: at most one row per id of A
        self.exact = exact.groupBy(F.col("x.exact").alias("a")).agg(F.sum("x.exact_counts").alias("links"))

    @property
    def irregular(self) -> DataFrame:
        """(a, b, links) of the pairs of irregular groups."""
        pair = F.col("pair") - self.tools.n_a
        b = F.pmod(pair, F.lit(self.tools.n_b)).cast("bigint")
        a = ((pair - b) / self.tools.n_b).cast("bigint")
        return self.totals.select(a.alias("a"), b.alias("b"), F.col("total").alias("links"))

    @property
    def pairs(self) -> DataFrame:
        """All linked pairs of ids with their numbers of links."""
        named = self.totals.sparkSession.createDataFrame(
            [(a, b) for a, b in enumerate(self.tools.same) if b >= 0], "a bigint, b bigint"
        )
        return self.exact.join(named, "a").select("a", "b", "links").unionByName(self.irregular)

    def documents(self) -> DataFrame:
        """Per document: tokens, groups, links, links that are their B id's best, and the sum of counts."""
        count_of = np.zeros(self.tools.n_a, np.int64)
        for r in self.exact.collect():
            count_of[r["a"]] = r["links"]
        best_of = np.zeros(self.tools.n_b, np.int64)
        found = np.flatnonzero(count_of)
        same = np.array(self.tools.same, np.int64)
        np.maximum.at(best_of, same[found], count_of[found])
        # at most one row per id of B
        for r in self.irregular.groupBy("b").agg(F.max("links").alias("links")).collect():
            best_of[r["b"]] = max(best_of[r["b"]], r["links"])
        schema = T.StructType(
            [T.StructField("id", self.id_type)]
            + [T.StructField(n, T.LongType()) for n in (*PER_DOC[:3], "n_links", "n_best", "count_sum")]
            + [T.StructField("groups_sha256", T.StringType())]
        )
        told, shared = self.segments.drop("exact_counts", "pair_counts"), None
        if self.totals.count() <= SHARED_PAIRS:
            held = self.totals.orderBy("pair").toPandas()
            shared = told.sparkSession.sparkContext.broadcast((held["pair"].to_numpy(np.int64), held["total"].to_numpy(np.int64)))
        else:
            # a pair has at most one row per segment, so none is hot
            counted = self.places.drop("n").join(self.totals, "pair")
            by_place = F.transform(F.array_sort(F.collect_list(F.struct("place", "total"))), lambda x: x["total"])
            told = told.join(counted.groupBy("segment").agg(by_place.alias("totals")), "segment", "left")
        kernel = judging(count_of, best_of, same, self.tools.n_b, shared)
        return told.mapInArrow(kernel, schema).withColumnRenamed("id", self.id_col)


for _module in (sys.modules[__name__], tokens, coder):
    cloudpickle.register_pickle_by_value(_module)
