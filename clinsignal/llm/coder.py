"""Adaptive context-mixing range coder for streams of token ids (numpy).

A stream is cut into blocks of ``BLOCK`` ids.  Every block starts from the same
model state and carries its own checksum, so blocks are decoded alone, and a
damaged one is noticed and does not harm the others.  Because blocks are
independent, many of them are coded in step: one numpy operation advances all
blocks by one id, which is what makes an adaptive coder affordable in Python.

Model of one id, given the two ids before it:

* order 2: the id that followed this pair last time, with a confidence count;
* order 1: the same for the previous id alone;
* order 0: an adaptive distribution over 32 classes of ids (sizes grow with the
  id; ids of one class share its probability evenly), mixed with one kept for
  each group of classes of the previous id, the more the more that one has seen.

The chances that the order-2 id, else the order-1 id is right are learned for
every pair of confidences.  They and the class shares make one range-coder
decision; the place inside a class, whose ids are equally likely, follows as
plain bits in a second stream.

The model learns ``CHUNK`` ids at a time, and its shares are worked out anew at
the ids in ``REFRESH``, so the costly part of learning runs over many ids at once.

Coder: 64-bit carry-less range coder that emits 32-bit words.  Block layout:
``ids (u32) | payload words (u32) | crc32 of the ids as u32 LE (u32) | payload``;
the payload is ``words of the decisions (u32) | these words | plain bits``.
All numbers are little-endian.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048
LANES = 2048  # blocks coded in step; bounds the memory of the model tables
CHUNK = 16  # ids of a block that the model learns together
# ids of a block after which the shares are worked out anew: often at first
REFRESH = frozenset((16, 32, 48, 64, 96, 128, 192, 256, 320, 384, 512, 640, 768, *range(1024, BLOCK, 256)))
CLASS_BITS = np.repeat([6, 8, 10, 13], 8)  # 32 classes: 8 of 64 ids, of 256, of 1024, of 8192
CLASS_BASE = np.concatenate([[0], np.cumsum(1 << CLASS_BITS)]).astype(np.int64)
MAX_ID = int(CLASS_BASE[-1])  # ids must be below
CLASSES = len(CLASS_BITS)
CLASS_OF = np.repeat(np.arange(CLASSES), 1 << CLASS_BITS)
WIDEST = int(CLASS_BITS.max())
U16, U32, U64 = np.uint16, np.uint32, np.uint64

# an item is an id with its class: id * 32 + class
ITEM_OF = ((np.arange(MAX_ID) << 5) | CLASS_OF).astype(U32)
ITEM_BASE = ((CLASS_BASE[:-1] << 5) | np.arange(CLASSES)).astype(U32)
# plain bits of a class; entry CLASSES is that of an id guessed right: none
WIDTH = np.append(CLASS_BITS, 0).astype(np.int64)
WIDTH_MASK = ((1 << WIDTH) - 1).astype(U32)

SLOT_BITS = 9  # hash slots of order 2 and of order 1, per block
SLOTS = 1 << SLOT_BITS
STATES = 16  # pairs of confidences
CONTEXTS = 4  # groups of eight classes of the previous id: those of one size

BITS1, TOTAL = 15, 1 << 15  # the chances, and the class shares of the rest, are shares of TOTAL
BITS = 2 * BITS1
PRIOR = np.array([[1], [1], [6]], np.float32)  # order 2 right, order 1 right, neither
MIX = np.float32(64)  # order 0 weighs as much as so many ids seen after the context


def _const(value: int, kind: type) -> np.ndarray:
    """A constant of the inner loops (an array of no dimensions is the quickest form)."""
    return np.array(value, kind)


HASH1, HASH2, HASH_SHIFT = _const(0x9E3779B1, U32), _const(0x85EBCA77, U32), _const(32 - SLOT_BITS, U32)
CLASS_MASK, CONTEXT_MASK, CONTEXT_SHIFT, ONE, FOUR = (_const(x, U32) for x in (CLASSES - 1, CLASSES - 8, 3, 1, 4))
# a slot is item * 16 + confidence (0 to 3), times 4 for order 2
ITEM_SHIFT, SURE2, SURE1 = _const(4, U32), _const(12, U32), _const(3, U32)
ID_SHIFT, HALF, LOW16, SHIFT1, TOTAL32 = _const(5, U32), _const(16, U32), _const(0xFFFF, U32), _const(BITS1, U32), _const(TOTAL, U32)
START_MASK, WIDE, BITS64, ONE64 = _const(TOTAL - 1, U16), _const(32, U64), _const(BITS, U64), _const(1, U64)
LOW32, TOP, FULL = _const(0xFFFFFFFF, U64), _const(1 << 32, U64), U64(0xFFFFFFFFFFFFFFFF)
BY_EIGHT, LAST_BYTE, TWO_BYTES, BIT_MASK, PER_ROW = _const(0x01010101, U32), _const(24, U32), _const(4, np.int64), _const(15, np.int64), _const(CLASSES, np.int64)


class Damaged(ValueError):
    """A block that does not match its checksum or layout."""


class Model:
    """State of ``n`` blocks coded in step (tables are flat: block * slots + slot)."""

    def __init__(self, n: int):
        self.lane = np.arange(n)
        self.base, self.base_state, self.n = self.lane * SLOTS, self.lane * STATES, _const(n, np.int64)
        self.pair, self.one = np.zeros(n * SLOTS, U32), np.zeros(n * SLOTS, U32)
        self.seen = np.repeat(PRIOR, n * STATES, axis=1)
        self.counts = np.zeros((CONTEXTS, n, CLASSES), np.float32)
        # ends of the classes; the entry before a row is TOTAL, which & (TOTAL - 1) makes its start 0
        self.edges = np.full(1 + self.counts.size, TOTAL, U16)
        self.rows = self.edges[1:].reshape(CONTEXTS * n, CLASSES)
        # what was looked up for the ids of the chunk, (time, block)
        self.at2, self.at1, self.state, self.at_class = (np.zeros((CHUNK, n), np.int64) for _ in range(4))
        self.two, self.single = np.zeros((CHUNK, n), U32), np.zeros((CHUNK, n), U32)
        self.hit2, self.hit = np.zeros((CHUNK, n), bool), np.zeros((CHUNK, n), bool)
        self.refresh()

    def guess(self, before, last, rows):
        """Looks up slots and states of these rows of the chunk; returns the shares of order 2 and of both."""
        one = last * HASH1
        at2 = np.add(self.base, (one + before * HASH2) >> HASH_SHIFT, out=self.at2[rows])
        at1 = np.add(self.base, one >> HASH_SHIFT, out=self.at1[rows])
        two = self.pair.take(at2, out=self.two[rows], mode="clip")
        single = self.one.take(at1, out=self.single[rows], mode="clip")
        state = np.add(self.base_state, (two & SURE2) | (single & SURE1), out=self.state[rows])
        share = self.shares.take(state)
        return share >> HALF, share & LOW16

    def row(self, last):
        """Row of class shares after this item."""
        return self.lane + self.n * ((last & CONTEXT_MASK) >> CONTEXT_SHIFT)

    def class_share(self, at):
        """Start and size of the class at row * CLASSES + class."""
        start = self.edges.take(at) & START_MASK
        return start, self.edges[1:].take(at, mode="clip") - start

    def learn(self, items):
        """Update with the items of the chunk, (time, block), in order of time; of equal slots the last one stays."""
        item, steps = items.ravel(), len(items)
        fresh = item << ITEM_SHIFT
        for table, slots, found, sure, step in ((self.pair, self.at2, self.two, SURE2, FOUR), (self.one, self.at1, self.single, SURE1, ONE)):
            held = found[:steps].ravel()
            now = np.where((held & sure) > step, held - step, fresh + step)
            right = ((held >> ITEM_SHIFT) == item).nonzero()[0]
            was = held[right]
            now[right] = np.where((was & sure) < sure, was + step, was)
            table[slots[:steps].ravel()] = now
        # 0: order 2 was right, 1: order 1, 2: neither
        wrong = (~self.hit[:steps]).astype(np.int64) + ~self.hit2[:steps]
        met = wrong * self.seen.shape[1] + self.state[:steps]
        one = np.ones(len(item), np.float32)
        np.add.at(self.seen.reshape(-1), met.ravel(), one)
        np.add.at(self.counts.reshape(-1), self.at_class[:steps].ravel(), one)

    def refresh(self):
        """Work out all shares from what was seen so far."""
        # every choice keeps a share of at least 1
        part = np.float32(TOTAL - 3) / self.seen.sum(axis=0)
        two, one = ((seen * part).astype(U32) + ONE for seen in self.seen[:2])
        self.shares = (two << HALF) | (two + one)
        zero = self.counts.sum(axis=0) + np.float32(0.5)
        zero *= MIX / zero.sum(axis=1, keepdims=True)
        for counts, ends in zip(self.counts, self.rows.reshape(self.counts.shape)):
            scale = np.float32(TOTAL - CLASSES) / (counts.sum(axis=1, keepdims=True) + MIX)
            mixed = counts + zero
            mixed *= scale
            # one running sum over all rows; what a row began with is taken off, 65536 being 0
            sizes = mixed.astype(U16)
            sizes += U16(1)
            sums = sizes.ravel().cumsum(dtype=U16).reshape(sizes.shape)
            np.subtract(sums, sums[:, :1] - sizes[:, :1], out=ends)
            ends[:, -1] = TOTAL


def choice(right, hit2, f2, f12, lower, rest, start, size):
    """Start and size of a decision of 2 ** BITS: a class in the rest, or where ``right``, order 2 or 1."""
    start, size = rest * start + lower, rest * size
    two, f2 = hit2[right], f2[right]
    start[right] = np.where(two, 0, f2) << SHIFT1
    size[right] = np.where(two, f2, f12[right] - f2) << SHIFT1
    return start.astype(U64), size.astype(U64)


def _renormalise(low, rng):
    """Blocks whose range is short of 32 bits: (which, their low); both are shifted.

    A range across a word boundary is first cut back to the boundary, so the
    upper word of low is final.
    """
    at = (rng < TOP).nonzero()[0]
    lo, span = low[at], rng[at]
    cross = ((lo ^ (lo + span - ONE64)) >> WIDE) != 0
    if cross.any():
        np.copyto(span, TOP - (lo & LOW32), where=cross)
    low[at], rng[at] = lo << WIDE, span << WIDE
    return at, lo


class Encoder:
    """Decisions and plain bits of ``n`` blocks, each to words of its own."""

    def __init__(self, n: int, steps: int):
        self.low, self.range = np.zeros(n, U64), np.full(n, FULL, U64)
        self.words, self.used = np.zeros((steps + 2, n), U32), np.zeros(n, np.int64)
        self.held, self.fill = np.zeros(n, U64), np.zeros(n, U64)
        self.plain, self.put = np.zeros((steps * WIDEST // 32 + 1, n), U32), np.zeros(n, np.int64)

    def code(self, start, size):
        """Narrow the blocks to [start, start + size) of 2 ** BITS."""
        r = self.range >> BITS64
        self.low += start * r
        np.multiply(r, size, out=self.range)
        at, lo = _renormalise(self.low, self.range)
        used = self.used[at]
        self.words[used, at] = lo >> WIDE
        self.used[at] = used + 1

    def append(self, value, width):
        """Add ``width`` plain bits."""
        self.held |= value << self.fill
        self.fill += width
        at = (self.fill >= WIDE).nonzero()[0]
        held, put = self.held[at], self.put[at]
        self.plain[put, at] = held & LOW32
        self.held[at], self.put[at] = held >> WIDE, put + 1
        self.fill[at] -= WIDE

    def finish(self, lane: int) -> bytes:
        used, put = int(self.used[lane]), int(self.put[lane])
        low = int(self.low[lane])
        end = [low >> 32, low & 0xFFFFFFFF]
        rest = [int(self.held[lane])] if self.fill[lane] else []
        parts = ([used + 2], self.words[:used, lane], end, self.plain[:put, lane], rest)
        return b"".join(np.asarray(p, "<u4").tobytes() for p in parts)


class Decoder:
    def __init__(self, payloads: list[bytes]):
        n, parts = len(payloads), []
        for p in payloads:
            first = 4 + 4 * int.from_bytes(p[:4], "little")
            parts.append((np.frombuffer(p[4:first], "<u4"), np.frombuffer(p[first:], np.uint8)))
        # zeros follow; what a damaged block reads beyond them is cut back to the end (mode="clip")
        steps, width = (max(len(x) for x in which) + 8 for which in zip(*parts))
        self.words, plain = np.zeros((n, steps), U32), np.zeros((n, width), np.uint8)
        for i, (coded, rest) in enumerate(parts):
            self.words[i, : len(coded)], plain[i, : len(rest)] = coded, rest
        # the four bytes from every second byte on, so that a value is read at once
        twos = width // 2 - 1
        self.plain = np.ndarray((n, twos), "<u4", plain, strides=(width, 2)).astype(U32).ravel()
        self.at_word, self.at_bit = np.arange(n) * steps + 2, np.arange(n) * twos * 16
        self.range, self.low = np.full(n, FULL, U64), np.zeros(n, U64)
        # how far the code lies above low
        self.above = (self.words[:, 0].astype(U64) << U64(32)) | self.words[:, 1].astype(U64)
        self.words = self.words.ravel()

    def target(self):
        """Where the code lies, out of 2 ** BITS (beyond them in a damaged block only)."""
        self.r = self.range >> BITS64
        return (self.above // self.r).astype(U32)

    def take(self, start, size):
        step = start * self.r
        self.low += step
        self.above -= step
        np.multiply(self.r, size, out=self.range)
        at, _ = _renormalise(self.low, self.range)
        word = self.at_word[at]
        self.above[at] = (self.above[at] << WIDE) | self.words.take(word, mode="clip")
        self.at_word[at] = word + 1

    def read(self, classes):
        """The plain bits of each class."""
        value = (self.plain.take(self.at_bit >> TWO_BYTES, mode="clip") >> (self.at_bit & BIT_MASK).astype(U32)) & WIDTH_MASK.take(classes)
        self.at_bit += WIDTH.take(classes)
        return value


def _encode_lanes(blocks: list[np.ndarray]) -> list[bytes]:
    """Payloads of blocks; only the last one may be shorter."""
    n, steps, short = len(blocks), len(blocks[0]), len(blocks[-1])
    items = np.zeros((steps + 2, n), U32)  # two items of id 0 come first
    for i in range(0, n, 64):  # some at a time: rows are written in runs
        part = np.zeros((min(64, n - i), steps), U32)
        for row, b in zip(part, blocks[i : i + 64]):
            row[: len(b)] = ITEM_OF.take(b)
        items[2:, i : i + 64] = part.T
    model, coder, last = Model(n), Encoder(n, steps), b""
    for t in range(0, steps, CHUNK):
        if t in REFRESH:
            model.refresh()
        m = min(CHUNK, steps - t)
        rows, (before, prev, item) = slice(m), (items[t + i : t + i + m] for i in range(3))
        f2, f12 = (x.ravel() for x in model.guess(before, prev, rows))
        hit2 = np.equal(model.two[rows] >> ITEM_SHIFT, item, out=model.hit2[rows])
        hit = np.logical_or((model.single[rows] >> ITEM_SHIFT) == item, hit2, out=model.hit[rows])
        right, classes = hit.ravel().nonzero()[0], (item & CLASS_MASK).astype(np.int64)
        at_class = np.add(model.row(prev) * PER_ROW, classes, out=model.at_class[rows])
        start, size = choice(right, hit2.ravel(), f2, f12, f12 << SHIFT1, TOTAL32 - f12, *model.class_share(at_class.ravel()))
        place, classes = ((item - ITEM_BASE.take(classes)) >> ID_SHIFT).ravel(), classes.ravel()
        place[right], classes[right] = 0, CLASSES
        steps_of = (start, size, place.astype(U64), WIDTH.take(classes).view(U64))
        for k, (a, b, c, d) in enumerate(zip(*(x.reshape(m, n) for x in steps_of)), t + 1):
            coder.code(a, b)
            coder.append(c, d)
            if k == short:
                last = coder.finish(n - 1)
        model.learn(item)
    return [*(coder.finish(i) for i in range(n - 1)), last]


def _decode_lanes(payloads: list[bytes], steps: int) -> np.ndarray:
    """Ids (block, time); a block that is shorter ends in ids without meaning."""
    n = len(payloads)
    items = np.zeros((steps + 2, n), U32)
    model, coder = Model(n), Decoder(payloads)
    for t in range(0, steps, CHUNK):
        if t in REFRESH:
            model.refresh()
        m = min(CHUNK, steps - t)
        for k in range(m):
            before, prev, item = items[t + k], items[t + k + 1], items[t + k + 2]
            f2, f12 = model.guess(before, prev, k)
            found = coder.target()
            upper = found >> SHIFT1
            hit2, hit = np.less(upper, f2, out=model.hit2[k]), np.less(upper, f12, out=model.hit[k])
            right = hit.nonzero()[0]
            # the class: how many end at or before the place found in the rest; without meaning if order 2 or 1 is right
            lower, rest = f12 << SHIFT1, TOTAL32 - f12
            inside = ((found - lower) // rest).astype(U16) & START_MASK
            row = model.row(prev)
            below = model.rows.take(row, axis=0, mode="clip") <= inside[:, None]
            # bytes of 0 or 1, counted by eights; the four counts are added up in a word
            eights = np.bitwise_count(below.view(U64)).view(U32)[:, 0]
            classes = ((eights * BY_EIGHT) >> LAST_BYTE).astype(np.int64)
            classes[right] = 0
            row *= PER_ROW
            coder.take(*choice(right, hit2, f2, f12, lower, rest, *model.class_share(row + classes)))
            ITEM_BASE.take(classes, out=item, mode="clip")
            classes[right] = CLASSES
            item += coder.read(classes) << ID_SHIFT
            item[right] = np.where(hit2[right], model.two[k][right], model.single[k][right]) >> ITEM_SHIFT
            # learned is the class of the id itself, however it was coded
            np.add(row, item & CLASS_MASK, out=model.at_class[k])
        model.learn(items[t + 2 : t + 2 + m])
    ids = np.empty((n, steps), "<u4")
    for i in range(0, n, 64):  # some at a time: rows are read in runs
        ids[i : i + 64] = (items[2:, i : i + 64] >> ID_SHIFT).T
    return ids


def encode(ids: np.ndarray) -> bytes:
    """A stream of ids as blocks, one after the other."""
    ids = np.asarray(ids)
    if len(ids) and (ids.min() < 0 or ids.max() >= MAX_ID):
        raise ValueError(f"ids must be in [0, {MAX_ID})")
    blocks = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
    out = []
    for i in range(0, len(blocks), LANES):
        part = blocks[i : i + LANES]  # only the last block of a stream is shorter
        for block, payload in zip(part, _encode_lanes(part)):
            crc = zlib.crc32(block.astype("<u4").tobytes())
            out.append(np.array([len(block), len(payload) // 4, crc], "<u4").tobytes() + payload)
    return b"".join(out)


def split_blocks(data: bytes) -> list[tuple[int, int, bytes]]:
    """(ids, checksum, payload) of every block."""
    out, at = [], 0
    while at < len(data):
        if at + 12 > len(data):
            raise Damaged("cut-off block header")
        n, words, crc = np.frombuffer(data, "<u4", 3, at).tolist()
        if not 0 < n <= BLOCK or at + 12 + 4 * words > len(data):
            raise Damaged("bad block header")
        out.append((n, crc, data[at + 12 : at + 12 + 4 * words]))
        at += 12 + 4 * words
    return out


def decode(data: bytes) -> np.ndarray:
    """The ids of a stream; raises ``Damaged`` when a block fails its checksum."""
    blocks = split_blocks(data)
    out = []
    for i in range(0, len(blocks), LANES):
        part = blocks[i : i + LANES]
        sizes = np.array([n for n, _, _ in part])
        if (np.diff(sizes) > 0).any():
            raise Damaged("only the last block may be shorter")
        ids = _decode_lanes([p for _, _, p in part], int(sizes[0]))
        for k, (n, crc, _) in enumerate(part):
            block = ids[k, :n]
            if zlib.crc32(block) != crc:
                raise Damaged(f"checksum of block {i + k}")
            out.append(block)
    return np.concatenate(out).astype(np.uint32) if out else np.zeros(0, np.uint32)
