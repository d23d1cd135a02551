"""LM scoring by logistic context mixing over hashed-context bit predictors.

A text is read as its lower-cased words, each ended by a blank, then a line end: a byte stream whose pieces are the
tokens (words, then one end). Two layers score it:

1. Bytes. A byte is coded as a few binary decisions, by a Huffman tree for the two bytes before it; bytes that this
   tree has not take its escape and then the order-0 tree, without the decisions that lead only to bytes which the
   first tree has, so the probabilities of all 256 bytes add up to one. Four predictors give each decision a log-odds: the
   tree's node itself (order 2), and nodes hashed with the 4 and 6 bytes before and with the word so far. They are added
   up with weights that a gate selects (how much the 6 bytes, the word and the 4 bytes have seen); within a text they are
   refined adaptively: after each of its blocks, which double in length, a damped Newton step moves the gain and a
   weight for the rest of that text.
2. Tokens. The bytes' probability of a token is mixed with those that the counts of the whole corpus give it: after the
   two tokens before, after the one before, and alone. The weight of a context depends on how often it was seen, and is
   refined in the same way, in log-odds, within the text. Each part is a probability law over tokens, and so is the mixture.

The log10 probabilities of all tokens add up to the score; total bits by total bytes is bits_per_byte.

What is learned grows with the input and covers all training texts: the counts of all tokens, of all pairs and of all
triples of neighbouring tokens (hashed keys, longer for more input, uncapped), asked for by chunk and bucket like all keys of exchange.py. The
second layer leaves a counted text's own occurrence out at each token, so that texts learned from and held out compare.
The first layer has fixed size (tables of 2**20, 2**22 and 2**22 hashed slots, trees for the CONTEXTS most frequent byte
pairs): every task counts its own texts and sends its tables, which are summed in two levels and broadcast, about 20 MB.
Its gate weights come from online gradient descent over a fixed share (1 in SHARE) of the training texts, while
the decision counts leave these out so that weights see unseen texts; then they are counted too.

Base score: unigrams with add-one over training tokens, from the same token counts.

Defined results: null text is empty (one end token); documents without a doc_id are scored but neither train nor are
held out; repeated rows each get their row; without training texts all log-odds and counts are 0.
"""

from __future__ import annotations

import heapq
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .kernel import CHAR_POWERS, IS_WORD, LOWER, U64, flat, mix, pieces, spans, word_hashes
from .quality import remainder

U32 = np.uint32
BLANK, END = 0x20, 0x0A
#: The hashed contexts: so many bytes before, then the word so far; slots of their tables as powers of two.
ORDERS, BITS = (4, 6), (20, 22, 22)
LONGEST = max(ORDERS)
INPUTS, GATES = 5, 64
CONTEXTS = 2048
SHARE = 64
SLICE = 1 << 16
PIECE = 1 << 17
#: Slots by which equal places are found, as a power of two.
PLACE_BITS = 22
ESCAPE = 256
END_KEY = int(mix(np.array([0xE0D], U64))[0] >> U64(4))
DAMP = 150.0
#: Decisions in a step of the gate weights' descent.
STEP = 1000
#: Most training bytes of one task, so that its tables are small against what it reads.
TASK_BYTES = 128 << 20
#: Log-odds of a context seen n times: a + b * ln n, for two tokens before and one; and of counts alone against bytes.
TRIPLE, PAIR, SINGLE = (0.0, 0.4), (-3.0, 0.2), -2.0
#: Damping of the token weights' steps, tokens of a text's first block, and how far the weights may move.
TOKEN_DAMP, TOKEN_BLOCK, TOKEN_MOVE = 1.0, 8, 4.0


def stream(data: np.ndarray, offsets: np.ndarray):
    """The texts' byte streams: (bytes, first byte of each text)."""
    n = len(offsets) - 1
    wide = np.insert(LOWER[data], np.repeat(offsets[1:], 2), BLANK)
    off = offsets + 2 * np.arange(n + 1)
    keep = IS_WORD[wide]
    word = keep.copy()
    keep[1:] |= word[:-1]
    keep[off[1:] - 1] = True
    wide[~word] = BLANK
    first = np.concatenate(([0], np.cumsum(keep)))[off]
    out = wide[keep]
    out[first[1:] - 1] = END
    return out, first


def before(out: np.ndarray, first: np.ndarray, most: int = 6) -> list[np.ndarray]:
    """The bytes 1 to ``most`` places before each byte; line ends before a text."""
    back = []
    for k in range(1, most + 1):
        x = np.empty_like(out)
        x[k:], x[:k] = out[:-k], END
        for j in range(k):  # the first bytes of each text
            at = first[:-1] + j
            x[at[at < first[1:]]] = END
        back.append(x)
    return back


class Trees:
    """Huffman trees by context: number 0 for order 0, then those of the most frequent byte pairs."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        pair, last = keys >> 8, keys & 255
        order0 = np.bincount(last, counts, 256)
        pairs, at = np.unique(pair, return_inverse=True)
        total = np.bincount(at, counts) if len(pairs) else np.zeros(0)
        top = np.sort(pairs[np.lexsort((pairs, -total))][:CONTEXTS])
        self.number = np.zeros(65536, np.int64)
        self.number[top] = np.arange(1, len(top) + 1)
        self.length = np.zeros((len(top) + 1) * 257, np.int64)
        self.begin = np.zeros((len(top) + 1) * 257, np.int64)
        self.steps: list[int] = []
        self.nodes = 0
        self._grow(0, {s: float(order0[s]) + 1e-3 for s in range(256)})
        # The bytes below each side of the order-0 tree's 255 nodes.
        side = np.zeros((2, 255, 256), np.float32)
        for symbol in range(256):
            for step in self.steps[self.begin[symbol] : self.begin[symbol] + self.length[symbol]]:
                side[step & 1, step >> 1, symbol] = 1
        mine = np.searchsorted(top, pair)
        mine[mine == len(top)] = 0
        inside = top[mine] == pair if len(top) else np.zeros(len(pair), bool)
        by: dict[int, dict[int, float]] = {}
        for m, s, c in zip(mine[inside].tolist(), last[inside].tolist(), counts[inside].tolist()):
            by.setdefault(m + 1, {})[s] = float(c)
        free = np.ones((256, len(top) + 1), np.float32)  # bytes that a tree has not
        for m, seen in sorted(by.items()):
            self._grow(m, seen | {ESCAPE: 0.5} if len(seen) < 256 else seen)
            free[list(seen), m] = 0
        #: Whether a tree's escape needs the decision of an order-0 node: both sides have bytes that the tree has not.
        self.open = ((side[0] @ free > 0) & (side[1] @ free > 0)).T
        self.steps_array = np.array(self.steps, np.int32)
        self.steps, self.begin, self.length, self.number = [], self.begin.astype(np.int32), self.length.astype(np.int16), self.number.astype(np.int16)

    def _grow(self, number: int, weight: dict[int, float]) -> None:
        heap = [(w, s, s) for s, w in weight.items()]
        heapq.heapify(heap)
        fresh = 1000
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a[0] + b[0], fresh, (a[2], b[2])))
            fresh += 1
        stack = [(heap[0][2], [])]
        while stack:
            tree, path = stack.pop()
            if isinstance(tree, tuple):
                node, self.nodes = self.nodes, self.nodes + 1
                stack += [(tree[1], [*path, node << 1 | 1]), (tree[0], [*path, node << 1])]
            else:
                self.begin[number * 257 + tree], self.length[number * 257 + tree] = len(self.steps), len(path)
                self.steps += path
                if not path:  # a tree of one leaf takes no decision, but counts as seen
                    self.begin[number * 257 + tree], self.length[number * 257 + tree] = 0, 0

    def events(self, s: np.ndarray, p1: np.ndarray, p2: np.ndarray):
        """(decisions as node << 1 | bit, byte of each decision)."""
        number = self.number.take(p2.astype(np.int64) << 8 | p1).astype(np.int64)
        code = number * 257 + s
        n = self.length.take(code)
        unseen = (n == 0) & (number > 0)
        at, head = np.arange(len(s)), np.zeros(0, np.int64)
        if unseen.any():
            count = 1 + unseen
            at = np.repeat(at, count)
            code = np.repeat(code, count)
            head = np.cumsum(count)[unseen] - 2
            code[head] = number[unseen] * 257 + ESCAPE
            code[head + 1] = s[unseen]
            n = self.length.take(code)
        end = np.cumsum(n, dtype=np.int64)
        shift = np.repeat(self.begin.take(code) - end + n, n)
        step, at = self.steps_array.take(np.arange(len(shift)) + shift), np.repeat(at, n)
        if len(head):
            size = n[head + 1].astype(np.int64)
            own = np.arange(int(size.sum())) + np.repeat(end[head + 1] - np.cumsum(size), size)
            forced = own[~self.open[np.repeat(number[unseen], size), step[own] >> 1]]
            if len(forced):
                keep = np.ones(len(step), bool)
                keep[forced] = False
                step, at = step[keep], at[keep]
        return step, at


def hashes(back: list[np.ndarray]) -> list[np.ndarray]:
    """32-bit hash of the bytes before, for each hashed order."""
    out, h = [], np.zeros(len(back[0]), U32)
    for k, b in enumerate(back, 1):
        h = (h + b + U32(1)) * U32(0x9E3779B1)
        h ^= h >> U32(15)
        if k in ORDERS:
            out.append(h)
    return out


def word_so_far(out: np.ndarray, back: np.ndarray) -> np.ndarray:
    """32-bit hash of the bytes between the last blank or line end and each byte."""
    n = len(out)
    up, down = CHAR_POWERS.get(n + 1)
    total = np.concatenate((np.zeros(1, U64), np.cumsum((out.astype(U64) + U64(7)) * up[:n])))
    starts = np.flatnonzero((back == BLANK) | (back == END))
    begin = np.repeat(starts, np.diff(np.append(starts, n)))
    return (mix((total[:n] - total[begin]) * down[begin] + U64(1)) >> U64(32)).astype(U32)


def slots(h: list[np.ndarray], at: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
    key = node.astype(U32) * U32(0x85EBCA6B)
    return [(((x.take(at) ^ key) * U32(0xC2B2AE35)) >> U32(32 - b)).astype(np.int64) for x, b in zip(h, BITS)]


# ---- token counts and trigrams -------------------------------------------------------------------------------------

COUNTED = "bucket int, total bigint, kinds bigint, payload binary"


def _ordered(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys of ``bits`` bits, their places), by sorting words that hold both, much faster than argsort.

    If a word is too small, keys lose their lowest bits in it; should that mix any two, argsort does it."""
    room = max(1, len(keys)).bit_length()
    less = U64(max(0, bits + room - 64))
    words = (keys >> less) << U64(room)
    words |= np.arange(len(keys), dtype=U64)
    words.sort()
    order = (words & U64((1 << room) - 1)).view(np.int64)
    out = keys.take(order)
    if less and (out[1:] < out[:-1]).any():
        order = np.argsort(keys, kind="stable")
        out = keys.take(order)
    return out, order


def _token_keys(data: np.ndarray, offsets: np.ndarray):
    low = LOWER[data]
    starts, ends, first = spans(low, offsets)
    return word_hashes(low, starts, ends) >> U64(4), first


def _pack_counts(keys: np.ndarray, n: np.ndarray) -> bytes:
    small = not len(n) or int(n.max()) < 1 << 32
    return (b"4" if small else b"8") + X.pack(keys, n.astype(U32 if small else U64))


def _unpack_counts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys, n = X.unpack(raw[1:], U32 if raw[:1] == b"4" else U64)
    return keys, n.astype(U64)


def _count(buckets: int):
    @X.tidy
    def run(batches):
        for table in X.gathered(batches, X.CHUNK_BYTES):
            data, offsets = flat(table["body"])
            words, seen = [], []
            for a, b in pieces(offsets):
                part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                words.append(_token_keys(part, off)[0])
                out, first = stream(part, off)
                p1, p2 = before(out, first, 2)
                seen.append(np.unique(p2.astype(np.int32) << 16 | p1.astype(np.int32) << 8 | out, return_counts=True))
            keys, n = np.unique(np.concatenate([np.array([END_KEY] * table.num_rows, U64), *words]), return_counts=True)
            cut = np.searchsorted(X.bucket_of(keys, 60, buckets), np.arange(buckets + 1)).tolist()
            rows = [(b, _pack_counts(keys[x:y], n[x:y])) for b, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]
            some, at = np.unique(np.concatenate([np.zeros(0, np.int32), *(g[0] for g in seen)]), return_inverse=True)
            grams = np.bincount(at, np.concatenate([np.zeros(0, np.int64), *(g[1] for g in seen)]), len(some))
            for j, (x, y) in enumerate(zip(*(lambda c: (c[:-1], c[1:]))(np.searchsorted(some, np.arange(17) << 20).tolist()))):
                if y > x:
                    rows.append((-1 - j, _pack_counts(some[x:y].astype(U64), grams[x:y])))
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([r[0] for r in rows], pa.int32()), "payload": pa.array([r[1] for r in rows], pa.binary())})

    return run


@X.tidy
def _total(table: pa.Table) -> pa.Table:
    got = [_unpack_counts(p) for p in table["payload"].to_pylist()]
    keys, at = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
    n = np.bincount(at, np.concatenate([g[1] for g in got]).astype(np.float64)).astype(U64)
    return pa.table({"bucket": table["bucket"][:1], "total": pa.array([int(n.sum())], pa.int64()), "kinds": pa.array([len(keys)], pa.int64()), "payload": pa.array([_pack_counts(keys, n)], pa.binary())})


# ---- decision counts ------------------------------------------------------------------------------------------------


def _decisions(trees: Trees, data: np.ndarray, offsets: np.ndarray):
    """(decisions, slots) of texts, in their order."""
    out, first = stream(data, offsets)
    back = before(out, first)
    step, at = trees.events(out, back[0], back[1])
    return step, slots([*hashes(back), word_so_far(out, back[0])], at, step >> 1)


class Places:
    """Bytes with all that their decisions depend on: the byte, the LONGEST before it and the hash of the word so far.

    Equal ones get one number, so that their decisions are worked out once. A table of fixed size leads to the numbers;
    where two share a slot the later one takes it, and the other gets a further number when it comes again. Numbers are
    told apart by the bytes themselves, so this costs work but no exactness."""

    def __init__(self):
        self.n, self.slot = 1, np.zeros(1 << PLACE_BITS, np.int32)
        self.near, self.word = np.full(1 << 16, np.iinfo(U64).max, U64), np.zeros(1 << 16, U32)  # number 0: none

    def numbers(self, data: np.ndarray, offsets: np.ndarray):
        """(number of each byte, the byte stream, first byte of each text)."""
        out, first = stream(data, offsets)
        back = before(out, first)
        near, word = out.astype(U64), word_so_far(out, back[0])
        for k, x in enumerate(back, 1):
            near |= x.astype(U64) << U64(8 * k)
        key = near * U64(0x9E3779B97F4A7C15)
        key ^= key >> U64(29)
        key += word
        key *= U64(0xBF58476D1CE4E5B9)
        at = (key >> U64(64 - PLACE_BITS)).view(np.int64)
        got = self.slot.take(at)
        new = np.flatnonzero((self.near.take(got) != near) | (self.word.take(got) != word))
        if len(new):
            near, word, at, own = near[new], word[new], at[new], np.arange(len(new), dtype=np.int32)
            self.slot[at] = own
            holder = self.slot.take(at)  # the last one of each slot
            lead = np.where((near.take(holder) == near) & (word.take(holder) == word), holder, own)
            leads = np.zeros(len(new), bool)
            leads[lead] = True
            number = self.n - 1 + np.cumsum(leads, dtype=np.int32)
            self.slot[at] = number.take(holder)
            got[new] = number.take(lead)
            end = int(number[-1]) + 1
            if end > len(self.near):
                self.near, self.word = (np.concatenate((x, np.zeros(end, x.dtype))) for x in (self.near, self.word))
            self.near[self.n : end], self.word[self.n : end] = near[leads], word[leads]
            self.n = end
        return got, out, first

    def decisions(self, trees: Trees):
        """By groups of numbers: (decisions, slots, place of each decision in the group, numbers from and to)."""
        for a in range(1, self.n, PIECE):
            b = min(self.n, a + PIECE)
            out, *back = ((self.near[a:b] >> U64(8 * k)).astype(np.uint8) for k in range(LONGEST + 1))
            step, at = trees.events(out, back[0], back[1])
            yield step, slots([*hashes(back), self.word[a:b]], at, step >> 1), at, a, b


def _table_sizes(trees: Trees) -> list[int]:
    return [-(-trees.nodes // SLICE) * SLICE, *(1 << b for b in BITS)]


SLICED = "slice int, part int, payload binary"


def _learn(block):
    @X.tidy
    def run(batches):
        trees = block.value
        sizes = _table_sizes(trees)
        begin = np.concatenate(([0], np.cumsum(sizes)))
        table = np.zeros(begin[-1] * 2, U32)
        seen = False
        for batch in batches:
            data, offsets = flat(pa.chunked_array([batch.column("body")]))
            places, got = Places(), []
            for a, b in pieces(offsets, PIECE):
                seen = True
                got.append(places.numbers(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[0])
            times = np.bincount(np.concatenate([np.zeros(0, np.int32), *got]), minlength=places.n).astype(U32)
            for step, where, at, a, b in places.decisions(trees):
                n = times[a:b].take(at)
                np.add.at(table[: begin[1] * 2], step, n)
                for t, x in enumerate(where, 1):
                    np.add.at(table[begin[t] * 2 : begin[t + 1] * 2], (x << 1) | (step & 1), n)
        part = TaskContext.get().partitionId()
        for i in range(begin[-1] // SLICE if seen else 0):
            own = table[i * SLICE * 2 : (i + 1) * SLICE * 2]
            if own.any():
                yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "part": pa.array([part], pa.int32()), "payload": pa.array([_squeeze(own)], pa.binary())})

    return run


def _squeeze(counts: np.ndarray) -> bytes:
    """Counts of a slice of the table, deflated: most are nought or small."""
    return zlib.compress(counts.astype(U32 if counts.max() < 1 << 32 else U64).tobytes(), 1)


def _wide(raw: bytes) -> np.ndarray:
    raw = zlib.decompress(raw)
    return np.frombuffer(raw, U32 if len(raw) == SLICE * 8 else U64).astype(U64)


@X.tidy
def _add(table: pa.Table) -> pa.Table:
    total = sum(_wide(x) for x in table["payload"].to_pylist())
    return pa.table({"slice": table["slice"][:1], "part": table["part"][:1], "payload": pa.array([_squeeze(total)], pa.binary())})


@X.tidy
def _log_odds(table: pa.Table) -> pa.Table:
    """Log-odds in 1/256, times four, and how much was seen in the two lowest bits."""
    n = sum(_wide(x) for x in table["payload"].to_pylist()).astype(np.float64).reshape(-1, 2)
    total = n.sum(1)
    odds = np.clip(np.log((n[:, 1] + 0.3) / (n[:, 0] + 0.3)), -12, 12)
    seen = (total > 0).astype(np.int16) + (total > 3) + (total > 40)
    code = (np.rint(odds * 256) * 4).astype(np.int16) + seen.astype(np.int16)
    return pa.table({"slice": table["slice"][:1], "part": table["part"][:1], "payload": pa.array([code.tobytes()], pa.binary())})


def _inputs(model: dict, step: np.ndarray, where: list[np.ndarray]):
    """(log-odds of the predictors, gate) for each decision."""
    table, begin = model["table"], model["begin"]
    codes = [table.take(step >> 1), *(table[begin[t] : begin[t + 1]].take(x) for t, x in enumerate(where, 1))]
    x = [(c >> 2).astype(np.float32) * np.float32(1 / 256) for c in codes]
    gate = ((codes[2] & 3) << 4 | (codes[3] & 3) << 2 | (codes[1] & 3)).astype(np.int64)
    return x, gate


# ---- gate weights ---------------------------------------------------------------------------------------------------


def _fit(block):
    @X.tidy
    def run(batches):
        model = block.value
        w = model["weights"].astype(np.float64).copy()
        seen, grad2 = np.zeros(GATES), np.full((GATES, INPUTS), 1e-2)
        for batch in batches:
            data, offsets = flat(pa.chunked_array([batch.column("body")]))
            for a, b in pieces(offsets, PIECE):
                step, where = _decisions(model["trees"], data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                x, gate = _inputs(model, step, where)
                x.append(np.full(len(step), 0.3, np.float32))
                bit = (step & 1).astype(np.float64)
                for i in range(0, len(step), STEP):
                    g, y = gate[i : i + STEP], bit[i : i + STEP]
                    own = np.stack([v[i : i + STEP] for v in x], 1)
                    p = 1 / (1 + np.exp(-np.clip((w[g] * own).sum(1), -20, 20)))
                    err = (y - p)[:, None] * own
                    n = np.bincount(g, minlength=GATES)
                    d = np.stack([np.bincount(g, err[:, k], GATES) for k in range(INPUTS)], 1) / np.maximum(1, n)[:, None]
                    live = n > 0
                    grad2[live] += d[live] ** 2
                    w[live] += 0.1 * d[live] / np.sqrt(grad2[live])
                    seen += n
        yield pa.RecordBatch.from_pydict({"w": pa.array([(w * seen[:, None]).tobytes()], pa.binary()), "n": pa.array([seen.tobytes()], pa.binary()), "part": pa.array([TaskContext.get().partitionId()], pa.int32())})


    return run


@X.tidy
def _mean(table: pa.Table) -> pa.Table:
    add = lambda c: pa.array([sum(np.frombuffer(x) for x in table[c].to_pylist()).tobytes()], pa.binary())
    return pa.table({"w": add("w"), "n": add("n"), "part": table["part"][:1]})


# ---- scoring --------------------------------------------------------------------------------------------------------


def byte_log_probabilities(model: dict, data: np.ndarray, offsets: np.ndarray):
    """(ln probability of each token by its bytes, bytes of each text). Tokens: each text's words, then its end."""
    if len(offsets) < 2:
        return np.zeros(0), np.zeros(0, np.int64)
    places, texts = Places(), []
    for a, b in pieces(offsets, PIECE):
        number, out, first = places.numbers(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        texts.append((number, np.flatnonzero((out == BLANK) | (out == END)) + 1, first))
    weights = model["weights"].astype(np.float32)
    # What adapts: the gain of the mixed log-odds, and the weight of the longest context; both towards the bit that came.
    moving, count = [], [np.zeros(1, np.int64)]
    for step, where, at, a, b in places.decisions(model["trees"]):
        x, gate = _inputs(model, step, where)
        base = np.zeros(len(step), np.float32)
        for k in range(INPUTS - 1):
            base += weights[:, k].take(gate) * x[k]
        base += weights[:, INPUTS - 1].take(gate) * np.float32(0.3)
        sign = (2 * (step & 1) - 1).astype(np.float32)
        both = np.empty((len(step), 2), np.float32)
        np.multiply(base, sign, out=both[:, 0])
        np.multiply(x[2], sign, out=both[:, 1])
        moving.append(both.view(np.complex64).ravel())  # looked up as one
        count.append(np.bincount(at, minlength=b - a))
    moving, count = np.concatenate(moving), np.concatenate(count)
    span = (np.cumsum(count) - count) << 10 | count
    out = [_adapted(number, ends, first, moving, span) for number, ends, first in texts]
    return np.concatenate(out), np.concatenate([np.diff(first) for _, _, first in texts])


def _adapted(number: np.ndarray, ends: np.ndarray, first: np.ndarray, moving: np.ndarray, span: np.ndarray) -> np.ndarray:
    """ln probability of each token, the weights refined block by block within each text.

    ``number``: of each byte; ``ends``: of tokens; ``first``: byte of each text; ``moving``: log-odds of all decisions;
    ``span``: each number's first decision << 10 | how many."""
    length = np.diff(first)
    # Bytes 0 to 31 of each text, 32 to 63, 64 to 127 and so on.
    most = int(length.max())
    edges = [0, *(32 << k for k in range(((most - 1) // 32).bit_length())), most]
    texts = [np.flatnonzero(length > lo) for lo in edges[:-1]]
    lows = np.concatenate([first[d] + lo for d, lo in zip(texts, edges)])
    sizes = np.concatenate([np.minimum(length[d], hi) - lo for d, lo, hi in zip(texts, edges, edges[1:])])
    order = np.arange(first[-1]) + np.repeat(lows - np.cumsum(sizes) + sizes, sizes)
    own = span.take(number.take(order))
    n = own & 1023
    stop = np.cumsum(n)
    at = np.repeat((own >> 10) - stop + n, n)
    at += np.arange(len(at))
    both = moving.take(at)
    base, far = np.ascontiguousarray(both.real), np.ascontiguousarray(both.imag)
    heads = np.append(0, stop[np.cumsum(sizes) - 1])  # first decision of each text in each block
    moved, curve = np.zeros((2, len(length)), np.float32), np.full((2, len(length)), DAMP, np.float32)
    logs = np.empty(len(base), np.float32)
    x = 0
    for k, d in enumerate(texts):
        lo, hi = heads[x], heads[x + len(d)]
        head = heads[x : x + len(d)] - lo
        v0, v1 = base[lo:hi], far[lo:hi]
        if k:
            many = np.diff(heads[x : x + len(d) + 1])
            z = np.repeat(moved[0, d] + np.float32(1), many)
            z *= v0
            z += np.repeat(moved[1, d], many) * v1
        else:
            z = v0.copy()
        np.clip(z, -16, 16, out=z)
        np.exp(z, out=z)
        z += 1
        err = np.reciprocal(z, out=z)
        p = 1 - err
        np.log(p + np.float32(1e-9), out=logs[lo:hi])
        if k + 1 < len(texts):
            p *= err
            for j, v in enumerate((v0, v1)):
                curve[j, d] += np.add.reduceat(p * v * v, head)
                moved[j, d] += np.add.reduceat(err * v, head) / curve[j, d]
            np.clip(moved, -0.4, 0.4, out=moved)
        x += len(d)
    # Tokens are whole but for the edges of blocks.
    new = np.zeros(len(order), bool)
    new[np.append(0, ends[:-1])] = True
    token, new = (np.cumsum(new) - 1).take(order), new.take(order)
    new[np.cumsum(sizes) - sizes] = True
    cut = np.flatnonzero(new)
    return np.bincount(token[cut], np.add.reduceat(logs, (stop - n)[cut]), len(ends))


def token_log_probabilities(by_bytes: np.ndarray, single: np.ndarray, pair: np.ndarray, triple: np.ndarray, first: np.ndarray, counted: np.ndarray, total: int) -> np.ndarray:
    """ln probability of each token: what its bytes give it, mixed with counts of the corpus.

    ``single``, ``pair``, ``triple``: how often the token, it and the one before, it and the two before occur in training
    texts (``total`` tokens); ``first``: each text's first token, and the end; ``counted``: texts among the training texts,
    whose own occurrences are left out."""
    n, size = len(by_bytes), np.diff(first)
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(n) - first[text]
    off = counted[text].astype(np.float64)
    single, pair, triple = (np.maximum(0, c - off) for c in (single, pair, triple))
    before, before2 = (np.append(0.0, c[:-1]) for c in (single, pair))
    before, before2 = before * (place > 0), before2 * (place > 1)
    by_single = single / np.maximum(1, total - off)
    by_pair = np.minimum(1, pair * (place > 0) / np.maximum(1, before))
    by_triple = np.minimum(1, triple * (place > 1) / np.maximum(1, before2))
    block = np.maximum(0, np.frexp((place // TOKEN_BLOCK).astype(np.float32))[1]).astype(np.uint8)
    order = np.argsort(block, kind="stable")
    cut = np.searchsorted(block[order], np.arange(int(block.max(initial=0)) + 2)).tolist()
    # All in the order of blocks, so that a block is a slice. Odds of minus infinity: no such context was seen.
    seen = [before2[order], before[order]]
    odds = [np.where(c > 0, a + b * np.log(np.maximum(1, c)), -np.inf) for (a, b), c in zip((TRIPLE, PAIR), seen)] + [np.full(n, SINGLE if total else -np.inf)]
    laws, text, by_bytes = [by_triple[order], by_pair[order], by_single[order]], text[order], by_bytes[order]
    chance = np.exp(by_bytes)
    moved, curve = np.zeros((3, len(size))), np.full((3, len(size)), TOKEN_DAMP)
    out = np.zeros(n)
    for b, (lo, hi) in enumerate(zip(cut, cut[1:])):
        if hi == lo:
            continue
        d = text[lo:hi]
        share = [1 / (1 + np.exp(np.minimum(50, -z[lo:hi] - m[d]))) * (z[lo:hi] > -np.inf) for z, m in zip(odds, moved)]
        rest, part = np.ones(hi - lo), []
        for q, law in zip(share, laws):
            part.append(rest * q * law[lo:hi])
            rest = rest * (1 - q)
        p = part[0] + part[1] + part[2] + rest * chance[lo:hi]
        out[lo:hi] = np.where(p > 1e-280, np.log(np.maximum(p, 1e-280)), np.log(rest) + by_bytes[lo:hi])
        if b + 2 < len(cut):
            head = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
            own, left = d[head], np.ones(hi - lo)
            p = np.maximum(p, 1e-280)
            for k in range(3):
                got = part[k] / p
                curve[k, own] += np.add.reduceat(left * share[k] * (1 - share[k]), head)
                moved[k, own] += np.add.reduceat(got - left * share[k], head) / curve[k, own]
                left = left - got
            np.clip(moved, -TOKEN_MOVE, TOKEN_MOVE, out=moved)
    back = np.empty(n)
    back[order] = out
    return back


def _tokens(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys with each text's end, first token of each text)."""
    return np.insert(keys, first[1:], U64(END_KEY)), first + np.arange(len(first))


def gram_bits(total: int) -> int:
    """Bits of the keys of pairs and triples in ``total`` bytes of text: about one of 200 shares its key by chance."""
    return max(32, min(56, max(1, total).bit_length() + 5))


def _grams(tokens: np.ndarray, first: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys of all pairs and triples, place of each one's last token, first of pairs and then of triples, how many are pairs)."""
    place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
    two, three = np.flatnonzero(place > 0), np.flatnonzero(place > 1)
    pair = tokens[two] + tokens[two - 1] * U64(0x9E3779B97F4A7C15)
    triple = tokens[three] + tokens[three - 1] * U64(0x9E3779B97F4A7C15) + tokens[three - 2] * U64(0xC2B2AE3D27D4EB4F) + U64(1)
    return mix(np.concatenate((pair, triple))) >> U64(64 - bits), np.concatenate((two, three)), len(two)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as deltas of so few bytes that nearly all fit, and the others besides."""
    d = np.diff(keys, prepend=U64(0))
    for width in range(1, 9):
        most = U64((1 << 8 * width) - 1)
        far = d >= most
        if width == 8 or far.mean() < 0.03:
            break
    low = np.ascontiguousarray(np.minimum(d, most).view(np.uint8).reshape(-1, 8)[:, :width])
    return b"".join([np.array([len(d), width, int(far.sum())], U64).tobytes(), low.tobytes(), d[far].tobytes()])


def _unpack_keys(raw: bytes) -> np.ndarray:
    n, width, m = (int(x) for x in np.frombuffer(raw, U64, 3))
    d = np.zeros((n, 8), np.uint8)
    d[:, :width] = np.frombuffer(raw, np.uint8, n * width, 24).reshape(-1, width)
    d = d.view(U64).ravel()
    d[d == U64((1 << 8 * width) - 1)] = np.frombuffer(raw, U64, m, 24 + n * width)
    return np.cumsum(d, dtype=U64)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts, most of them small: a byte each, deflated, and those of 255 or more besides."""
    low = zlib.compress(np.minimum(counts, 255).astype(np.uint8).tobytes(), 1)
    return len(low).to_bytes(8, "little") + low + counts[counts >= 255].astype(U64).tobytes()


def _widen(raw: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(raw[:8], "little")
    out = np.frombuffer(zlib.decompress(raw[8:end]), np.uint8).astype(np.float64)
    out[out == 255] = np.frombuffer(raw, U64, -1, end)
    return out


def _of_chunk(table: pa.Table):
    """(token keys of a chunk, first token of each text)."""
    data, offsets = flat(table["body"])
    keys, first = [np.zeros(0, U64)], [np.zeros(1, np.int64)]
    for a, b in pieces(offsets):
        own, begin = _token_keys(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        keys.append(own)
        first.append(begin[1:] + first[-1][-1])
    return _tokens(np.concatenate(keys), np.concatenate(first))


def _ask(buckets: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        tokens, first = _of_chunk(table)
        kinds = np.sort(tokens)
        asked = X.send(chunk, buckets, 60, kinds[np.append(True, kinds[1:] != kinds[:-1])])
        keys, at, _ = _grams(tokens, first, bits)
        counted = np.repeat(np.array(table["counted"].to_pylist(), bool), np.diff(first))[at]
        v = np.sort(keys << U64(1) | counted.astype(U64))
        keys = v >> U64(1)
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        n = np.add.reduceat((v & U64(1)).astype(np.uint32), head) if len(head) else np.zeros(0, np.uint32)
        keys = keys[head]
        cut = np.searchsorted(X.bucket_of(keys, bits, buckets), np.arange(buckets + 1)).tolist()
        rows = []
        for b, (x, y) in enumerate(zip(cut, cut[1:])):
            if y > x:
                packed = _pack_keys(keys[x:y])
                rows.append((buckets + b, len(packed).to_bytes(8, "little") + packed + _narrow(n[x:y])))
        return pa.concat_tables([asked, X.messages([b for b, _ in rows], [chunk] * len(rows), [p for _, p in rows])])

    return X.tidy(run)


def _reply(buckets: int, bits: int):
    def run(asked: pa.Table, counted: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return X.messages([], [], [])
        if asked["bucket"][0].as_py() >= buckets:
            return _add_grams(asked, bits)
        if not counted.num_rows:
            return X.messages([], [], [])
        known, n = _unpack_counts(counted["payload"][0].as_py())
        out = []
        for b, c, raw in zip(asked["bucket"].to_pylist(), asked["chunk"].to_pylist(), asked["payload"].to_pylist()):
            keys = X.unpack(raw)[0]
            keys = keys[X.member(keys, known)]
            if len(keys):
                out.append((b, c, _pack_counts(keys, n[np.searchsorted(known, keys)])))
        return X.messages(*zip(*out)) if out else X.messages([], [], [])

    return X.tidy(run)


def _add_grams(asked: pa.Table, bits: int) -> pa.Table:
    """Each chunk's pairs and triples with their counts over all chunks, in the order in which the chunk sent them."""
    keys, counts = [], []
    for raw in asked["payload"].to_pylist():
        end = 8 + int.from_bytes(raw[:8], "little")
        keys.append(_unpack_keys(raw[8:end]))
        counts.append(_widen(raw[end:]))
    cut = np.cumsum([0, *map(len, keys)]).tolist()
    every, order = _ordered(np.concatenate(keys), bits)
    new = np.append(True, every[1:] != every[:-1])
    total = np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(new))
    each = np.empty(len(every))
    each[order] = total[np.cumsum(new) - 1]
    return pa.table({"bucket": asked["bucket"], "chunk": asked["chunk"], "payload": pa.array([_narrow(each[x:y]) for x, y in zip(cut, cut[1:])], pa.binary())})


def _counts_of(tokens: np.ndarray, first: np.ndarray, answers: pa.Table, buckets: int, bits: int):
    """(training occurrences of each token, of it and the one before, of it and the two before)."""
    single = answers.filter(pc.less(answers["bucket"], buckets))
    got = [_unpack_counts(p) for p in single["payload"].to_pylist()]
    known, count = (np.concatenate([np.zeros(0, U64), *(g[i] for g in got)]) for i in (0, 1))
    known, order = _ordered(known, 60)
    count = count[order]
    sorted_, order = _ordered(tokens, 60)
    new = np.append(True, sorted_[1:] != sorted_[:-1]) if len(tokens) else np.zeros(0, bool)
    distinct = sorted_[new]
    hit = X.member(distinct, known)
    each = np.zeros(len(distinct))
    each[hit] = count[np.searchsorted(known, distinct[hit])]
    one = np.empty(len(tokens))
    one[order] = each[np.cumsum(new) - 1]
    keys, at, pairs = _grams(tokens, first, bits)
    keys, order = _ordered(keys, bits)
    new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    distinct = keys[new]
    cut = np.searchsorted(X.bucket_of(distinct, bits, buckets), np.arange(buckets + 1))
    total = np.zeros(len(distinct))
    more = answers.filter(pc.greater_equal(answers["bucket"], buckets))
    for b, raw in zip(more["bucket"].to_pylist(), more["payload"].to_pylist()):
        total[cut[b - buckets] : cut[b - buckets + 1]] = _widen(raw)
    each = np.empty(len(keys))
    each[order] = total[np.cumsum(new) - 1]
    two, three = np.zeros(len(tokens)), np.zeros(len(tokens))
    two[at[:pairs]], three[at[pairs:]] = each[:pairs], each[pairs:]
    return one, two, three


def _score(block, buckets: int, bits: int, kept: int):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        model = block.value
        tokens, first = _of_chunk(table)
        one, two, three = _counts_of(tokens, first, answers, buckets, bits)
        counted = np.array(table["counted"].to_pylist(), bool)
        gain = np.log10(one + 1)
        data, offsets = flat(table["body"])
        every, sizes = byte_log_probabilities(model, data, offsets)
        cols: list[list] = [[], [], [], [], []]
        for a, b in pieces(offsets, PIECE):
            x, y = int(first[a]), int(first[b])
            begin = first[a : b + 1] - x
            n = np.diff(begin)
            by_bytes, size = every[x:y], sizes[a:b]
            logs = token_log_probabilities(by_bytes, one[x:y], two[x:y], three[x:y], begin, counted[a:b], model["tokens"])
            score = np.add.reduceat(logs, begin[:-1]) / np.log(10)
            base = np.add.reduceat(gain[x:y], begin[:-1]) - n * np.log10(model["tokens"] + model["kinds"] + 1)
            for c, v in zip(cols, (n, np.add.reduceat(one[x:y] > 0, begin[:-1], dtype=np.int64), base, score, -score * np.log2(10) / size)):
                c.append(v)
        join = lambda i, kind: pa.array(np.concatenate([np.zeros(0), *cols[i]]).astype(kind))
        return pa.table(
            {f"k{i}": table[f"k{i}"] for i in range(kept)}
            | {"n_tokens": join(0, np.int64), "n_known": join(1, np.int64), "train_tokens": pa.array(np.full(table.num_rows, model["tokens"], np.int64)), "base_score": join(2, float), "score": join(3, float), "bits_per_byte": join(4, float)}
        )

    return X.tidy(run)


def train(docs: DataFrame, body: str = "body", counted: str = "counted", doc_id: str = "id", size: int | None = None) -> tuple[dict, DataFrame, int]:
    """(model, table of token counts, its buckets) from the rows of docs that are ``counted``."""
    spark = docs.sparkSession
    X.small_batches(spark)
    rows = docs.filter(counted).select(F.col(doc_id).alias("id"), F.coalesce(F.col(body), F.lit("")).alias("body"))
    size = X.measure(docs, body) if size is None else size
    buckets = X.counts(size)[1]
    sums = X.settle(X.spread(rows.select("body").mapInArrow(_count(buckets), "bucket int, payload binary"), buckets, "bucket").applyInArrow(_total, COUNTED))
    total = sums.filter("bucket >= 0").agg(F.sum("total").alias("n"), F.sum("kinds").alias("v")).first()
    # Byte trigrams: sixteen rows, bounded by the number of trigrams there are.
    grams = [_unpack_counts(r.payload) for r in sums.filter("bucket < 0").select("payload").collect()]
    trees = Trees(np.concatenate([np.zeros(0, np.int64), *(g[0].astype(np.int64) for g in grams)]), np.concatenate([np.zeros(0), *(g[1].astype(float) for g in grams)]))

    apart = F.pmod(F.xxhash64(F.lit(40), "id"), F.lit(SHARE)) == 0
    aside = X.settle(rows.filter(apart).select("body"))  # read twice
    block = spark.sparkContext.broadcast(trees)
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
    groups = max(1, int(tasks**0.5))
    learned = lambda df: df.select("body").mapInArrow(_learn(block), SLICED)
    parts = learned(rows.filter(~apart).coalesce(tasks)).withColumn("part", F.pmod("part", F.lit(groups)))
    most = X.settle(parts.groupBy("slice", "part").applyInArrow(_add, SLICED))
    begin = np.concatenate(([0], np.cumsum(_table_sizes(trees))))

    def log_odds(counts: DataFrame) -> np.ndarray:
        table = np.zeros(begin[-1], np.int16)
        for r in counts.groupBy("slice").applyInArrow(_log_odds, SLICED).collect():  # slices of tables of fixed size
            table[r.slice * SLICE : (r.slice + 1) * SLICE] = np.frombuffer(r.payload, np.int16)
        return table

    weights = np.full((GATES, INPUTS), 0.3)
    weights[:, -1] = 0
    model = {"trees": trees, "table": log_odds(most), "begin": begin, "weights": weights, "tokens": int(total.n or 0), "kinds": int(total.v or 0)}
    block_fit = spark.sparkContext.broadcast(model)
    fitted = aside.mapInArrow(_fit(block_fit), "w binary, n binary, part int").withColumn("part", F.pmod("part", F.lit(groups)))
    fitted = fitted.groupBy("part").applyInArrow(_mean, "w binary, n binary, part int").select("w", "n", F.lit(0).alias("part")).groupBy("part").applyInArrow(_mean, "w binary, n binary, part int").collect()
    block_fit.unpersist()
    if fitted:
        w, n = np.frombuffer(fitted[0].w).reshape(GATES, INPUTS), np.frombuffer(fitted[0].n)[:, None]
        model = model | {"weights": np.where(n > 0, w / np.maximum(1, n), weights), "table": log_odds(most.union(learned(aside.coalesce(max(1, tasks // SHARE)))))}
    return model, sums, buckets


def lm_score(docs: DataFrame, learns=None, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.

    ``learns``: condition on doc_id for texts that may be learned from; all that have a doc_id, if none."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    results = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    owner = F.col(f"`{doc_id}`")
    counted = owner.isNotNull() & (F.lit(True) if learns is None else F.coalesce(learns(owner), F.lit(False)))
    size = X.measure(docs, text)
    model, sums, buckets = train(docs.select(owner.alias("id"), F.col(f"`{text}`").cast("string").alias("body"), counted.alias("counted")), size=size)
    block = docs.sparkSession.sparkContext.broadcast(model)
    chunks, bits = X.counts(size)[0], gram_bits(size)
    base = X.chunked(docs, keep, text, chunks, counted=counted)
    asked = base.groupBy("chunk").applyInArrow(_ask(buckets, bits), X.MESSAGE)
    known = sums.filter("bucket >= 0").select(F.col("bucket").alias("b"), "payload")
    answers = X.spread(asked, 2 * buckets, "bucket").cogroup(known.groupBy("b")).applyInArrow(_reply(buckets, bits), X.MESSAGE)
    out = base.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(block, buckets, bits, len(keep)), f"{X.kept_schema(docs, keep)}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double".lstrip(", ")
    )
    return X.renamed(out, keep, results)


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    out = lm_score(docs, learns=lambda c: remainder(c, 7) != 2, keep=["doc_id"])
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
