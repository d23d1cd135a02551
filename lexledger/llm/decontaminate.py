"""Benchmark decontamination with suffix arrays over the training documents.

Each shard (a few MB of consecutive documents) gets a word-level suffix array, by prefix doubling over the groups that
are still tied. Every suffix of every benchmark item is then binary-searched in it, all suffixes at once, one word
deeper per step, down to the window; the interval left holds every place of that window. Matches on one diagonal of
(item, document) join to the longest verbatim matches. Documents are judged by the share of their words inside.

No shuffle: the shards are built where the documents are read. The benchmark, the stated query set, comes in blocks
of at most BLOCK_BYTES of text; a block is broadcast, and a larger benchmark simply takes more passes, each adding its
spans and items to what the documents carry. Nothing is collected from the documents.

Defined results: null or empty text has no words and is never contaminated; items without words match nothing; items
of the same id count once; repeated rows each get their row; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .kernel import LOWER, U64, cover, flat, runs, spans, word_hashes

SHARD_BYTES = 5 << 20
BLOCK_BYTES = 32 << 20

# A word is a run of digits, lower-case letters (after lower-casing A-Z) and bytes of characters beyond ASCII.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of words, first word of each text)."""
    low = LOWER[data]
    starts, ends, first = spans(low, offsets, WORD)
    return word_hashes(low, starts, ends), first


def suffix_array(words: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by their next ``depth`` words at least; a suffix ends with its text (``room`` words)."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    new = np.append(True, words[order][1:] != words[order][:-1]) if n else np.zeros(0, bool)
    start = np.flatnonzero(new)
    group = start[np.cumsum(new) - 1] if n else start
    rank = np.empty(n, np.int64)
    rank[order] = group + 1
    sa, k = order.copy(), 1
    size = np.diff(np.append(start, n))
    tied = order[np.repeat(size > 1, size)]
    while k < depth and len(tied):
        after = np.zeros(len(tied), np.int64)
        inside = room[tied] > k
        after[inside] = rank[tied[inside] + k]
        key = rank[tied] * (n + 1) + after
        o = np.argsort(key, kind="stable")
        tied, key = tied[o], key[o]
        old = rank[tied]
        head = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        slot = old + np.arange(len(tied)) - np.repeat(head, np.diff(np.append(head, len(tied))))
        sa[slot - 1] = tied
        new = np.append(True, key[1:] != key[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(tied)))
        rank[tied] = np.repeat(slot[start], size)
        tied = tied[np.repeat(size > 1, size)]
        k *= 2
    return sa


def search(words: np.ndarray, room: np.ndarray, sa: np.ndarray, queries: np.ndarray, at: np.ndarray, need: np.ndarray):
    """Binary search of the suffixes queries[a : a + m] for a, m in zip(at, need): their intervals in ``sa``."""
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(sa))
    live, depth = np.arange(len(at)), 0
    by_word = words[sa]
    while len(live):
        want = queries[at[live] + depth]
        if depth == 0:
            lo[live], hi[live] = np.searchsorted(by_word, want, "left"), np.searchsorted(by_word, want, "right")
        else:
            lower, upper = lo[live].copy(), hi[live].copy()
            for right in (False, True):
                a, b = lower.copy(), upper.copy()
                while True:
                    busy = a < b
                    if not busy.any():
                        break
                    mid = (a + b) >> 1
                    place = sa[np.minimum(mid, len(sa) - 1)]
                    there = room[place] > depth
                    value = words[np.where(there, place + depth, 0)]
                    below = ~there | ((value <= want) if right else (value < want))
                    a, b = np.where(busy & below, mid + 1, a), np.where(busy & ~below, mid, b)
                if right:
                    hi[live] = a
                else:
                    lo[live] = a
        depth += 1
        live = live[(hi[live] > lo[live]) & (need[live] > depth)]
    return lo, hi


def prepare(rows, window: int) -> dict:
    """A block of the benchmark as arrays: words of the distinct items, and the suffixes to search."""
    texts = pa.array([t or "" for _, t in rows], pa.string())
    words, first = words_of(*flat(texts))
    seen: dict[bytes, set[str]] = {}
    for i, (name, _) in enumerate(rows):
        if first[i + 1] > first[i]:
            seen.setdefault(words[first[i] : first[i + 1]].tobytes(), set()).add("" if name is None else str(name))
    items = [np.frombuffer(k, U64) for k in seen]
    size = np.array([len(x) for x in items], np.int64)
    begin = np.concatenate(([0], np.cumsum(size)))
    need = np.minimum(size, window)
    count = size - need + 1
    which = np.repeat(np.arange(len(items)), count)
    at = begin[which] + np.arange(len(which)) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])) if len(count) else count, count)
    return {"words": np.concatenate([np.zeros(0, U64), *items]), "at": at, "need": need[which], "item": which, "names": [sorted(x) for x in seen.values()], "window": window}


def _match(words: np.ndarray, first: np.ndarray, q: dict):
    """Occurrences of the block's windows: (place, length, item, start in the item's words)."""
    room = np.repeat(first[1:], np.diff(first)) - np.arange(len(words))
    sa = suffix_array(words, room, q["window"])
    lo, hi = search(words, room, sa, q["words"], q["at"], q["need"])
    n = hi - lo
    total = int(n.sum())
    who = np.repeat(np.arange(len(n)), n)
    place = sa[np.arange(total) + np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else n, n)] if total else np.zeros(0, np.int64)
    return place, q["need"][who], q["item"][who], q["at"][who]


def _longest(place, length, item, at):
    """Runs of windows on one diagonal: (place of the first, words of the whole verbatim match)."""
    o = np.lexsort((place, place - at))
    p, d, m = place[o], (place - at)[o], length[o]
    new = np.append(True, (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1) | (item[o][1:] != item[o][:-1]))
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(p)) - 1
    return p[head], p[last] - p[head] + m[last]


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _scan(block, kept: int):
    @X.tidy
    def run(batches):
        q = block.value
        for table in X.gathered(batches, SHARD_BYTES):
            words, first = words_of(*flat(table["body"]))
            n = table.num_rows
            hit, found, longest = np.zeros(len(words), bool), [()] * n, np.zeros(n, np.int64)
            if len(q["at"]) and len(words):
                place, length, item, at = _match(words, first, q)
                if len(place):
                    for size in np.unique(length):
                        hit |= cover(np.unique(place[length == size]), int(size), len(words))
                    doc = np.searchsorted(first, place, "right") - 1
                    pairs = np.unique(doc * len(q["names"]) + item)
                    for d, i in zip((pairs // len(q["names"])).tolist(), (pairs % len(q["names"])).tolist()):
                        found[d] = (*found[d], *q["names"][i])
                    p, m = _longest(place, length, item, at)
                    np.maximum.at(longest, np.searchsorted(first, p, "right") - 1, m)
            spans_old, items_old, long_old = table["spans"].to_pylist(), table["items"].to_pylist(), table["longest"].to_numpy()
            s, e = runs(hit)
            who = np.searchsorted(first, s, "right") - 1
            own: dict[int, list] = {}
            for d in np.unique(np.concatenate([who, np.searchsorted(first, e - 1, "right") - 1])).tolist() if len(s) else ():
                x, y = int(first[d]), int(first[d + 1])
                own[d] = [{"start": int(a), "end": int(b)} for a, b in zip(*runs(hit[x:y]))]
            for i in range(n):
                if spans_old[i] and i in own:
                    mask = np.zeros(int(first[i + 1] - first[i]), bool)
                    for r in (*spans_old[i], *own[i]):
                        mask[r["start"] : r["end"]] = True
                    own[i] = [{"start": int(a), "end": int(b)} for a, b in zip(*runs(mask))]
                elif spans_old[i]:
                    own[i] = spans_old[i]
            out = pa.table(
                {f"k{i}": table[f"k{i}"] for i in range(kept)}
                | {"body": table["body"], "n_words": pa.array(np.diff(first), pa.int64()), "spans": pa.array([own.get(i, []) for i in range(n)], pa.list_(SPAN)), "items": pa.array([sorted({*items_old[i], *found[i]}) if found[i] else items_old[i] for i in range(n)], pa.list_(pa.string())), "longest": pa.array(np.maximum(longest, long_old), pa.int64())}
            )
            yield from out.combine_chunks().to_batches(max_chunksize=4000)

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, text: str = "text", keep: list[str] | None = None, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The kept columns with n_words, spans (hit word runs, end exclusive), items (ids, sorted as strings), longest
    (words of the longest verbatim match) and n_hit."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    spark = docs.sparkSession
    X.small_batches(spark)
    bench = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{item_text}`").cast("string").alias("t"))
    blocks = max(1, math.ceil(X.measure(bench, "t") / BLOCK_BYTES))
    out = docs.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("body"),
        F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"), F.array().cast("array<string>").alias("items"), F.lit(0).cast("bigint").alias("longest"),
    )
    cols = "".join(f"k{i} {out.schema[f'k{i}'].dataType.simpleString()}, " for i in range(len(keep)))
    for b in range(blocks):
        part = bench.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        block = spark.sparkContext.broadcast(prepare([(r.i, r.t) for r in part.toLocalIterator()], window))
        out = out.mapInArrow(_scan(block, len(keep)), f"{cols}body string, n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>, longest bigint")
    out = out.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"]))
    return X.renamed(out, keep, ["n_words", "n_hit", "spans", "items", "longest"])


def is_contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"), F.col("longest").alias("longest_match"))
