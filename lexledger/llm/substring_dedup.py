"""Substring dedup over words, by fixed-block anchors.

Index: every text is cut into non-overlapping blocks of (window + 1) // 2 words. Whatever the alignment, a window of
``window`` words holds one such block whole. Probe: every rolling run of that many words is looked up among the
blocks; a block that occurs a second time anywhere is an *anchor*. Extend: around each anchor the full windows are
hashed (64 + 32 bits) and compared across the corpus; neighbouring repeated windows merge into maximal exact repeats.

Three narrow passes over chunks and two exchanges of packed keys; see exchange.py for how skew is handled.

Defined results: null or empty text has no words; a text shorter than the window loses nothing; repeated rows are
separate texts, so each counts as "elsewhere" for the other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .kernel import U64, WORD_POWERS_2, cover, flat, pieces, rolling, runs, spans, word_hashes

ANCHOR_BITS = 48


def _texts(table):
    """Rolling over a chunk's texts: (first row, last row, hashes of words, first word of each row)."""
    data, offsets = flat(table["body"])
    for a, b in pieces(offsets):
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = spans(part, off)
        yield a, b, word_hashes(part, starts, ends), first


def _probes(buckets: int, block: int, bits: int):
    @X.tidy
    def run(table: pa.Table) -> pa.Table:
        keys = []
        for _, _, words, first in _texts(table):
            h, at = rolling(words, first, block)
            start = np.repeat(first[:-1], np.diff(first))[at]
            keys.append((h >> U64(64 - bits)) << U64(1) | ((at - start) % block == 0).astype(U64))
        keys, flags = X.distinct(np.concatenate(keys) if keys else np.zeros(0, U64))
        return X.send(table["chunk"][0].as_py(), buckets, bits, keys, flags)

    return run


def _candidates(buckets: int, window: int, block: int, bits: int):
    @X.tidy
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        first_keys, second = [np.zeros(0, U64)], [np.zeros(0, np.uint32)]
        anchors = X.keys_of(answers)
        for _, _, words, first in _texts(table) if len(anchors) and table.num_rows else ():
            h, at = rolling(words, first, block)
            hit = np.zeros(len(words) + 1, np.int64)
            hit[at + 1] = X.member(h >> U64(64 - bits), anchors)
            hit = np.cumsum(hit)
            h, at = rolling(words, first, window)
            near = hit[at + window - block + 1] > hit[at]
            first_keys.append(h[near] >> U64(2))
            second.append((rolling(words, first, window, WORD_POWERS_2)[0][near] >> U64(32)).astype(np.uint32))
        keys, at, n = np.unique(np.concatenate(first_keys), return_index=True, return_counts=True)
        if not len(keys):
            return X.messages([], [], [])
        return X.send(table["chunk"][0].as_py(), buckets, 62, keys, np.concatenate(second)[at], (n > 1).astype(np.uint8))

    return run


@X.tidy
def _repeats(table: pa.Table) -> pa.Table:
    """Windows that start in two places at least, told to every chunk that has them."""
    got = [X.unpack(p, np.uint32, np.uint8) for p in table["payload"].to_pylist()]
    k, s, m = (np.concatenate([g[i] for g in got]) for i in range(3))
    who = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
    order = np.lexsort((s, k))
    k, s, m, who = k[order], s[order], m[order], who[order]
    new = np.append(True, (k[1:] != k[:-1]) | (s[1:] != s[:-1]))
    at = np.flatnonzero(new)
    twice = (np.diff(np.append(at, len(k))) > 1) | (np.maximum.reduceat(m, at) > 0)
    keep = twice[np.cumsum(new) - 1]
    k, who = k[keep], who[keep]
    return X.answer(table, [np.sort(k[who == i]) for i in range(len(got))])


def _cut(window: int, kept: int):
    @X.tidy
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        again = X.keys_of(answers)
        n_words, n_removed, spans_out, texts = [], [], [], []
        bodies = table["body"]
        for a, b, words, first in _texts(table):
            h, at = rolling(words, first, window)
            gone = cover(at[X.member(h >> U64(2), again)], window, len(words))
            for i in range(a, b):
                x, y = int(first[i - a]), int(first[i - a + 1])
                mask = gone[x:y]
                own = (bodies[i].as_py() or "").encode("utf-8").split()
                k = int(mask.sum())
                if k:
                    own = [w for w, g in zip(own, mask.tolist()) if not g]
                s, e = runs(mask) if k else ((), ())
                n_words.append(y - x)
                n_removed.append(k)
                spans_out.append([{"start": int(p), "end": int(q)} for p, q in zip(s, e)])
                texts.append(b" ".join(own).decode("utf-8"))
        return pa.table({f"k{i}": table[f"k{i}"] for i in range(kept)} | {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "removed": pa.array(spans_out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept_text": pa.array(texts, pa.string())})

    return run


def substring_dedup(docs: DataFrame, window: int = 35, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with n_words, n_removed, removed (word spans, end exclusive) and kept_text (words joined by
    one space). Every word covered by a window of ``window`` words that also starts elsewhere goes, first copy too."""
    if window < 2:
        raise ValueError("a window has two words at least")
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    results = ["n_words", "n_removed", "removed", "kept_text"]
    block = (window + 1) // 2
    total = X.measure(docs, text)
    chunks, buckets = X.counts(total)
    bits = ANCHOR_BITS if total < 1 << 40 else 60
    base = X.chunked(docs, keep, text, chunks)
    chunk = lambda df: df.groupBy("chunk")
    anchors = chunk(base).applyInArrow(_probes(buckets, block, bits), X.MESSAGE).groupBy("bucket").applyInArrow(X.repeated, X.MESSAGE)
    found = chunk(base).cogroup(chunk(anchors)).applyInArrow(_candidates(buckets, window, block, bits), X.MESSAGE)
    again = found.groupBy("bucket").applyInArrow(_repeats, X.MESSAGE)
    out = chunk(base).cogroup(chunk(again)).applyInArrow(
        _cut(window, len(keep)), f"{X.kept_schema(docs, keep)}, n_words bigint, n_removed bigint, removed array<struct<start: bigint, end: bigint>>, kept_text string".lstrip(", ")
    )
    return X.renamed(out, keep, results)


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = substring_dedup(docs, 35, keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
