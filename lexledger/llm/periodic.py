"""Periodic runs of words (loops, stuck generators, repeated boilerplate) found and collapsed inside each document.

A run is a stretch of consecutive words with smallest period q, at least max(MIN_WORDS, TIMES * q) words long, that no
neighbouring word extends. Repeated k-gram masking comes first: words q apart agree over at least
``k = min over q of max(MIN_WORDS, TIMES * q) - q`` words of a run, so every word of it lies in a k-gram that occurs twice
in its document. Words outside such k-grams can't join runs; the stretches of words left are the surviving segments, and a
run is whole inside one of them. Only these are searched, by Main and Lorentz: halve a segment again and again, and for
each middle and each period q extend the equality of words q apart to both sides, once with the second word right of the
middle and once with the first word left of it. All middles of one depth, over all documents of a batch, are one numpy step;
a period counts as a candidate only if (k + 1) // 2 words beside the middle agree with those q away, which any run
must have on one side. Extensions are found by bisection on rolling hashes, then every run is held against
the words themselves, and mended by a plain scan should a hash have been wrong.

One narrow pass: documents are independent, nothing is shuffled, a batch holds at most PIECE bytes of text or one document.

Defined results: null or empty text has no words and no runs; white space is what separates words, and kept words are
joined by one space; a repeated row is a document of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .kernel import U64, WORD_POWERS, cover, flat, mix, pieces, rolling, runs, spans, word_hashes

MIN_WORDS, TIMES = 24, 3
PIECE = 4 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_SQL = "array<struct<start: bigint, length: bigint, period: bigint>>"


@functools.cache
def overlap(least: int, times: int) -> int:
    """Words of a run that are equal to words one period away, at least."""
    return min(max(least, times * q) - q for q in range(1, least + 1))


def survivors(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments [start, end) of words inside k-grams that occur twice or more in their document."""
    h, at = rolling(words, first, k)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[at]
    key = mix(h + doc.astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    s = key[order]
    same = s[1:] == s[:-1]
    again = np.zeros(len(s), bool)
    again[1:] = same
    again[:-1] |= same
    mask = cover(at[order[again]], k, len(words))
    starts, ends = runs(mask)
    # Segments of two documents can touch.
    cut = first[1:-1]
    cut = cut[(cut > 0) & (cut < len(words))]
    cut = cut[mask[cut] & mask[cut - 1]] if len(cut) else cut
    return np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))


class Extend:
    """How far words q apart stay equal, to the right and to the left, inside a segment."""

    def __init__(self, words: np.ndarray):
        self.up, self.down = WORD_POWERS.get(len(words) + 1)
        self.total = np.zeros(len(words) + 1, U64)
        np.cumsum(words * self.up[: len(words)], out=self.total[1:])

    def _same(self, a, b, size):
        return (self.total[a + size] - self.total[a]) * self.up[b - a] == self.total[b + size] - self.total[b]

    def right(self, a, b, end):
        """Largest m with words[a:a+m] == words[b:b+m] and b + m <= end."""
        lo, hi = np.zeros(len(a), np.int64), end - b
        while (live := np.flatnonzero(lo < hi)).size:
            m = (lo[live] + hi[live] + 1) >> 1
            ok = self._same(a[live], b[live], m)
            lo[live], hi[live] = np.where(ok, m, lo[live]), np.where(ok, hi[live], m - 1)
        return lo

    def left(self, a, b, begin):
        """Largest m with words[a-m:a] == words[b-m:b] and a - m >= begin."""
        lo, hi = np.zeros(len(a), np.int64), a - begin
        while (live := np.flatnonzero(lo < hi)).size:
            m = (lo[live] + hi[live] + 1) >> 1
            ok = self._same(a[live] - m, b[live] - m, m)
            lo[live], hi[live] = np.where(ok, m, lo[live]), np.where(ok, hi[live], m - 1)
        return lo


#: Pairs of (middle, period) looked at in one step.
PAIRS = 1 << 21


def main_lorentz(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int = MIN_WORDS, times: int = TIMES) -> np.ndarray:
    """Rows (start, end, period) of all runs inside the segments, sorted."""
    near = (overlap(least, times) + 1) // 2
    extend, found = Extend(words), []
    gram = np.zeros(len(words), U64)
    if len(words) >= near:
        gram[: len(words) - near + 1] = rolling(words, np.array([0, len(words)]), near)[0]
    lo, hi, begin, end = starts, ends, starts, ends
    while True:
        big = hi - lo >= least
        lo, hi, begin, end = lo[big], hi[big], begin[big], end[big]
        if not len(lo):
            break
        mid = (lo + hi) >> 1
        most = (hi - lo) // times
        for a, b in pieces(np.concatenate(([0], np.cumsum(most))), PAIRS):
            n = most[a:b]
            node = np.repeat(np.arange(a, b), n)
            q = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n) + 1
            for x, y in ((mid[node], mid[node] + q), (mid[node] - q, mid[node])):  # y = x + q
                inside = (x >= lo[node]) & (y <= hi[node])
                ahead = inside & (y + near <= end[node])
                ahead[ahead] = gram[x[ahead]] == gram[y[ahead]]
                behind = inside & ~ahead & (x - near >= begin[node])
                behind[behind] = gram[x[behind] - near] == gram[y[behind] - near]
                at = np.flatnonzero(ahead | behind)
                if len(at):
                    w, xx, yy = node[at], x[at], y[at]
                    r, s = extend.right(xx, yy, end[w]), extend.left(xx, yy, begin[w])
                    found.append(np.stack([xx - s, yy + r, q[at]], 1))
        lo, hi, begin, end = np.concatenate([lo, mid]), np.concatenate([mid, hi]), np.tile(begin, 2), np.tile(end, 2)
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.concatenate(found)
    rows = rows[rows[:, 1] - rows[:, 0] >= np.maximum(least, times * rows[:, 2])]
    return _exact(words, np.unique(rows, axis=0), starts, ends, least, times)


def _exact(words, rows, starts, ends, least, times):
    """The runs as the words themselves have them; rows come by start, end and period."""
    out, done = [], None
    for s, e, q in rows.tolist():
        if done == (s, e):  # a multiple of the smallest period
            continue
        if (words[s : e - q] == words[s + q : e]).all():
            out.append((s, e, q))
            done = (s, e)
            continue
        # A hash took different words for equal ones: all stretches with this period in the segment.
        at = int(np.searchsorted(starts, s, "right")) - 1
        a, b = int(starts[at]), int(ends[at])
        for x, y in zip(*runs(words[a : b - q] == words[a + q : b])):
            if y - x + q >= max(least, times * q):
                out.append((a + int(x), a + int(y) + q, q))
    out.sort()
    return np.array([r for i, r in enumerate(out) if not i or r[:2] != out[i - 1][:2]], np.int64).reshape(-1, 3)


def _scan(kept: int, least: int, times: int):
    k = overlap(least, times)

    @X.tidy
    def run(batches):
        for table in X.gathered(batches, PIECE):
            data, offsets = flat(table["body"])
            begin, stop, first = spans(data, offsets)
            words = word_hashes(data, begin, stop)
            starts, ends = survivors(words, first, k)
            found = main_lorentz(words, starts, ends, least, times)
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, found[:, 0] + found[:, 2], 1)
            np.add.at(gone, found[:, 1], -1)
            gone = np.cumsum(gone)[:-1] > 0
            of = np.searchsorted(found[:, 0], first)
            raw, lost, listed, texts = data.tobytes(), [], [], []
            for i in range(table.num_rows):
                x, y = int(first[i]), int(first[i + 1])
                own = raw[offsets[i] : offsets[i + 1]].split()
                mask = gone[x:y]
                if mask.any():
                    own = [w for w, g in zip(own, mask.tolist()) if not g]
                lost.append(y - x - len(own))
                listed.append([{"start": s - x, "length": e - s, "period": q} for s, e, q in found[of[i] : of[i + 1]].tolist()])
                texts.append(b" ".join(own).decode("utf-8"))
            out = {f"k{i}": table[f"k{i}"] for i in range(kept)} | {"n_words": pa.array(np.diff(first), pa.int64()), "n_removed": pa.array(lost, pa.int64()), "runs": pa.array(listed, pa.list_(RUN)), "collapsed_text": pa.array(texts, pa.string())}
            yield from pa.table(out).combine_chunks().to_batches(max_chunksize=2000)

    return run


def periodic_runs(docs: DataFrame, least: int = MIN_WORDS, times: int = TIMES, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with n_words, n_removed, runs (start, length, period; by start, then period) and collapsed_text:
    the words that no run contains after its first period, joined by one space."""
    if times < 2 or least < times:
        raise ValueError("a run has two periods at least, and as many words")
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    X.small_batches(docs.sparkSession)
    base = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("body"))
    cols = "".join(f"k{i} {base.schema[f'k{i}'].dataType.simpleString()}, " for i in range(len(keep)))
    return X.renamed(base.mapInArrow(_scan(len(keep), least, times), f"{cols}n_words bigint, n_removed bigint, runs {RUN_SQL}, collapsed_text string"), keep, ["n_words", "n_removed", "runs", "collapsed_text"])


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text), where about one text in ten, chosen by its id, repeats its own words from some place on."""
    hash_ = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary"))
    rewritten = F.expr(r"""
        transform(array(named_struct('w', regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+', 0), 'g', h div 10)), d ->
          transform(array(named_struct('w', d.w, 'a', d.g % size(d.w), 'p', 1 + (size(d.w) - d.g % size(d.w)) div (3 + d.g % 8))), e ->
            array_join(transform(e.w, (x, i) -> CASE WHEN i < e.a THEN x ELSE e.w[CAST(e.a + (i - e.a) % e.p AS INT)] END), ' '))[0])[0]""")
    base = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("t"), hash_.alias("h"))
    return base.select("doc_id", F.when((F.col("h") % 10 == 0) & F.col("t").rlike(r"[^\x20\x09-\x0D]"), rewritten).otherwise(F.col("t")).alias("text"))


def op13(spark, sf_dir: str) -> DataFrame:
    """Per document: number of runs, the one with most periods, digests of all runs and of the collapsed text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = periodic_runs(planted(docs), keep=["doc_id"])
    # length / period is compared exactly, by cross products.
    best = F.expr("""
        aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), (b, r) ->
          CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period OR (r.length * b.period = b.length * r.period AND (r.start < b.start OR (r.start = b.start AND r.period < b.period))) THEN r ELSE b END)""")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return out.select("doc_id", "runs", "collapsed_text", best.alias("b"), lines.alias("lines")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("b.start").alias("start"), F.col("b.length").alias("length"), F.col("b.period").alias("period"),
        F.expr("b.length * 1000 div b.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat("lines", F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"), F.sha2(F.coalesce("collapsed_text", F.lit("")), 256).alias("collapsed_sha256"),
    )

