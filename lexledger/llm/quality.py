"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader.

Tokens are maximal runs of word bytes (letters, digits, anything beyond ASCII) or of other visible bytes, case kept, so
"!!" or "|" are words of their own. Token 1- and 2-grams hash into BUCKETS weights; a document is the sparse vector of
its gram counts over their number (plus a constant). FTRL-proximal with elastic net learns the weights in one task from at most
MAX_TRAIN labelled documents, those of least xxhash64(doc_id): a documented bound that doesn't grow with the input.
Scoring is one narrow pass over the whole texts, a sparse dot product for each document; no shuffle.

Labels come only from rows with crc32(doc_id as text) mod 4 other than 2. Only the text enters a score.

Defined results: null or empty text scores by the intercept alone; labels other than 0 and 1 don't count, and a doc_id with
several labels takes their least; documents without a doc_id never train and are not held out (the remainder is
null: held_out false); repeated rows each get their row; without any usable label every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .kernel import IS_SPACE, U64, flat, mix, pieces, word_hashes

BITS = 18
BUCKETS = 1 << BITS
#: Most documents that train, and their passes.
MAX_TRAIN, EPOCHS = 12_000, 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.02

KIND = np.full(256, 2, np.uint8)
KIND[IS_SPACE] = 0
KIND[0x30:0x3A] = KIND[0x41:0x5B] = KIND[0x61:0x7B] = KIND[0x80:] = 1


#: All 2-grams of a token and itself are one gram.
SAME = mix(np.array([2], U64))[0]
#: Added to the number of grams, so that a few words don't outweigh the intercept.
PRIOR = 20


def tokens(data: np.ndarray, offsets: np.ndarray):
    """(hashes, first token of each text) of runs of one kind."""
    kind = KIND[data]
    new = np.ones(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new[offsets[offsets < len(data)]] = True
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(data))
    solid = kind[at] > 0
    starts, ends = at[solid], ends[solid]
    return word_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def grams(data: np.ndarray, offsets: np.ndarray):
    """(buckets of all 1- and 2-grams, text of each)."""
    h, first = tokens(data, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    pair = np.where(h[:-1] == h[1:], SAME, mix(h[:-1] * U64(3) + h[1:]))
    same = doc[:-1] == doc[1:]
    shift = U64(64 - BITS)
    return np.concatenate([(h >> shift), (pair >> shift)[same]]).astype(np.int64), np.concatenate([doc, doc[:-1][same]])


@X.tidy
def _vectors(batches):
    for batch in batches:
        data, offsets = flat(pa.chunked_array([batch.column("body")]))
        out = []
        for a, b in pieces(offsets):
            g, doc = grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            order = np.argsort(doc, kind="stable")
            cut = np.searchsorted(doc[order], np.arange(b - a + 1))
            for i in range(b - a):
                f, n = np.unique(g[order[cut[i] : cut[i + 1]]], return_counts=True)
                out.append(f.astype(np.uint32).tobytes() + (n / (PRIOR + n.sum())).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("rank"), batch.column("label"), pa.array(out, pa.binary())], names=["rank", "label", "vector"])


def ftrl(examples, epochs: int = EPOCHS, size: int = BUCKETS + 1):
    """Weights after FTRL-proximal over (features, values, label); the last weight is the intercept."""
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    for _ in range(epochs):
        for f, x, y in examples:
            zi, ni = z[f], n[f]
            wi = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = 1 / (1 + np.exp(-np.clip(wi @ x, -30, 30)))
            g = (p - y) * x
            n[f] = ni + g * g
            z[f] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w.astype(np.float32)


#: What a document's whole vector weighs against the intercept.
SCALE = 80.0


class Examples:
    """(features, values, label) of each training vector in the order of ranks, unpacked anew at each pass."""

    def __init__(self, table: pa.Table):
        table = table.take(pc.sort_indices(table, sort_keys=[("rank", "ascending"), ("vector", "ascending")]))
        self.labels = table["label"].to_pylist()
        self.raw, self.offsets = flat(table["vector"])

    def __iter__(self):
        for y, a, b in zip(self.labels, self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            raw, k = self.raw[a:b].tobytes(), (b - a) // 8
            f = np.append(np.frombuffer(raw, np.uint32, k).astype(np.int64), BUCKETS)
            yield f, np.append(np.frombuffer(raw, np.float32, k, 4 * k) * SCALE, 1.0), float(y)


@X.tidy
def _train(batches):
    held = list(batches)
    if held:
        yield pa.RecordBatch.from_pydict({"weights": pa.array([ftrl(Examples(pa.Table.from_batches(held))).tobytes()], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", learns=None, max_train: int = MAX_TRAIN) -> np.ndarray:
    """The weights. ``learns``: condition on doc_id for labels that may be learned from."""
    own = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    if learns is not None:
        own = own.filter(learns(F.col("id")))
    own = own.groupBy("id").agg(F.min("label").alias("label"))
    # At most max_train ids of a few bytes: the bound that makes the broadcast safe.
    picked = own.select("id", "label", F.xxhash64("id").alias("rank")).orderBy("rank", "id").limit(max_train)
    body = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))
    rows = body.join(F.broadcast(picked), "id").select("rank", "label", "body").mapInArrow(_vectors, "rank bigint, label int, vector binary")
    got = rows.repartition(1).mapInArrow(_train, "weights binary").collect()
    return np.frombuffer(got[0].weights, np.float32) if got else np.zeros(BUCKETS + 1, np.float32)


def _score(block, kept: int):
    @X.tidy
    def run(batches):
        w = block.value
        for batch in batches:
            data, offsets = flat(pa.chunked_array([batch.column("body")]))
            out = np.full(batch.num_rows, w[BUCKETS], np.float64)
            for a, b in pieces(offsets):
                g, doc = grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                total = np.bincount(doc, w[g], b - a)
                out[a:b] += SCALE * total / (PRIOR + np.bincount(doc, minlength=b - a))
            score = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
            yield pa.RecordBatch.from_arrays([*[batch.column(f"k{i}") for i in range(kept)], pa.array(score)], names=[*[f"k{i}" for i in range(kept)], "score"])

    return run


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with score, the probability of label 1."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    X.small_batches(docs.sparkSession)
    block = docs.sparkSession.sparkContext.broadcast(weights)
    base = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("body"))
    return X.renamed(base.mapInArrow(_score(block, len(keep)), "".join(f"k{i} {base.schema[f'k{i}'].dataType.simpleString()}, " for i in range(len(keep))) + "score double"), keep, ["score"])


THRESHOLD = 0.7


def remainder(column, by: int):
    return F.crc32(column.cast("string").cast("binary")) % by


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    weights = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learns=lambda c: remainder(c, 4) != 2)
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return score(docs, weights, keep=["doc_id"]).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
