"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are lower-cased; what is neither letter nor mark counts as a blank; 1- to 3-grams hash into BUCKETS. Document
frequencies cover all training documents: each task counts its own, and vectors of fixed size are summed in two levels.
The classes' weights are learned by FTRL-proximal with elastic net in one task, from a bounded sample of at most
MAX_TRAIN documents, dealt evenly over the languages; a fifth of it is kept back to fit the temperature that
calibrates the probabilities. Prediction is one narrow pass over the whole texts: gathers from a table of
BUCKETS x languages, summed by document. TF-IDF vectors are scaled to sum one, so long texts need no distinct counts.

Learned from: text and non-null lang of documents with crc32(doc_id as text) mod 5 other than 0. Nothing but the text
enters a prediction.

Defined results: null text or text without a letter is ``und`` with score 0; so is everything if nothing can be learned;
documents without a doc_id don't train and aren't held out; repeated rows each get their row.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .bpe import LETTER, classes
from .kernel import U64, flat, pieces
from .quality import remainder

BITS = 18
BUCKETS = 1 << BITS
#: Most documents that train, and most of one language.
MAX_TRAIN, PER_LANG, EPOCHS = 6000, 1200, 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.01
SCALE = 50.0
PIECE = 1 << 19
SLICES = 16
_K = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)]
_M = U64(0xD6E8FEB86659FD93)


@functools.cache
def _plain() -> np.ndarray:
    """Code point of letters and marks, blank for everything else."""
    import regex

    table = np.full(0x110000, 32, np.uint32)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for m in regex.finditer(r"[\p{L}\p{M}]+", every):
        a, b = ord(m[0][0]), ord(m[0][-1]) + 1
        table[a:b] = np.arange(a, b)
    return table


def grams(texts: list[str]):
    """(buckets of the 1-, 2- and 3-grams that start at each place, first place of each text, has a letter).

    Texts are padded by two blanks, so that no gram reaches into the next text."""
    low = [t.lower() for t in texts]
    size = np.array([len(t) for t in low], np.int64)
    points = np.frombuffer(("  ".join(low) + "   ").encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.concatenate(([0], np.cumsum(size + 2)[:-1])) if len(size) else size
    letter = np.concatenate(([0], np.cumsum(classes()[points] == LETTER)))
    c = _plain()[points].astype(U64)
    one = (c + U64(1)) * _K[0]
    two = one[:-1] + (c[1:] + U64(1)) * _K[1]
    three = two[:-1] + (c[2:] + U64(1)) * _K[2]
    n = len(three)
    shift = U64(64 - BITS)
    out = np.stack([((x[:n] ^ (x[:n] >> U64(29))) * _M) >> shift for x in (one, two, three)], 1).astype(np.int64)
    return out, begin, size, letter[begin + size] > letter[begin]


def _texts(column):
    data, offsets = flat(column)
    raw = data.tobytes()
    for a, b in pieces(offsets, PIECE):
        yield a, b, [raw[offsets[i] : offsets[i + 1]].decode("utf-8") for i in range(a, b)]


@X.tidy
def _frequencies(batches):
    """Documents that have each gram, summed over the task; and the number of documents."""
    df, docs = np.zeros(BUCKETS, np.int64), 0
    stamp = np.empty(BUCKETS, np.int64)
    for batch in batches:
        docs += batch.num_rows
        for a, b, texts in _texts(pa.chunked_array([batch.column("body")])):
            g, begin, size, _ = grams(texts)
            for s, n in zip(begin.tolist(), size.tolist()):
                own = g[s : s + n].ravel()
                at = np.arange(len(own))
                stamp[own] = at
                df[own[stamp[own] == at]] += 1
    part = TaskContext.get().partitionId()
    for i, x in enumerate(np.split(df, SLICES)):
        yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "part": pa.array([part], pa.int32()), "docs": pa.array([docs if i == 0 else 0], pa.int64()), "vector": pa.array([x.tobytes()], pa.binary())})


VECTOR = "slice int, part int, docs bigint, vector binary"


@X.tidy
def _sum(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table["vector"].to_pylist())
    return pa.table({"slice": table["slice"][:1], "part": table["part"][:1], "docs": pa.array([sum(table["docs"].to_pylist())], pa.int64()), "vector": pa.array([total.tobytes()], pa.binary())})


def idf(docs: DataFrame) -> np.ndarray:
    """Inverse document frequencies of all grams over docs (body)."""
    groups = max(1, int(docs.rdd.getNumPartitions() ** 0.5))
    each = docs.select("body").mapInArrow(_frequencies, VECTOR).withColumn("part", F.pmod("part", F.lit(groups)))
    total = each.groupBy("slice", "part").applyInArrow(_sum, VECTOR).groupBy("slice").applyInArrow(_sum, VECTOR)
    got = sorted((r.slice, r.docs, r.vector) for r in total.collect())  # SLICES rows of fixed size
    df = np.concatenate([np.frombuffer(v, np.int64) for _, _, v in got]) if got else np.zeros(BUCKETS, np.int64)
    n = sum(d for _, d, _ in got)
    return (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)


def _vectors(block):
    @X.tidy
    def run(batches):
        weight = block.value
        for batch in batches:
            raw = []
            for _, _, texts in _texts(pa.chunked_array([batch.column("body")])):
                g, begin, size, _ = grams(texts)
                for s, n in zip(begin.tolist(), size.tolist()):
                    f, count = np.unique(g[s : s + n], return_counts=True)
                    x = count * weight[f]
                    raw.append(f.astype(np.uint32).tobytes() + (x / max(1e-9, x.sum())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("rank"), batch.column("lang"), pa.array(raw, pa.binary())], names=["rank", "lang", "vector"])

    return run


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


@X.tidy
def _train(batches):
    rows = [r for b in batches for r in zip(b.column("rank").to_pylist(), b.column("lang").to_pylist(), b.column("vector").to_pylist())]
    if not rows:
        return
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    langs = sorted({r[1] for r in rows})
    code = {x: i for i, x in enumerate(langs)}
    examples = []
    for _, lang, raw in rows:
        k = len(raw) // 8
        examples.append((np.append(np.frombuffer(raw, np.uint32, k).astype(np.int64), BUCKETS), np.append(np.frombuffer(raw, np.float32, k, 4 * k) * SCALE, 1.0), code[lang]))
    kept_back, used = examples[::5], [e for i, e in enumerate(examples) if i % 5] or examples
    z, n = np.zeros((BUCKETS + 1, len(langs))), np.zeros((BUCKETS + 1, len(langs)))
    weights = lambda zi, ni: np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
    for _ in range(EPOCHS):
        for f, x, y in used:
            zi, ni = z[f], n[f]
            wi = weights(zi, ni)
            p = softmax(x @ wi)
            p[y] -= 1
            g = x[:, None] * p
            n[f] = ni + g * g
            z[f] = zi + g - (np.sqrt(n[f]) - np.sqrt(ni)) / ALPHA * wi
    w = weights(z, n).astype(np.float32)
    logits, y = np.array([x @ w[f] for f, x, _ in kept_back]), np.array([e[2] for e in kept_back])
    grid = np.geomspace(0.05, 20, 200)
    loss = [0.0 if not len(y) else -np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() + 1e-4 * abs(np.log(t)) for t in grid]
    best = float(grid[int(np.argmin(loss))]) if len(y) else 1.0
    yield pa.RecordBatch.from_pydict({"langs": pa.array([langs], pa.list_(pa.string())), "weights": pa.array([w.tobytes()], pa.binary()), "temperature": pa.array([best])})


def train(docs: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text", learns=None) -> dict:
    """The model: languages, table of IDF times weight with the IDF itself as last column, intercepts, temperature."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").cast("string").alias("body")).filter("id IS NOT NULL AND lang IS NOT NULL AND body IS NOT NULL")
    if learns is not None:
        rows = rows.filter(learns(F.col("id")))
    weight = idf(rows)
    # How many of each language: one row for each language.
    share = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    langs = max(1, share.count())
    share = share.select(F.col("lang").alias("lang2"), (F.lit(float(min(PER_LANG, MAX_TRAIN // langs + 1))) / F.col("n")).alias("rate"))
    rank = F.xxhash64(F.lit(7), "id")
    picked = rows.withColumn("rank", rank).join(F.broadcast(share), F.col("lang") == F.col("lang2")).filter(F.shiftrightunsigned("rank", 11) * F.lit(2.0**-53) < F.col("rate"))
    block = spark.sparkContext.broadcast(weight)
    got = picked.select("rank", "lang", "body").mapInArrow(_vectors(block), "rank bigint, lang string, vector binary").repartition(1).mapInArrow(_train, "langs array<string>, weights binary, temperature double").collect()
    if not got or not got[0].langs:
        return {"langs": []}
    w = np.frombuffer(got[0].weights, np.float32).reshape(BUCKETS + 1, -1)
    table = np.concatenate([w[:BUCKETS] * weight[:, None] * np.float32(SCALE), weight[:, None]], 1)
    return {"langs": list(got[0].langs), "table": np.ascontiguousarray(table), "intercept": w[BUCKETS], "temperature": got[0].temperature}


def _predict(block, kept: int):
    @X.tidy
    def run(batches):
        m = block.value
        for batch in batches:
            lang, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            for a, b, texts in _texts(pa.chunked_array([batch.column("body")])) if m["langs"] else ():
                g, begin, size, letters = grams(texts)
                total = np.zeros((len(begin), m["table"].shape[1]), np.float64)
                some = np.flatnonzero(size)
                if not len(some):
                    continue
                cut = np.stack([begin[some], begin[some] + size[some]], 1).ravel()
                for k in range(3):
                    total[some] += np.add.reduceat(m["table"][g[:, k]], cut, axis=0, dtype=np.float64)[::2]
                logit = total[:, :-1] / np.maximum(1e-9, total[:, -1:]) + m["intercept"]
                p = softmax(logit / m["temperature"])
                best = p.argmax(1)
                for i in np.flatnonzero(letters).tolist():
                    lang[a + i], score[a + i] = m["langs"][best[i]], p[i, best[i]]
            yield pa.RecordBatch.from_arrays([*[batch.column(f"k{i}") for i in range(kept)], pa.array(lang), pa.array(score)], names=[*[f"k{i}" for i in range(kept)], "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with lang_pred and score, its calibrated probability."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    X.small_batches(docs.sparkSession)
    block = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("body"))
    cols = "".join(f"k{i} {base.schema[f'k{i}'].dataType.simpleString()}, " for i in range(len(keep)))
    return X.renamed(base.mapInArrow(_predict(block, len(keep)), f"{cols}lang_pred string, score double"), keep, ["lang_pred", "score"])


def op10(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs, learns=lambda c: remainder(c, 5) != 0)
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return predict(docs.select("doc_id", "text"), model, keep=["doc_id"]).select("doc_id", held.alias("held_out"), "lang_pred", "score")
