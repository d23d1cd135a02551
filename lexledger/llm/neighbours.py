"""Approximate nearest neighbours by low-dimensional stable projections indexed with kd-trees.

Vectors are scaled to length one, where nearness by cosine is nearness by Euclid, and projected on PLACES Gaussian
(2-stable) directions. For a pair at distance d the squared projected distance over d*d follows a chi-square law with
PLACES degrees. A search takes projected neighbours one after another in rising order of their projected distance,
verifies each by its true cosine, and stops when the next projected distance r passes the test
chi2(r*r / d_k*d_k) > CONFIDENCE  for the k-th best distance d_k so far: a better neighbour not yet met would have to be in
the law's far tail. Projected neighbours come from a kd-tree: a leaf is opened only when its box is the nearest thing
left, and what is verified is counted (n_verified).

The projected space is cut into cells by the top of a kd-tree, fitted on a bounded sample: on the driver for up to TOP
cells, from at most MAX_SAMPLE rows; beyond, each of the TOP cells is split further by a task of its own, from about 64
sampled rows for each final cell. Every row is indexed in its cell, and cells get their own kd-tree. Round one searches a
query's own cell; its d_k goes along to round two, which visits just the cells that reach inside the radius beyond which
the test holds, and there verifies only what could still be better. A crowded cell (many equal vectors) is dealt over
several shards by vec_id, each answers for itself, and equal vectors within a shard are one point with its least ids, so
no group lands in one task.

Uniformly random vectors of 64 dimensions are the worst case (the fifth neighbour is at 0.8 of the mean distance): about
half of 2,000 and a third of 10,000 candidates are verified there for a recall of 0.95; clustered vectors take a few
per cent.

Defined results: vectors that are null, zero, of another length than the table's most frequent one, or that hold null or
non-finite components take no part, as query or candidate; all other lengths do, from the least subnormal to the greatest
finite component, as vectors are scaled by a power of two first; rows with the query's vec_id are its own; a vec_id given
twice counts once, as candidate with its nearest vector, as query with its least scaled vector; ties go to the smaller vec_id;
fewer candidates than k give all; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import exchange as X
from .kernel import flat

PLACES, CONFIDENCE, LEAF = 24, 0.94, 48
MAX_SAMPLE, CELL_ROWS, SHARD_ROWS, TOP = 16_000, 16_384, 32_768, 256
#: Projected neighbours verified at once, before d_k is looked at again: a quarter of those so far, and so many at least.
BATCH = 32


def chi2_cdf(x: float, degrees: int = PLACES) -> float:
    """For even degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))


@functools.cache
def chi2_quantile(p: float, degrees: int = PLACES) -> float:
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, degrees) < p else (lo, mid)
    return hi


@functools.cache
def directions(dim: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(8)).standard_normal((dim, PLACES))


def matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(flat(column)[0].tobytes(), np.float64).reshape(-1, dim)


def even(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component to 1/2 or more and under 1.

    Powers of two change no other digit, so cosines stay what they are, and squares neither vanish nor overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None])


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = np.sqrt((x * x).sum(1))
    return x / length[:, None], length


def fit_cells(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Median splits of a sample, level by level: (place, value) of each inner node in heap order."""
    places, values, groups = [], [], [points]
    for _ in range(depth):
        below = []
        for g in groups:
            place = int(np.argmax(g.max(0) - g.min(0))) if len(g) > 1 else 0
            value = float(np.median(g[:, place])) if len(g) > 1 else 0.0
            places.append(place)
            values.append(value)
            below += [g[g[:, place] < value], g[g[:, place] >= value]]
        groups = below
    return np.array(places, np.int64), np.array(values, np.float64)


def join_cells(top: tuple[np.ndarray, np.ndarray], below: dict[int, tuple[np.ndarray, np.ndarray]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """One heap of the top splits and those of the cells below them, ``depth`` levels each."""
    places, values = [top[0]], [top[1]]
    none = (np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1))
    each = [below.get(c, none) for c in range(len(top[0]) + 1)]
    for level in range(depth):
        a, b = (1 << level) - 1, (2 << level) - 1
        places += [p[a:b] for p, _ in each]
        values += [v[a:b] for _, v in each]
    return np.concatenate(places), np.concatenate(values)


def cell_of(points: np.ndarray, splits) -> np.ndarray:
    place, value = splits
    node = np.zeros(len(points), np.int64)
    for _ in range(int(math.log2(len(place) + 1))):
        node = 2 * node + 1 + (points[np.arange(len(points)), place[node]] >= value[node])
    return node - len(place)


def cells_within(q: np.ndarray, radius: float, splits) -> list[int]:
    """Cells with a point within the radius of q, by their boxes."""
    places, values = splits
    out, stack = [], [(0, np.zeros(PLACES))]
    while stack:
        node, gap = stack.pop()
        if node >= len(places):
            out.append(node - len(places))
            continue
        place = places[node]
        off = q[place] - values[node]
        far = gap.copy()
        far[place] = max(far[place], abs(off))
        for child, g in ((2 * node + 1, gap if off < 0 else far), (2 * node + 2, gap if off >= 0 else far)):
            if (g * g).sum() <= radius * radius:
                stack.append((child, g))
    return out


class Tree:
    """kd-tree of a shard: points in leaf order, with the boxes of the leaves."""

    def __init__(self, points: np.ndarray):
        order, parts = [], [np.arange(len(points))]
        while parts:
            rows = parts.pop()
            if len(rows) <= LEAF:
                order.append(rows)
                continue
            own = points[rows]
            place = int(np.argmax(own.max(0) - own.min(0)))
            half = len(rows) // 2
            rows = rows[np.argpartition(own[:, place], half)]
            parts += [rows[half:], rows[:half]]
        self.order = np.concatenate(order)
        self.ends = np.cumsum([len(x) for x in order])
        self.low = np.array([points[x].min(0) for x in order])
        self.high = np.array([points[x].max(0) for x in order])

    def leaves(self, q: np.ndarray):
        """(squared distance of the box, leaf) in rising order."""
        gap = np.maximum(0, np.maximum(self.low - q, q - self.high))
        d = (gap * gap).sum(1)
        o = np.argsort(d, kind="stable")
        return d[o], o


def verify_in_order(tree: Tree, low: np.ndarray, x: np.ndarray, q: np.ndarray, p: np.ndarray, k: int, worst: float):
    """(rows that may be among the k nearest of q, how many were verified). ``low``, ``p``: projections of the points x
    and of q; ``worst``: a squared distance within which k others are known to be."""
    quantile, starts = chi2_quantile(CONFIDENCE), np.append(0, tree.ends[:-1])
    box, leaf = tree.leaves(p)
    at, step, verified = 0, 4, 0
    pool, far = np.zeros(0, np.int64), np.zeros(0)
    rows, dist = np.zeros(0, np.int64), np.zeros(0)
    while True:
        bound = quantile * worst
        edge = box[at] if at < len(leaf) else np.inf
        n = min(int(np.searchsorted(far, min(edge, bound), "right")), max(BATCH, verified // 4))
        if n:
            new, pool, far = pool[:n], pool[n:], far[n:]
            verified += n
            rows, dist = np.append(rows, new), np.append(dist, np.maximum(0, 2 - 2 * (x[new] @ q)))
            # The k + 1 nearest points have k rows besides the query's own.
            if len(rows) > k + 1:
                limit = np.partition(dist, k)[k] + 1e-9
                rows, dist = rows[dist <= limit], dist[dist <= limit]
                worst = min(worst, limit)
        elif edge <= bound and at < len(leaf):
            more = np.concatenate([tree.order[starts[i] : tree.ends[i]] for i in leaf[at : at + step]])
            at, step = at + step, min(64, step * 2)
            pool, far = np.append(pool, more), np.append(far, ((low[more] - p) ** 2).sum(1))
            o = np.argsort(far, kind="stable")
            pool, far = pool[o], far[o]
        else:
            return rows, verified


def _search(dim: int, k: int):
    @X.tidy
    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        qid, vid, scores, verified = [], [], [], []
        if points.num_rows and queries.num_rows:
            ids, raw = points["vec_id"].to_numpy(), matrix(points["vec"], dim)
            order = np.lexsort((ids, *raw.T[::-1]))
            ids, raw = ids[order], raw[order]
            same = np.append(False, (raw[1:] == raw[:-1]).all(1))
            head = np.flatnonzero(~same)
            size = np.diff(np.append(head, len(ids)))
            x, _ = unit(raw[head])
            low = x @ directions(dim)
            tree = Tree(low)
            for q_id, q_raw, bound in zip(queries["q_id"].to_pylist(), matrix(queries["q_vec"], dim), queries["q_bound"].to_pylist()):
                q = q_raw / np.sqrt((q_raw * q_raw).sum())
                rows, n = verify_in_order(tree, low, x, q, q @ directions(dim), k, np.inf if bound is None else bound)
                full = (raw[head[rows]] * q_raw).sum(1) / (np.sqrt((raw[head[rows]] ** 2).sum(1)) * np.sqrt((q_raw * q_raw).sum()))
                best = []
                for r, s in zip(rows.tolist(), full.tolist()):
                    own = np.unique(ids[head[r] : head[r] + size[r]])
                    best += [(-s, int(i)) for i in own[own != q_id][:k]]
                best = [(-s, i) for s, i in sorted(set(best))[:k]] or [(None, None)]
                for j, (s, i) in enumerate(best):
                    qid.append(q_id)
                    vid.append(i)
                    scores.append(s)
                    verified.append(0 if j else n)
        return pa.table({"query_id": pa.array(qid, pa.int64()), "vec_id": pa.array(vid, pa.int64()), "score": pa.array(scores, pa.float64()), "verified": pa.array(verified, pa.int64())})

    return run


FOUND = "query_id bigint, vec_id bigint, score double, verified bigint"


def _project(dim: int, splits):
    @X.tidy
    def run(batches):
        for b in batches:
            low = unit(matrix(b.column("vec"), dim))[0] @ directions(dim) if b.num_rows else np.zeros((0, PLACES))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vec"), pa.array(cell_of(low, splits), pa.int64())], names=["vec_id", "vec", "cell"])

    return run


def _binary(dim: int):
    @X.tidy
    def run(batches):
        for b in batches:
            a = b.column("v")
            values = even(np.asarray(a.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([r.tobytes() for r in values], pa.binary())], names=["vec_id", "vec"])

    return run


def _next_cells(dim: int, splits):
    """The cells that round two visits: those within the radius that the k-th score of round one leaves."""
    quantile = chi2_quantile(CONFIDENCE)

    @X.tidy
    def run(batches):
        for b in batches:
            ids, vecs, cells, bounds = [], [], [], []
            for i, raw, own, kth in zip(b.column("vec_id").to_pylist(), b.column("vec").to_pylist(), b.column("cell").to_pylist(), b.column("kth").to_pylist()):
                q = np.frombuffer(raw, np.float64)
                bound = None if kth is None else max(0.0, 2 - 2 * kth) + 1e-9
                radius = math.inf if bound is None else math.sqrt(quantile * bound)
                for c in cells_within((q / np.sqrt((q * q).sum())) @ directions(dim), radius, splits):
                    if c != own:
                        ids.append(i)
                        vecs.append(raw)
                        cells.append(c)
                        bounds.append(bound)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary()), pa.array(cells, pa.int64()), pa.array(bounds, pa.float64())], names=["vec_id", "vec", "cell", "bound"])

    return run


def _fit_below(dim: int, depth: int):
    @X.tidy
    def run(table: pa.Table) -> pa.Table:
        place, value = fit_cells(unit(matrix(table["vec"], dim))[0] @ directions(dim), depth)
        return pa.table({"cell": table["cell"][:1], "place": pa.array([place.tobytes()], pa.binary()), "value": pa.array([value.tobytes()], pa.binary())})

    return run


def cells(packed: DataFrame, dim: int, n: int):
    """The splits of the projected space into about n / CELL_ROWS cells."""
    count = math.ceil(n / CELL_ROWS)
    depth = max(0, math.ceil(math.log2(max(1, count))))
    first = min(depth, int(math.log2(TOP)))
    # At most MAX_SAMPLE rows, of least hash, whatever the size of the table.
    sample = packed.orderBy(F.xxhash64("vec_id"), "vec_id").limit(MAX_SAMPLE).collect() if depth else []
    top = fit_cells(unit(np.array([np.frombuffer(r.vec, np.float64) for r in sample]))[0] @ directions(dim) if sample else np.zeros((0, PLACES)), first)
    if depth == first:
        return top
    some = packed.filter(F.pmod(F.xxhash64(F.lit(7), "vec_id"), F.lit(max(1, CELL_ROWS // 64))) == 0).mapInArrow(_project(dim, top), "vec_id bigint, vec binary, cell bigint")
    got = X.spread(some, TOP, "cell").applyInArrow(_fit_below(dim, depth - first), "cell bigint, place binary, value binary").collect()  # one row for each of TOP cells
    return join_cells(top, {r.cell: (np.frombuffer(r.place, np.int64), np.frombuffer(r.value, np.float64)) for r in got}, depth - first)


def nearest(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score, n_verified): the k nearest found for each row that ``is_query`` (a condition on
    vec_id); n_verified: how many candidates of the query were verified by their true cosine."""
    spark = vectors.sparkSession
    v = F.col(f"`{embedding}`").cast("array<double>")
    clean = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), v.alias("v")).filter(
        "vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)"
    )
    shape = clean.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not shape:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double, n_verified bigint")
    dim, n = int(shape[0]["dim"]), int(shape[0]["count"])
    packed = clean.filter(F.size("v") == dim).mapInArrow(_binary(dim), "vec_id bigint, vec binary")
    splits = cells(packed, dim, n)
    rows = X.settle(packed.mapInArrow(_project(dim, splits), "vec_id bigint, vec binary, cell bigint"))
    crowd = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"))
    points = rows.join(crowd, "cell").select("vec_id", "vec", "cell", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int").alias("shard"))
    queries = rows.filter(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min(F.struct("vec", "cell")).alias("x")).select("vec_id", "x.vec", "x.cell", F.lit(None).cast("double").alias("bound"))

    def searched(q: DataFrame) -> DataFrame:
        each = q.join(crowd, "cell").select(F.col("vec_id").alias("q_id"), F.col("vec").alias("q_vec"), F.col("bound").alias("q_bound"), F.col("cell").alias("q_cell"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("q_shard"))
        return points.groupBy("cell", "shard").cogroup(each.groupBy("q_cell", "q_shard")).applyInArrow(_search(dim, k), FOUND)

    def ranked(found: DataFrame) -> DataFrame:
        """Each candidate once, with its nearest vector; ranks, and all that was verified for the query."""
        by = Window.partitionBy("query_id")
        once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.sum("verified").alias("verified"))
        return once.withColumn("rank", F.row_number().over(by.orderBy(F.desc_nulls_last("score"), "vec_id"))).withColumn("verified", F.sum("verified").over(by))

    first = X.settle(ranked(searched(queries)).filter(F.col("rank") <= k))
    kth = first.filter((F.col("rank") == k) & F.col("vec_id").isNotNull()).select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth"))
    found = first.select("query_id", "vec_id", "score", F.when(F.col("rank") == 1, F.col("verified")).otherwise(0).alias("verified"))
    if len(splits[0]):
        more = queries.join(kth, "vec_id", "left").mapInArrow(_next_cells(dim, splits), "vec_id bigint, vec binary, cell bigint, bound double")
        found = found.union(searched(more))
    return ranked(found).filter((F.col("rank") <= k) & F.col("vec_id").isNotNull()).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.col("verified").alias("n_verified"))


def op7(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 50 == 0)
