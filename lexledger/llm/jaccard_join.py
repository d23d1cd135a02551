"""N-gram Jaccard join by chosen paths, for near-duplicate documents.

Documents are sets of word shingles. Equal sets collapse first (128-bit keys), so copies cost one set. Each set gets
a MinHash sketch of 64 places. A run of the chosen-path join splits all sets recursively: at a node, each place is
chosen with probability 1 / (threshold * 64), independent of the data; sets that share the MinHash token of a chosen
place go down together. Small buckets are compared by brute force. A pair at the threshold survives one level with
probability 1 - 1/e. Rounds of RUNS independent runs repeat until a round ties together no more than 1 - TARGET of all
sets tied so far: if a round finds a share p of the ties that there are, of one half at least, fewer than it has just
added are still missing. So the recall is TARGET at least, as estimated from the data themselves.

Level one is a shuffle: nodes with one set only are found by the packed key exchange and never carry sketches. Deeper
levels happen inside the bucket of their level-one node. In a node that is crowded within one chunk, sets that agree
with a local leader in nine tenths of the sketch are tied to the leader there and not sent, which keeps a group of
near copies that fills a third of the corpus from meeting in one task.

Sketches only propose; components of the proposals are then verified exactly: each component's sets meet in blocks
(a large component in pairs of blocks), all pairs of a component are compared by exact intersection, links are
counted, and only a spanning forest of the links leaves the task. No pair list is ever written, none is capped.

Defined results: null or wordless text has no set and is a class of its own without links; a text of fewer words than
a shingle is one shingle; repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .graph import components, joined
from .kernel import U64, flat, mix, pieces, rolling, spans, word_hashes

PLACES, RUNS, SMALL, DEPTH = 64, 8, 128, 6
TARGET, ROUNDS = 0.95, 12
#: Places that must agree to propose a pair (0.6 of them), and to follow a leader (0.9).
NEAR, FOLLOW = 38, 58
BLOCK_SETS, BLOCK_ITEMS = 1024, 1 << 20

_rng = np.random.Generator(np.random.PCG64(71))
_MULTIPLY = _rng.integers(0, 2**63, PLACES, dtype=np.uint64)[:, None] * U64(2) + U64(1)
_FLIP = _rng.integers(0, 2**63, PLACES, dtype=np.uint64)[:, None]
_PLACE_SALT = mix(np.arange(1, PLACES + 1, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int):
    """The sorted distinct shingle hashes of each text, text by text."""
    for a, b in pieces(offsets):
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = spans(part, off)
        hashes = word_hashes(part, starts, ends)
        n = np.diff(first)
        h, at = rolling(hashes, first, words)
        cut = np.searchsorted(at, first)
        short = {}
        for size in range(1, words):
            if (rows := np.flatnonzero(n == size)).size:
                whole, places = rolling(hashes, first, size)
                short |= dict(zip(rows.tolist(), whole[np.searchsorted(places, first[rows])]))
        for i in range(b - a):
            yield np.unique(h[cut[i] : cut[i + 1]]) if n[i] >= words else np.array([short[i]], U64) if n[i] else np.zeros(0, U64)


def sketch(items: np.ndarray) -> np.ndarray:
    low = np.full(PLACES, np.iinfo(U64).max, U64)
    for a in range(0, len(items), 1 << 15):
        np.minimum(low, ((items[a : a + (1 << 15)][None, :] ^ _FLIP) * _MULTIPLY).min(1), out=low)
    return (low >> U64(32)).astype(np.uint32)


def _identity(items: np.ndarray) -> tuple[int, int]:
    a = np.add.reduce(mix(items ^ U64(0x5851F42D4C957F2D)), dtype=U64)
    b = np.add.reduce(mix(items + U64(0x14057B7EF767814F)), dtype=U64)
    return tuple(mix(np.array([a, b], U64) + U64(len(items))).view(np.int64).tolist())


SET = "n bigint, a bigint, b bigint, sketch binary"


def _describe(words: int):
    @X.tidy
    def run(batches):
        for batch in batches:
            n, a, b, s = [], [], [], []
            for items in shingle_sets(*flat(pa.chunked_array([batch.column("body")])), words):
                key = _identity(items) if len(items) else (None, None)
                n.append(len(items))
                a.append(key[0])
                b.append(key[1])
                s.append(sketch(items).tobytes() if len(items) else None)
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("id"), batch.column("t"), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.binary())], names=["uid", "id", "t", "n", "a", "b", "sketch"])

    return run


def _chosen(path: np.uint64, threshold: float) -> np.ndarray:
    """Places chosen at a node: each with probability 1 / (threshold * PLACES), by the path alone."""
    return np.flatnonzero(mix(path + _PLACE_SALT) < U64(int(2**64 / (threshold * PLACES))))


def _level_one(sketches: np.ndarray, threshold: float, turn: int) -> np.ndarray:
    """Node keys of each set under the roots of all runs of a round, 63 bits."""
    out = []
    for root in mix(np.arange(1000 + turn * RUNS, 1000 + (turn + 1) * RUNS, dtype=np.uint64)):
        for i in _chosen(root, threshold):
            out.append(mix(sketches[:, i].astype(U64) * U64(0x9E3779B97F4A7C15) + (root ^ _PLACE_SALT[i])) >> U64(1))
    return np.stack(out, 1)


def _sketches(table: pa.Table) -> np.ndarray:
    return np.frombuffer(flat(table["sketch"])[0].tobytes(), np.uint32).reshape(-1, PLACES)


def _node_keys(buckets: int, threshold: float, turn: int):
    @X.tidy
    def run(table: pa.Table) -> pa.Table:
        keys, flags = X.distinct(_level_one(_sketches(table), threshold, turn).ravel() << U64(1) | U64(1))
        return X.send(table["chunk"][0].as_py(), buckets, 63, keys, flags)

    return run


def _agree(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (rows == one).sum(1)


def _follow(ids: np.ndarray, s: np.ndarray, tries: int):
    """(edges to local leaders, places not tied to one)."""
    left, edges = np.arange(len(ids)), []
    for _ in range(tries):
        if len(left) < 2:
            break
        n = _agree(s[left], s[left[0]])
        n[0] = 0
        near = left[n >= NEAR]
        edges.append(np.stack([np.full(len(near), ids[left[0]]), ids[near]], 1))
        if sum(map(len, edges)) > 1 << 18:
            edges = [_spanning(edges)]
        left = np.append(left[(n < FOLLOW)][1:], left[0]) if tries < len(ids) else left[n < FOLLOW][1:]
    return edges, left


def _records(keys, ids, s16) -> bytes:
    return b"".join([np.array([len(keys)], U64).tobytes(), keys.tobytes(), ids.tobytes(), np.ascontiguousarray(s16).tobytes()])


def _members(buckets: int, threshold: float, turn: int, crowd: int = 32):
    @X.tidy
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        shared = X.keys_of(answers)
        if not len(shared) or not table.num_rows:
            return X.messages([], [], [])
        chunk, full = answers["chunk"][0].as_py(), _sketches(table)
        ids, s = table["a"].to_numpy(), full.astype(np.uint16)
        keys = _level_one(full, threshold, turn)
        row, col = np.nonzero(X.member(keys.ravel(), shared).reshape(keys.shape))
        key = keys[row, col]
        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(new, len(key)))
        stay, edges = np.ones(len(key), bool), []
        for at, n in zip(new[size > crowd].tolist(), size[size > crowd].tolist()):
            rows = row[at : at + n]
            tied, left = _follow(ids[rows], s[rows], 8)
            edges += tied
            stay[at : at + n] = False
            stay[at + left] = True
        key, row = key[stay], row[stay]
        cut = np.searchsorted(X.bucket_of(key, 63, buckets), np.arange(buckets + 1)).tolist()
        out = [(b, _records(key[x:y], ids[row[x:y]], s[row[x:y]])) for b, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]
        if edges:
            out.append((-1 - chunk, _spanning(edges).tobytes()))
        return X.messages([b for b, _ in out], [chunk] * len(out), [p for _, p in out])

    return run


def _forest(adjacent: np.ndarray) -> np.ndarray:
    """The least index of each node's component, for a symmetric matrix."""
    n = len(adjacent)
    label = np.arange(n)
    linked = adjacent | np.eye(n, dtype=bool)
    while True:
        new = np.where(linked, label[None, :], n).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _spanning(pairs: list[np.ndarray]) -> np.ndarray:
    """A spanning forest of the pairs: each id with the least one of its component."""
    x = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
    ids, at = np.unique(x, return_inverse=True)
    u, v = at.reshape(-1, 2).T
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(ids)))
    return np.stack([ids[label[own]], ids[own]], 1)


def _edges(pairs) -> pa.Table:
    x = _spanning(pairs)
    return pa.table({"u": pa.array(x[:, 0], pa.int64()), "v": pa.array(x[:, 1], pa.int64())})


def _search(threshold: float):
    @X.tidy
    def run(table: pa.Table) -> pa.Table:
        if table["bucket"][0].as_py() < 0:
            return _edges([np.frombuffer(p, np.int64).reshape(-1, 2) for p in table["payload"].to_pylist()])
        parts = [[], [], []]
        for raw in table["payload"].to_pylist():
            n = int(np.frombuffer(raw, U64, 1)[0])
            parts[0].append(np.frombuffer(raw, U64, n, 8))
            parts[1].append(np.frombuffer(raw, np.int64, n, 8 + 8 * n))
            parts[2].append(np.frombuffer(raw, np.uint16, n * PLACES, 8 + 16 * n).reshape(n, PLACES))
        key, ids, s = (np.concatenate(p) for p in parts)
        order = np.argsort(key, kind="stable")
        key, ids, s = key[order], ids[order], s[order]
        found = []
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(new, len(key)))
        two = new[size == 2]
        hit = two[_agree(s[two], s[two + 1]) >= NEAR]
        found.append(np.stack([ids[hit], ids[hit + 1]], 1))
        stack = [(np.arange(a, a + n), key[a], 1) for a, n in zip(new[size > 2].tolist(), size[size > 2].tolist())]
        while stack:
            rows, path, depth = stack.pop()
            if len(rows) <= SMALL:
                own = s[rows]
                label = _forest((own[:, None, :] == own[None, :, :]).sum(2) >= NEAR)
                tied = np.flatnonzero(label != np.arange(len(rows)))
                found.append(np.stack([ids[rows[label[tied]]], ids[rows[tied]]], 1))
            elif depth >= DEPTH:
                found.append(_spanning(_follow(ids[rows], s[rows], len(rows))[0]))
            else:
                for i in _chosen(mix(np.array([path], U64))[0], threshold):
                    value = s[rows, i]
                    o = np.argsort(value, kind="stable")
                    v = value[o]
                    heads = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
                    for x, y in zip(heads.tolist(), [*heads[1:].tolist(), len(v)]):
                        if y - x > 1:
                            child = mix(np.array([path ^ _PLACE_SALT[i]], U64) + U64(int(v[x])))[0]
                            stack.append((rows[o[x:y]], child, depth + 1))
        return _edges(found)

    return run


def _sets(words: int):
    @X.tidy
    def run(batches):
        for batch in batches:
            sent, rows, raw = set(), [], []
            for i, items in enumerate(shingle_sets(*flat(pa.chunked_array([batch.column("body")])), words)):
                key = batch.column("a")[i].as_py(), batch.column("task")[i].as_py()
                if key not in sent:
                    sent.add(key)
                    rows.append(i)
                    raw.append(items.tobytes())
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("task").take(at), batch.column("side").take(at), pa.array(raw, pa.binary())], names=["a", "task", "side", "items"])

    return run


def _verify(threshold: float):
    def links(sets: list[np.ndarray], cross: np.ndarray | None) -> np.ndarray:
        size = np.array([len(x) for x in sets])
        who = np.repeat(np.arange(len(sets)), size)
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count[column] > 1
        who, column = who[shared], column[shared]
        order = np.argsort(column, kind="stable")
        who, column = who[order], np.cumsum(np.append(0, np.diff(column[order]) > 0)) if len(order) else column
        both = np.zeros((len(sets), len(sets)), np.float32)
        width = max(256, (8 << 20) // len(sets))
        for a in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            x, y = np.searchsorted(column, (a, a + width))
            m = np.zeros((len(sets), min(width, int(column[-1]) + 1 - a)), np.float32)
            m[who[x:y], column[x:y] - a] = 1
            both += m @ m.T
        union = size[:, None] + size[None, :] - both.astype(np.float64)
        out = both >= threshold * union - 1e-9
        np.fill_diagonal(out, False)
        if cross is not None:
            out &= cross[:, None] != cross[None, :]
        return out

    @X.tidy
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        task, a = table["task"].to_numpy(), table["a"].to_numpy()
        side, raw = table["side"].to_numpy(), table["items"].to_pylist()
        u, v, n = [], [], []
        heads = np.flatnonzero(np.append(True, task[1:] != task[:-1])).tolist()
        for x, y in zip(heads, [*heads[1:], len(task)]):
            key, at = np.unique(a[x:y], return_index=True)
            sides = side[x:y][at]
            hit = links([np.frombuffer(raw[x + i], U64) for i in at.tolist()], sides if (sides != 2).any() else None)
            count = hit.sum(1)
            label = _forest(hit)
            for i in np.flatnonzero(count).tolist():
                u.append(int(key[i]))
                v.append(int(key[label[i]]))
                n.append(int(count[i]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "n": pa.array(n, pa.int64())})

    return run


def jaccard_join(docs: DataFrame, words: int = 5, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(uid, id, class_id, n_links, n_copies) for each row: uid is its place in the scan; class_id the least doc_id
    of its connected class; n_links the number of other distinct sets it is linked to; n_copies the rows with its own
    set. ``first`` marks one row of each class."""
    X.small_batches(docs.sparkSession)
    docs = X.stable(docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body")))
    keyed = docs.select(F.monotonically_increasing_id().alias("uid"), "id", F.xxhash64("body").alias("t"), "body")
    id_type = docs.schema["id"].dataType.simpleString()
    rows = X.settle(keyed.mapInArrow(_describe(words), f"uid bigint, id {id_type}, t bigint, {SET}"))
    sets = X.settle(
        rows.filter("n > 0").groupBy("a", "b").agg(F.first("sketch").alias("sketch"), F.first("n").alias("n"), F.min("t").alias("t"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid")).alias("least"), F.count(F.lit(1)).alias("n_copies"))
    )
    total = sets.count()
    chunks, buckets = max(6, total // 8192 + 1), max(6, total // 16384 + 1)
    base = sets.select("a", "sketch", F.pmod(F.col("b"), F.lit(chunks)).cast("int").alias("chunk")).repartition(chunks, "chunk")
    chunk = lambda df: df.groupBy("chunk")

    def proposals(turn: int) -> DataFrame:
        shared = X.spread(chunk(base).applyInArrow(_node_keys(buckets, threshold, turn), X.MESSAGE), buckets, "bucket").applyInArrow(X.repeated, X.MESSAGE)
        near = chunk(base).cogroup(chunk(shared)).applyInArrow(_members(buckets, threshold, turn), X.MESSAGE)
        return X.spread(near, buckets, "bucket").applyInArrow(_search(threshold), "u bigint, v bigint")

    proposed = components(proposals(0))
    tied = proposed.filter("id <> root").count()
    for turn in range(1, ROUNDS):
        proposed, gained = joined(proposed, proposals(turn))
        tied += gained
        if gained <= (1 - TARGET) * tied:
            break

    # Tasks: pairs of a component's blocks; a component within one block is one task (side 2: compare all with all).
    own = proposed.join(sets, proposed["id"] == sets["a"]).select("a", "t", "n", "root")
    shape = own.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("items"))
    shape = shape.select("root", F.greatest(F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("items") / BLOCK_ITEMS)).cast("int").alias("blocks"))
    spread = own.join(shape, "root").withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    task = F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other"))
    tasks = spread.select("a", "t", "root", "block", "blocks", other).select(
        "a", F.col("t").alias("t2"), task.alias("task"), F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side")
    )
    # A pair of blocks is a group of its own, so a large component's many tasks are never held together.
    groups = max(6, total // 4096)
    bucket = F.when(F.col("side") == 2, F.pmod("task", F.lit(groups))).otherwise(F.col("task"))
    found = (
        keyed.select("t", "body").join(tasks, F.col("t") == F.col("t2")).select("a", "task", "side", "body")
        .mapInArrow(_sets(words), "a bigint, task bigint, side int, items binary")
        .withColumn("bucket", bucket).groupBy("bucket").applyInArrow(_verify(threshold), "u bigint, v bigint, n bigint")
    )
    found = X.settle(found)
    label = components(found.select("u", "v"))
    count = found.groupBy(F.col("u").alias("a")).agg(F.sum("n").alias("n_links"))
    classes = (
        sets.join(label.withColumnRenamed("id", "a"), "a", "left").join(count, "a", "left")
        .select("a", "b", "least", "n_copies", F.coalesce("root", "a").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    first = classes.groupBy("root").agg(F.min("least").alias("head"))
    each = classes.join(first, "root").select("a", "b", "head", "n_links", "n_copies")
    return rows.select("uid", "id", "a", "b").join(each, ["a", "b"], "left").select(
        "uid", "id", F.when(F.col("head").isNull(), F.col("id")).otherwise(F.col("head.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        (F.col("head").isNull() | (F.col("head.uid") == F.col("uid"))).alias("first"),
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs without all but one document of each class; a class keeps its least doc_id."""
    docs = X.stable(docs)
    kept = jaccard_join(docs, **options).filter("first").select(F.col("uid").alias("kept_uid"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("uid"))
    return row.join(kept, F.col("uid") == F.col("kept_uid"), "left_semi").select("row.*")


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_join(docs).select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_copies")
