"""Chunked key exchange: how the operators ask "which keys occur elsewhere?" without exploding text into rows.

Texts are dealt into *chunks* of bounded size by a hash of the row's place, so a hot source or a group of copies, even of
equal rows, spreads out.
A chunk is processed with numpy in one Python call. It sends each distinct key once, packed by *bucket* (a range of
key space), so a key that fills a third of all rows arrives at most once from each chunk: the pre-aggregation that
keeps hot keys harmless. Buckets answer each chunk with packed keys, and the chunk is cogrouped with the answers.
Chunk and bucket counts grow in proportion to the input, so memory for one Python call stays the same at any size up to
GROWS bytes; from there units grow with the square root of the input, eightfold at most, since a chunk's keys for one
bucket would else get too few to pack. A task takes several chunks or buckets, one after another, beyond MAX_PARTS.
"""

from __future__ import annotations

import ctypes
import inspect
import math
import re
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import U64, flat

#: Text bytes aimed at in a chunk, and text bytes of input for each bucket of keys.
CHUNK_BYTES, BUCKET_BYTES = 8 << 20, 16 << 20
GROWS, MAX_PARTS = 64 << 30, 1 << 16
MESSAGE = "bucket int, chunk int, payload binary"


def measure(docs: DataFrame, text: str = "text") -> int:
    """Bytes of text, by one column-pruned aggregate."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0)


def counts(total: int, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> tuple[int, int]:
    grown = min(8.0, max(1.0, math.sqrt(total / GROWS)))
    return max(6, math.ceil(total / chunk_bytes / grown)), max(6, math.ceil(total / bucket_bytes / grown))


def spread(df: DataFrame, n: int, by: str):
    """The groups of ``by``, of which there are about n: one for each partition, up to MAX_PARTS partitions."""
    return df.repartition(min(n, MAX_PARTS), by).groupBy(by)


def _release() -> None:
    """Memory that numpy and Arrow have freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run):
    """A function for mapInArrow or applyInArrow that leaves no freed memory with its worker: workers live on through
    all stages of an application, and what one stage needed at its peak would else add to the next one's."""
    if inspect.isgeneratorfunction(run):

        def call(batches):
            try:
                yield from run(batches)
            finally:
                _release()

    elif run.__code__.co_argcount == 1:

        def call(table):
            try:
                return run(table)
            finally:
                _release()

    else:

        def call(table, other):
            try:
                return run(table, other)
            finally:
                _release()

    return call


def chunked(docs: DataFrame, keep: list[str], text: str, chunks: int, **more) -> DataFrame:
    """(k0, k1, ..., body, chunk, more columns), dealt out so that each chunk is whole in one partition.

    Rows are dealt by their place in the input, which is made stable for that, so any number of equal rows spread out.
    The kept columns get plain names here, so names that clash with the operators' own do no harm."""
    cols = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = stable(docs.select(*cols, F.col(f"`{text}`").cast("string").alias("body"), *[v.alias(k) for k, v in more.items()]))
    at = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)).cast("int").alias("chunk")
    return rows.select(*[c for c in rows.columns if c not in more], at, *more).repartition(min(chunks, MAX_PARTS), "chunk")


def kept_schema(docs: DataFrame, keep: list[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return ", ".join(f"k{i} {types[c]}" for i, c in enumerate(keep))


def renamed(out: DataFrame, keep: list[str], results: list[str]) -> DataFrame:
    if clash := set(keep) & set(results):
        raise ValueError(f"columns to keep have names of results: {sorted(clash)}")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *results)


def bucket_of(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Range partition of ``bits``-bit keys; monotone, so sorted keys give sorted buckets."""
    return ((keys >> U64(bits - 24)) * U64(buckets)) >> U64(24)


def pack(keys: np.ndarray, *more: np.ndarray) -> bytes:
    """Sorted keys as deltas of the least whole number of bytes; ``more`` as raw bytes beside them."""
    d = np.diff(keys, prepend=U64(0))
    width = max(1, (int(d[1:].max(initial=0)).bit_length() + 7) // 8)
    head = np.array([len(keys), width, int(keys[0]) if len(keys) else 0], U64).tobytes()
    body = np.ascontiguousarray(d[1:].view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
    return b"".join([head, body, *(np.ascontiguousarray(m).tobytes() for m in more)])


def unpack(payload: bytes, *kinds) -> tuple[np.ndarray, ...]:
    n, width, first = (int(x) for x in np.frombuffer(payload, U64, 3))
    at = 24 + max(0, n - 1) * width
    d = np.zeros((n, 8), np.uint8)
    if n > 1:
        d[1:, :width] = np.frombuffer(payload, np.uint8, (n - 1) * width, 24).reshape(-1, width)
    d = d.view(U64).ravel()
    if n:
        d[0] = first
    out = [np.cumsum(d, dtype=U64)]
    for kind in kinds:
        out.append(np.frombuffer(payload, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return tuple(out)


def member(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(among, keys)
    at[at == len(among)] = 0
    return among[at] == keys


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of texts of at most 2,000 rows and 16 MB, unless the session asks for others."""
    for key, value in (("maxRecordsPerBatch", "2000"), ("maxBytesPerBatch", "16777216")):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a folder of our own only in local mode, where none is set (tests)."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        if not re.match(r"local(\[[^,]*\])?$", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexledger-"))
    return spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")


def settle(df: DataFrame) -> DataFrame:
    """Computed now and kept in the shared folder, so a lost executor costs no recomputation from the start."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def gathered(batches, limit: int, column: str = "body"):
    """Arrow batches of a partition put together, or cut, to tables of about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        at, end = 0, np.cumsum(np.diff(flat(pa.chunked_array([batch.column(column)]))[1]))
        while at < batch.num_rows:
            done = int(end[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(end, limit - size + done, "right")))
            held.append(batch.slice(at, to - at))
            size += int(end[min(to, batch.num_rows) - 1]) - done
            at = to
            if size >= limit or at < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def send(chunk: int, buckets: int, bits: int, keys: np.ndarray, *more: np.ndarray) -> pa.Table:
    """Messages of a chunk: its sorted keys, with what goes along, cut by bucket."""
    cut = np.searchsorted(bucket_of(keys, bits, buckets), np.arange(buckets + 1))
    rows = [(b, pack(keys[x:y], *(m[x:y] for m in more))) for b, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]
    return messages([b for b, _ in rows], [chunk] * len(rows), [p for _, p in rows])


def messages(buckets, chunks, payloads) -> pa.Table:
    return pa.table({"bucket": pa.array(buckets, pa.int32()), "chunk": pa.array(chunks, pa.int32()), "payload": pa.array(payloads, pa.binary())})


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From (key << 1 | wanted): distinct sorted keys, and flags: 1 wanted somewhere here, 2 here twice or more."""
    v = np.sort(values)
    k = v >> U64(1)
    last = np.flatnonzero(np.append(k[1:] != k[:-1], True)) if len(k) else np.zeros(0, np.int64)
    many = np.diff(last, prepend=-1) > 1
    return k[last], (v[last] & U64(1)).astype(np.uint8) | many.astype(np.uint8) << 1


@tidy
def repeated(table: pa.Table) -> pa.Table:
    """A bucket's reply: keys that are wanted and occur twice at least, told to every chunk that has them."""
    got = [unpack(p, np.uint8) for p in table["payload"].to_pylist()]
    v = np.sort(np.concatenate([k << U64(2) | f.astype(U64) for k, f in got]))
    k = v >> U64(2)
    at = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    flags = np.bitwise_or.reduceat((v & U64(3)).astype(np.uint8), at)
    twice = (np.diff(np.append(at, len(k))) > 1) | (flags & 2 > 0)
    hot = k[at][twice & (flags & 1 > 0)]
    return answer(table, [x[member(x, hot)] for x, _ in got])


def answer(table: pa.Table, keys: list[np.ndarray]) -> pa.Table:
    rows = [i for i, k in enumerate(keys) if len(k)]
    at = pa.array(rows, pa.int64())
    return pa.table({"bucket": table["bucket"].take(at), "chunk": table["chunk"].take(at), "payload": pa.array([pack(keys[i]) for i in rows], pa.binary())})


def keys_of(answers: pa.Table) -> np.ndarray:
    got = [unpack(p)[0] for p in answers["payload"].to_pylist()]
    return np.sort(np.concatenate(got)) if got else np.zeros(0, U64)


def stable(docs: DataFrame) -> DataFrame:
    """The same rows in the same order at every evaluation: a plain file scan, or else a checkpoint.

    The number of splits is pinned, as Spark would otherwise derive it from the executors present at the time."""
    spark = docs.sparkSession
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    nodes = {re.sub(r"^[\s:+\-]*", "", line).split(" ")[0] for line in plan.splitlines() if line.strip()}
    return docs if all(re.match(r"Project|Filter|Relation", x) for x in nodes) else settle(docs)
