"""Byte-level BPE encoding and decoding through a global shuffle of distinct words.

1. Every text is cut into pre-tokens by a vectorised version of the tokenizer's pattern. Pre-tokens with their
   positions are kept by *chunk* (a few MB of consecutive rows): a doc row holds the sequence of chunk-local word
   numbers, and the chunk's distinct words go, once each, to the bucket of the word.
2. A bucket encodes each distinct word once, however many chunks and places have it, and answers each chunk.
3. Chunks take their doc rows and the answers, and reassemble the ids by position. Decoding looks every id up in the
   token-byte table and puts the bytes together by position.

The text itself is never shuffled, only word numbers (about two bytes a token) and distinct words. A word that fills a
third of the corpus arrives once from each chunk.

The scan is read twice (words, sequences) and must give the same rows in the same order both times: `exchange.stable` keeps a
file scan as it is and settles anything else in the shared checkpoint folder first; a digest of each chunk is compared
and a difference is an error, never a wrong answer.

Defined results: null text encodes as empty text (no ids, empty bytes); repeated rows each keep their row; special
tokens are ordinary text. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
import public_tokenizers
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .kernel import U64, flat, pieces, word_hashes

CHUNK_BYTES = 10 << 20
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point, by the pattern's own properties."""
    import regex

    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            out[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
    return out


def pretoken_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where each pre-token begins, for code points of several texts; ``first``: each text's first place, and the end.

    The pattern in terms of runs of one class: a run of letters, numbers or other signs takes one blank (U+0020) just
    before it along; of a longer white-space run the last character stays apart unless the text ends; a lone
    apostrophe without such a blank takes s, t, m, d, re, ve or ll from the letters that follow."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    inner = first[(first >= 0) & (first < n)]
    new[inner] = True
    space = kind == SPACE
    ends_text = np.zeros(n + 1, bool)
    ends_text[first[1:]] = True
    solid_next = np.zeros(n, bool)  # a character of the same text follows that isn't white space
    solid_next[:-1] = ~space[1:]
    solid_next[ends_text[1:]] = False
    last_space = space & solid_next
    start = new.copy()
    start[last_space] = True
    blank = np.flatnonzero(last_space & (points == 0x20))
    start[blank + 1] = False
    quote = np.flatnonzero((points[:-2] == 0x27) & start[:-2] & new[1:-1] & (kind[1:-1] == LETTER)) if n > 2 else np.zeros(0, np.int64)
    tail = np.array([n - 2]) if n > 1 and points[n - 2] == 0x27 and start[n - 2] and new[n - 1] and kind[n - 1] == LETTER else np.zeros(0, np.int64)
    quote = np.concatenate([quote, tail])
    quote = quote[~ends_text[quote + 1]]
    if len(quote):
        one, two = points[quote + 1], points[np.minimum(quote + 2, n - 1)]
        pair = (quote + 2 < n) & ~ends_text[np.minimum(quote + 2, n)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = pair & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        for hit, size in ((short, 2), (long, 3)):
            q = quote[hit]
            start[q + 1] = False
            after = q + size
            after = after[after < n]
            start[after[(kind[after] == LETTER) & ~ends_text[after]]] = True
    return np.flatnonzero(start)


def pretokens(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, first pre-token of each text) as byte positions."""
    if len(data) and int(data.max()) >= 0x80:
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        starts = lead[pretoken_starts(points, np.searchsorted(lead, offsets))]
    else:
        starts = pretoken_starts(data, offsets)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return starts, ends, np.searchsorted(starts, offsets)


def _words(table: pa.Table):
    """Distinct words of a chunk in the order of their hashes: (hashes, bytes of the texts, start and size of each word
    there, number of each pre-token, first pre-token of each row). Pieces are made distinct before they meet."""
    data, offsets = flat(table["body"])
    keys, starts, sizes, numbers, first = [np.zeros(0, U64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], [np.zeros(1, np.int64)]
    for a, b in pieces(offsets):
        lo = int(offsets[a])
        part = data[lo : offsets[b]]
        s, e, f = pretokens(part, offsets[a : b + 1] - lo)
        own, at, number = np.unique(word_hashes(part, s, e), return_index=True, return_inverse=True)
        keys.append(own)
        starts.append(s[at] + lo)
        sizes.append(e[at] - s[at])
        numbers.append(number.astype(np.int32))
        first.append(f[1:] + first[-1][-1])
    every, at, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    cut = np.cumsum([len(k) for k in keys])
    place = place.astype(np.int32)
    number = [place[x:y][n] for x, y, n in zip(cut, cut[1:], numbers)]
    return every, data, np.concatenate(starts)[at], np.concatenate(sizes)[at], np.concatenate([np.zeros(0, np.int32), *number]), np.concatenate(first)


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> bytes:
    """The spans of ``data``, one after another."""
    end = np.cumsum(sizes)
    return data[np.arange(int(end[-1]) if len(end) else 0) + np.repeat(starts - end + sizes, sizes)].tobytes()


def _chunk_tables(batches, limit: int):
    part = TaskContext.get().partitionId()
    for number, table in enumerate(X.gathered(batches, limit)):
        yield part << 24 | number, table


def _digest(keys: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(keys.tobytes()) >> 1


WORDS = "bucket int, chunk bigint, digest bigint, lengths binary, words binary"
ANSWERS = "bucket int, chunk bigint, digest bigint, lengths binary, ids binary"


def _send_words(buckets: int, limit: int):
    @X.tidy
    def run(batches):
        for chunk, table in _chunk_tables(batches, limit):
            keys, data, starts, sizes, _, _ = _words(table)
            digest = _digest(keys)
            cut = np.searchsorted(X.bucket_of(keys, 64, buckets), np.arange(buckets + 1)).tolist()
            for b, (x, y) in enumerate(zip(cut, cut[1:])):
                if y > x:
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int32()), "chunk": pa.array([chunk], pa.int64()), "digest": pa.array([digest], pa.int64()), "lengths": pa.array([_pack_sizes(sizes[x:y])], pa.binary()), "words": pa.array([_gather(data, starts[x:y], sizes[x:y])], pa.binary())})

    return run


def _pack_sizes(sizes) -> bytes:
    x = np.asarray(sizes, np.uint32)
    return b"\x01" + x.astype(np.uint8).tobytes() if not len(x) or x.max() < 256 else b"\x04" + x.tobytes()


def _unpack_sizes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8 if raw[0] == 1 else np.uint32, -1, 1).astype(np.int64)


def _pack_numbers(x: np.ndarray) -> bytes:
    """Numbers by frequency rank: one byte below 192, two below 16,320, else four."""
    lead = np.where(x < 192, x, np.where(x < 192 + 63 * 256, 192 + ((x - 192) >> 8), 255)).astype(np.uint8)
    mid = ((x[(lead >= 192) & (lead < 255)] - 192) & 255).astype(np.uint8)
    far = x[lead == 255]
    return b"".join([np.array([len(lead), len(mid), len(far)], np.uint32).tobytes(), lead.tobytes(), mid.tobytes(), (far & 0xFFFF).astype(np.uint16).tobytes(), (far >> 16).astype(np.uint8).tobytes()])


def _unpack_numbers(raw: bytes) -> np.ndarray:
    n, m, k = (int(v) for v in np.frombuffer(raw, np.uint32, 3))
    lead = np.frombuffer(raw, np.uint8, n, 12)
    x = lead.astype(np.int64)
    two, four = (lead >= 192) & (lead < 255), lead == 255
    x[two] = 192 + ((x[two] - 192) << 8 | np.frombuffer(raw, np.uint8, m, 12 + n))
    x[four] = np.frombuffer(raw, np.uint16, k, 12 + n + m).astype(np.int64) | np.frombuffer(raw, np.uint8, k, 12 + n + m + 2 * k).astype(np.int64) << 16
    return x


def _ranked(number: np.ndarray, n: int) -> np.ndarray:
    """Frequency rank of each word number; ties by number."""
    rank = np.empty(n, np.int32)
    rank[np.argsort(-np.bincount(number, minlength=n), kind="stable")] = np.arange(n)
    return rank


def _send_docs(kept: int, limit: int):
    @X.tidy
    def run(batches):
        for chunk, table in _chunk_tables(batches, limit):
            keys, _, _, _, number, first = _words(table)
            rank = _ranked(number, len(keys))
            x = rank[number]
            order = np.argsort(rank, kind="stable").astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([None], table.schema.field(f"k{i}").type) for i in range(kept)], pa.array([chunk], pa.int64()), pa.array([_digest(keys)], pa.int64()), pa.array([True]), pa.array([order.tobytes()], pa.binary())],
                names=[*[f"k{i}" for i in range(kept)], "chunk", "digest", "head", "body"],
            )
            n = table.num_rows
            body = pa.array([_pack_numbers(x[first[i] : first[i + 1]]) for i in range(n)], pa.binary())
            whole = pa.table({f"k{i}": table[f"k{i}"] for i in range(kept)} | {"chunk": pa.array(np.full(n, chunk)), "digest": pa.array(np.full(n, _digest(keys), np.int64)), "head": pa.array(np.zeros(n, bool)), "body": body})
            yield from whole.combine_chunks().to_batches(max_chunksize=2000)

    return run


@functools.cache
def load_ranks(name: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.cache
def _encoding(name: str):
    import tiktoken

    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(name), special_tokens={})


@functools.cache
def _token_bytes(name: str) -> list[bytes]:
    """The token-byte table, by id."""
    ranks = load_ranks(name)
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


def _encode_bucket(name: str):
    @X.tidy
    def run(table: pa.Table) -> pa.Table:
        encode = _encoding(name)._encode_single_piece
        sizes = [_unpack_sizes(x) for x in table["lengths"].to_pylist()]
        ends = np.concatenate([np.zeros(1, np.int64), *sizes]).cumsum()
        flat_words = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(b"".join(table["words"].to_pylist()))])
        counts = list(map(len, sizes))
        coded = flat_words.dictionary_encode()
        ids = [encode(w) for w in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        pool = np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum()))
        begin = np.concatenate(([0], np.cumsum(sizes)))
        which, at, lengths, out = coded.indices.to_numpy(), 0, [], []
        for n in counts:
            w = which[at : at + n]
            at += n
            size = sizes[w]
            shift = np.repeat(begin[w] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
            lengths.append(_pack_sizes(size))
            got = pool[np.arange(int(size.sum())) + shift]
            out.append(got.astype(np.uint16).tobytes() if len(_token_bytes(name)) <= 65536 else got.tobytes())
        return pa.table({"bucket": table["bucket"], "chunk": table["chunk"], "digest": table["digest"], "lengths": pa.array(lengths, pa.binary()), "ids": pa.array(out, pa.binary())})

    return run


def _assemble(name: str, kept: int):
    @X.tidy
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = _token_bytes(name)
        kind = np.uint16 if len(tokens) <= 65536 else np.uint32
        answers = answers.sort_by("bucket")
        if len(set(docs["digest"].to_pylist()) | set(answers["digest"].to_pylist())) > 1:
            raise RuntimeError("the input gave other rows at its second reading; checkpoint it first")
        size = np.concatenate([np.zeros(0, np.int64), *map(_unpack_sizes, answers["lengths"].to_pylist())])
        pool = np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in answers["ids"].to_pylist())])
        head = np.array(docs["head"].to_pylist(), bool)
        bodies = docs["body"].to_pylist()
        order = np.frombuffer(bodies[int(np.flatnonzero(head)[0])], np.uint32)
        if len(order) != len(size):
            raise RuntimeError("a chunk got answers for other words than it asked for")
        begin = np.concatenate(([0], np.cumsum(size)))
        begin, size = begin[order] if len(order) else begin, size[order]
        text = [b"".join(map(tokens.__getitem__, pool[s : s + n].tolist())) for s, n in zip(begin.tolist(), size.tolist())]
        rows = np.flatnonzero(~head)
        ids, decoded, offsets = [], [], [0]
        for i in rows.tolist():
            x = _unpack_numbers(bodies[i])
            n = size[x]
            total = int(n.sum())
            shift = np.repeat(begin[x] - np.concatenate(([0], np.cumsum(n)[:-1])) if total else n, n)
            ids.append(pool[np.arange(total) + shift].astype(np.int32))
            decoded.append(b"".join(map(text.__getitem__, x.tolist())))
            offsets.append(offsets[-1] + total)
        values = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))
        kept_rows = docs.take(pa.array(rows))
        return pa.table({f"k{i}": kept_rows[f"k{i}"] for i in range(kept)} | {"ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), "decoded": pa.array(decoded, pa.binary())})

    return run


def bpe(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", text: str = "text", keep: list[str] | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The kept columns with ids (array of int) and decoded (the bytes that the ids stand for)."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    X.small_batches(docs.sparkSession)
    docs = X.stable(docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").cast("string").alias("body")))
    kept = len(keep)
    cols = "".join(f"k{i} {docs.schema[f'k{i}'].dataType.simpleString()}, " for i in range(kept))
    chunks, buckets = X.counts(X.measure(docs, "body"), chunk_bytes)
    answers = X.spread(docs.mapInArrow(_send_words(buckets, chunk_bytes), WORDS), buckets, "bucket").applyInArrow(_encode_bucket(vocabulary), ANSWERS)
    rows = docs.mapInArrow(_send_docs(kept, chunk_bytes), f"{cols}chunk bigint, digest bigint, head boolean, body binary")
    out = X.spread(rows, chunks, "chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_assemble(vocabulary, kept), f"{cols}ids array<int>, decoded binary")
    return X.renamed(out, keep, ["ids", "decoded"])


def digests(out: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids (decimal, joined by blanks) and of the decoded bytes."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4(spark, sf_dir: str) -> DataFrame:
    return digests(bpe(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep=["doc_id"]))
