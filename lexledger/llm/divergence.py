"""Source divergence audit: how far apart the sources of a language are in their use of words, and by which words.

Terms are counted with numpy, some MB of text at a time, and sent packed to buckets of term hashes, so a task sends each
(language, source, term) once for a piece and a hot word or source never meets in one place as rows. Buckets keep the
terms that at least ``min_docs`` documents of a language have. Wide term vectors: each kept term of a language is one
row, pivoted into an array of counts indexed by the language's sources (in byte order). JVM higher-order functions turn
counts into smoothed shares and emit the contribution of each pair of sources; sums are partly made where the rows are
(map side), so what is shuffled is one row for each pair and task. Everything is whole numbers: shares are
floor(SCALE * (count + 5) / (N + 5 * V)), in decimals of 38 digits, so no count overflows or rounds.

Shuffles: packed terms; pair sums; ranks (a group's best are picked in the tasks first). Vectors are settled in the
shared folder, since shares need their totals first. The table of languages (sources, totals) is broadcast only if it is
measured to be under BROADCAST_BYTES, else joined by shuffle with skewed languages split by AQE. Work on pairs is
terms times pairs of sources of one language, as is the answer itself.

Defined results: null text, lang or source counts as ''; a group or language without terms takes part with counts of 0;
a language that keeps no term (V = 0) has pairs of value 0 and no term rows; a language of one source has no pairs; every
row is a document of its own, repeated ones included; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import exchange as X
from .kernel import LOWER, U64, flat, mix, spans, word_hashes

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS, TOP, SCALE, PRIOR = 30, 50, 1_000_000_000, 5
BROADCAST_BYTES = 8 << 20
PIECE = 6 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# A term is a run of ASCII letters (A-Z lower-cased) and bytes of characters beyond ASCII.
IS_TERM = np.zeros(256, bool)
IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True


def tally(data: np.ndarray, offsets: np.ndarray, group: np.ndarray):
    """Of each distinct (group, term): (group, hash of the term, start and end of an occurrence, occurrences, texts that have it).

    ``group`` is the group's number for each text. Equal keys come out of a stable sort in the order of their texts, so
    the first word of each text in a key's stretch stands for that text."""
    starts, ends, first = spans(data, offsets, IS_TERM)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    hashes = word_hashes(data, starts, ends)
    key = mix(hashes + group[text].astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    key, text = key[order], text[order]
    new = np.append(True, key[1:] != key[:-1])[: len(key)]
    at = np.flatnonzero(new)
    own = new | np.append(True, text[1:] != text[:-1])[: len(key)]
    some = order[at]
    return group[text[at]], hashes[some], starts[some], ends[some], np.diff(np.append(at, len(key))), np.add.reduceat(own, at, dtype=np.int64) if len(at) else at


PACKED = "bucket int, langs array<string>, sources array<string>, body binary, terms binary"
ENTRY = np.dtype([("lang", np.uint32), ("source", np.uint32), ("size", np.uint32), ("n", np.int64), ("docs", np.int64)])


def strings(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of data[start : start + size], one after another, and where each begins."""
    off = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    return data[np.arange(off[-1]) + np.repeat(starts - off[:-1], size)], off


def _send(buckets: int):
    @X.tidy
    def run(batches):
        """Terms of PIECE bytes of text together, counted before they leave the task; one row for each bucket."""
        for table in X.gathered(batches, PIECE):
            data, offsets = flat(table["body"])
            data = LOWER[data]
            names, codes = zip(*(np.unique(table[c].to_numpy(), return_inverse=True) for c in ("lang", "source")))
            wide = len(names[1])
            group, hashes, starts, ends, n, docs = tally(data, offsets, codes[0] * wide + codes[1])
            to = X.bucket_of(hashes, 64, buckets).astype(np.int64)
            order = np.argsort(to, kind="stable")
            entry = np.empty(len(to), ENTRY)
            for name, value in (("lang", group // wide), ("source", group % wide), ("size", ends - starts), ("n", n), ("docs", docs)):
                entry[name] = value[order]
            held, off = strings(data, starts[order], entry["size"].astype(np.int64))
            cut = np.searchsorted(to[order], np.arange(buckets + 1))
            rows = []
            for bucket, (x, y) in enumerate(zip(cut.tolist(), cut[1:].tolist())):
                if y > x:
                    own = entry[x:y].copy()
                    lang, own["lang"] = np.unique(own["lang"], return_inverse=True)
                    source, own["source"] = np.unique(own["source"], return_inverse=True)
                    rows.append((bucket, names[0][lang].tolist(), names[1][source].tolist(), own.tobytes(), held[off[x] : off[y]].tobytes()))
            kinds = (pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary(), pa.binary())
            columns = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["bucket", "langs", "sources", "body", "terms"])

    return run


def _keep(min_docs: int):
    @X.tidy
    def run(table: pa.Table) -> pa.Table:
        """The bucket's terms that enough documents have, with their count in each source."""
        codes: tuple[dict, dict] = ({}, {})
        parts, words = [], []
        for langs, sources, body, terms in zip(table["langs"].to_pylist(), table["sources"].to_pylist(), table["body"].to_pylist(), table["terms"].to_pylist()):
            e = np.frombuffer(body, ENTRY).copy()
            for name, seen, own in (("lang", codes[0], langs), ("source", codes[1], sources)):
                e[name] = np.array([seen.setdefault(x, len(seen)) for x in own], np.uint32)[e[name]]
            parts.append(e)
            words.append(terms)
        e = np.concatenate(parts)
        off = np.concatenate(([0], np.cumsum(e["size"], dtype=np.int64)))
        word = pa.LargeStringArray.from_buffers(len(e), pa.py_buffer(off), pa.py_buffer(b"".join(words))).dictionary_encode()
        key = word.indices.to_numpy().astype(np.int64) * len(codes[0]) + e["lang"]
        docs = np.zeros(int(key.max()) + 1, np.int64)
        np.add.at(docs, key, e["docs"])
        own = np.flatnonzero(docs[key] >= min_docs)
        own = own[np.lexsort((e["source"][own], key[own]))]
        k, source = key[own], e["source"][own]
        new = np.append(True, (k[1:] != k[:-1]) | (source[1:] != source[:-1]))[: len(k)]
        at = np.flatnonzero(new)
        n = np.add.reduceat(e["n"][own], at) if len(at) else np.zeros(0, np.int64)
        k, source = k[at], source[at]
        head = np.flatnonzero(np.append(True, k[1:] != k[:-1])[: len(k)])
        names = [pa.array(list(c), pa.string()) for c in codes]
        each = pa.MapArray.from_arrays(pa.array(np.append(head, len(k)), pa.int32()), names[1].take(pa.array(source)), pa.array(n, pa.int64()))
        return pa.table({"lang": names[0].take(pa.array(k[head] % len(names[0]))), "term": word.dictionary.take(pa.array(k[head] // len(names[0]))).cast(pa.string()), "each": each})

    return run


def vectors(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, each): kept terms with their count in each source that has them."""
    _, buckets = X.counts(X.measure(docs, "body"))
    sent = docs.select("lang", "source", "body").mapInArrow(_send(buckets), PACKED)
    return X.spread(sent, buckets, "bucket").applyInArrow(_keep(min_docs), "lang string, term string, each map<string, bigint>")


def languages(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, sources, totals, total, v): sources in byte order, words of kept terms in each and in all, kept terms."""
    groups = docs.select("lang", "source").distinct()
    words = kept.select("lang", F.explode("each").alias("source", "n")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    size = kept.groupBy(F.col("lang").alias("lang2")).agg(F.count(F.lit(1)).alias("v"))
    held = groups.join(words, ["lang", "source"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rows = held.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("g"), F.sum("n").alias("total"))
    return rows.join(size, F.col("lang") == F.col("lang2"), "left").select("lang", F.col("g.source").alias("sources"), F.col("g.n").alias("totals"), "total", F.coalesce("v", F.lit(0)).alias("v"))


def share(count: str, total: str) -> str:
    """SQL of a smoothed share; whole numbers throughout."""
    wide = "CAST({} AS DECIMAL(28, 0))"
    return f"1 + ((CAST({SCALE} AS DECIMAL(10, 0)) * {wide.format(f'{count} + {PRIOR}')}) div {wide.format(f'{total} + {PRIOR} * v')})"


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): distances to other sources ('pair', all) and telling terms ('term', top)."""
    X.small_batches(docs.sparkSession)
    base = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(k) for c, k in ((lang, "lang"), (source, "source"), (text, "body"))])
    kept = X.settle(vectors(base, min_docs))
    langs = X.settle(languages(base, kept))
    size = langs.agg(F.sum(F.aggregate("sources", F.lit(0).cast("long"), lambda a, s: a + F.octet_length(s) + 64))).first()[0] or 0
    held = F.broadcast(langs) if size <= BROADCAST_BYTES else langs
    # Each array is made in its own step and a sort or exchange is not needed between: lambdas bind what they use often.
    wide = (
        kept.join(held, "lang")
        .withColumn("c", F.transform("sources", lambda s: F.coalesce(F.try_element_at("each", s), F.lit(0))))
        .select("lang", "term", "sources", F.expr(f"""
            transform(array(named_struct('c', c, 'q', {share("aggregate(c, 0L, (a, x) -> a + x)", "total")})), s ->
              transform(s.c, (x, i) -> named_struct('n', x, 'p', {share("x", "totals[i]")}, 'q', s.q)))[0]""").alias("x"))
    )
    pairs = F.expr("flatten(transform(array(x.p), p -> flatten(transform(p, (a, i) -> transform(slice(p, i + 2, size(p)), (b, k) -> named_struct('i', i, 'j', i + 1 + k, 'f', abs(a - b)))))))")
    sums = wide.select("lang", F.inline(pairs)).groupBy("lang", "i", "j").agg(F.sum("f").alias("f"))
    both = sums.select("lang", F.inline(F.array(F.struct("i", "j", "f"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "f"))))
    every = langs.select("lang", F.expr("inline(flatten(transform(sources, (a, i) -> transform(filter(sequence(0, size(sources) - 1), j -> j != i), j -> named_struct('source', a, 'item', sources[j], 'i', i, 'j', j)))))"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = every.join(both, ["lang", "i", "j"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("f", F.lit(0)).cast("long").alias("value"))
    pair = pair.withColumn("rank", F.row_number().over(order))
    more = F.expr("filter(transform(x, (y, i) -> named_struct('source', sources[i], 'f', CASE WHEN y.n > 0 THEN y.p - y.q END)), y -> y.f > 0)")
    term = wide.select("lang", F.col("term").alias("item"), F.inline(more)).select("lang", "source", F.lit("term").alias("part"), "item", F.col("f").cast("long").alias("value"))
    term = term.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pair.unionByName(term)


def op12(spark, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS body FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(body, '{TERM}')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
own AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM groups g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
p AS (SELECT lang, source, term, n, 1 + ({SCALE}::HUGEINT * (n + {PRIOR})) // (total + {PRIOR} * v.v) AS p FROM own JOIN v USING (lang)),
q0 AS (SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM own GROUP BY lang, term),
q AS (SELECT lang, term, 1 + ({SCALE}::HUGEINT * (n + {PRIOR})) // (total + {PRIOR} * v.v) AS q FROM q0 JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.f, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
