"""Periodic runs against a scan of all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexledger.llm import periodic
from lexledger.llm.kernel import mix

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def runs_of(words, least=24, times=3):
    """All runs, by looking at every period."""
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a, found = np.array([code[w] for w in words]), {}
    for q in range(1, len(a) // times + 1):
        same = np.concatenate(([False], a[q:] == a[:-q], [False])).astype(np.int8)
        d = np.diff(same)
        for s, e in zip(np.flatnonzero(d == 1).tolist(), np.flatnonzero(d == -1).tolist()):
            if e - s + q >= max(least, times * q):
                found.setdefault((s, e + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def words_of(doc_id, text):
    words = WORD.findall((text or "").encode())
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def row_of(doc_id, text):
    words = words_of(doc_id, text)
    found = runs_of(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = (None, None, None)
    for s, m, q in found:
        if best[0] is None or (-m * best[2], s, q) < (-best[1] * q, best[0], best[2]):
            best = (s, m, q)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *best, None if best[0] is None else best[1] * 1000 // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randrange(300))]
    for _ in range(rng.randrange(5)):
        part = [rng.randrange(3) for _ in range(rng.randint(1, 20))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = part * rng.randint(2, 9) + part[: rng.randrange(len(part))]
    least, times = rng.choice([(24, 3), (24, 3), (10, 2), (9, 3), (30, 4)])
    first = np.array([0, len(words)])
    h = mix(np.array(words, np.uint64) + np.uint64(7))
    s, e = periodic.survivors(h, first, periodic.overlap(least, times))
    got = periodic.main_lorentz(h, s, e, least, times)
    assert [(int(a), int(b - a), int(q)) for a, b, q in got] == runs_of(words, least, times)


def test_thue_morse_words_break_no_result():
    """The sequence that defeats rolling hashes modulo 2**64."""
    bits = [bin(i).count("1") & 1 for i in range(1 << 12)]
    words = (bits + [1 - b for b in bits[: 1 << 11]]) * 3
    h = mix(np.array(words, np.uint64) + np.uint64(7))
    s, e = periodic.survivors(h, np.array([0, len(h)]), 16)
    got = periodic.main_lorentz(h, s, e)
    assert [(int(a), int(b - a), int(q)) for a, b, q in got] == runs_of(words)


def test_masking_leaves_only_repeated_grams():
    assert periodic.overlap(24, 3) == 16 and periodic.overlap(10, 2) == 5
    words = mix(np.arange(100, dtype=np.uint64))
    words[60:80] = words[10:30]
    s, e = periodic.survivors(words, np.array([0, 100]), 16)
    assert list(zip(s, e)) == [(10, 30), (60, 80)]
    s, e = periodic.survivors(words, np.array([0, 50, 100]), 16)
    assert len(s) == 0  # grams of two documents don't meet


def test_op13_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in periodic.op13(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(row_of(*r) for r in docs)
    assert sum(r[1] for r in got) > 10


def test_awkward_rows(spark, docs, rows):
    out = periodic.periodic_runs(docs, keep=["doc_id", "n_chars", "chunk", "body"]).collect()
    want = sorted((str(r[0]), len(WORD.findall((r[1] or "").encode())), str(runs_of(WORD.findall((r[1] or "").encode())))) for r in rows)
    assert sorted((str(r.doc_id), r.n_words, str([tuple(x) for x in r.runs])) for r in out) == want
    assert any(r.runs for r in out) and {r.body for r in out} == {"clash", None}


def test_empty_and_kept_names(spark, empty, docs):
    assert periodic.periodic_runs(empty, keep=["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs.withColumn("runs", F.lit(1)))
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, times=1)


def test_a_very_long_text_of_one_sentence(spark):
    """A batch of its own; one run, all but its first period goes."""
    text = "all work and no play makes\n" * 100_000
    got = periodic.periodic_runs(spark.createDataFrame([(1, text), (2, "x"), (2, "x")], "doc_id int, text string")).orderBy("doc_id").collect()
    assert [tuple(x) for x in got[0].runs] == [(0, 600_000, 6)] and got[0].collapsed_text == "all work and no play makes"
    assert [r.collapsed_text for r in got[1:]] == ["x", "x"]
