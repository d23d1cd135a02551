"""Licence scans: the automaton against substrings, phrases against a regular search, spans of planted texts."""

import random
import re

import pytest

from lexledger.llm import licenses as L

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode())
    return [w.decode() for w in WORD.findall(low)]


def base_of(text):
    words, at, labels = words_of(text), [], set()
    for label, phrase in L.PHRASES:
        p = phrase.split()
        here = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        at += here
        labels |= {label} if here else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


@pytest.mark.parametrize("seed", range(30))
def test_automaton_knows_all_substrings_and_their_places(seed):
    rng = random.Random(seed)
    rows = [[rng.randrange(3) for _ in range(rng.randint(2, 14))] for _ in range(rng.randint(1, 5))]
    m = L.compile_templates([(str(i), " ".join(f"w{x}" for x in r)) for i, r in enumerate(rows)], [])
    names = sorted({x for r in rows for x in r})
    order = {w: i for i, w in enumerate(m["vocabulary"].tolist())}
    h = {x: order[int(L.words_of(*L.flat(L.pa.array([f"w{x}"])))[0][0])] for x in names}
    text = [rng.choice(names) for _ in range(60)]
    s = size = 0
    for i, c in enumerate(text):
        while s and h[c] not in m["next"][s]:
            s = m["link"][s]
            size = m["length"][s]
        if h[c] in m["next"][s]:
            s, size = m["next"][s][h[c]], size + 1
        want = max(k for k in range(i + 2) if k == 0 or any(r[j : j + k] == text[i + 1 - k : i + 1] for r in rows for j in range(len(r))))
        assert size == want
        ends = {(t, j + size) for t, r in enumerate(rows) for j in range(len(r) - size + 1) if size and r[j : j + size] == text[i + 1 - size : i + 1]}
        assert {x for x in ends if size >= m["need"][x[0]]} <= set(m["places"][s]) <= ends or not size
    assert len(m["link"]) <= 2 * sum(map(len, rows)) + 1


def one(spark, *texts):
    return L.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()


def test_base_places_equal_a_plain_search(spark, docs, rows):
    got = L.license_scan(docs, keep=["doc_id", "n_chars", "chunk", "body"]).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got))) == sorted(str((r[0], *base_of(r[1]))) for r in rows)
    assert {r.body for r in got} == {"clash", None}


def test_op11_equals_a_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in L.op11(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        r = got[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert ("mit" in r.labels.split(",")) == ("Released under the MIT License" in (text or ""))
        assert ("apache-2.0" in r.labels.split(",")) == ("Licensed under the Apache License, Version 2.0" in (text or ""))
    assert any(r.base_labels for r in got.values()) and any(r.labels and not r.base_labels for r in got.values())


def test_overlapping_places_and_neighbouring_words(spark):
    got = one(spark, "cc by cc by, CC-BY", "(c) All rights reserved all rights reserved", "GNU GENERAL public\nlicense", "accc by", "cc\x00by", None, "", "ccby generale public license")
    assert [(r.n_base, r.first_word, r.last_word, r.base_labels) for r in got] == [(3, 0, 4, "cc-by"), (2, 1, 4, "reserved"), (1, 1, 1, "gpl"), (0, None, None, ""), (1, 0, 0, "cc-by"), (0, None, None, ""), (0, None, None, ""), (0, None, None, "")]


def test_spans_of_changed_and_repeated_licences(spark):
    mit = next(t for x, t in L.TEMPLATES if x == "mit" and len(t) > 200)
    bsd2, bsd3 = (next(t for x, t in L.TEMPLATES if x == f"bsd-{n}-clause") for n in (2, 3))
    filler = " ".join(f"filler{i}" for i in range(40))
    words = words_of(mit)
    changed = words[:30] + ["something", "else"] + words[33:70] + words[72:]
    got = one(spark, f"{filler} {mit} {filler}", " ".join(changed), f"{bsd2} {filler}", f"{bsd3}", f"{mit} {filler} {mit}", " ".join(words[:20]), f"{mit}\n{bsd3}")
    n = len(words)
    assert [(s.label, s.start, s.end, s.covered) for s in got[0].spans] == [("mit", 40, 40 + n, n)] and got[0].score == 1.0
    assert got[1].labels == "mit" and got[1].spans[0].covered == n - 5 and got[1].spans[0].end == len(changed)
    assert [got[i].labels for i in (2, 3)] == ["bsd-2-clause", "bsd-3-clause"]
    assert [(s.label, s.start) for s in got[4].spans] == [("mit", 0), ("mit", n + 40)]
    assert got[5].labels == "" and 0 < got[5].score < 0.5
    assert got[6].labels == "bsd-3-clause,mit"


def test_many_copies_in_one_text(spark):
    """Linear in the text: one document of 3,000 copies, beside equal rows."""
    notice = next(t for x, t in L.TEMPLATES if x == "isc")
    got = one(spark, "\n\n".join([notice] * 3000), *["All rights reserved"] * 5)
    assert len(got[0].spans) == 3000 and got[0].labels == "isc"
    assert {(r.n_base, r.labels, r.score) for r in got[1:]} == {(1, "reserved", 1.0)}


def test_empty_and_refused(spark, empty, docs):
    assert L.license_scan(empty, keep=["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        L.license_scan(docs, [("x", "word")])
    with pytest.raises(ValueError):
        L.license_scan(docs.withColumnRenamed("score", "labels"))
    assert {r.labels for r in L.license_scan(docs, [], [], keep=["doc_id"]).collect()} == {""}
