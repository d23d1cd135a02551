"""Substring, suffix-array, line and near-duplicate operators against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from lexledger.llm import jaccard_join, line_dedup, substring_dedup, suffix_dedup

KEEP = ["doc_id", "chunk", "body", "score"]


def covered(units, size, counts):
    gone = [False] * len(units)
    for i in range(len(units) - size + 1):
        if counts[tuple(units[i : i + size])] > 1:
            gone[i : i + size] = [True] * size
    return gone


@pytest.mark.parametrize("window", [2, 9, 35])
def test_substring(docs, rows, window):
    words = [(r[0], (r[1] or "").encode().split()) for r in rows]
    counts = Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    want = Counter()
    for i, w in words:
        gone = covered(w, window, counts)
        want[(i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())] += 1
    got = substring_dedup.substring_dedup(docs, window, keep=KEEP).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
    assert all(sum(s.end - s.start for s in r.removed) == r.n_removed for r in got)
    assert {r.body for r in got} == {"clash", None}


@pytest.mark.parametrize("window", [200, 260])
def test_suffix(docs, rows, window):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    counts = Counter(t[i : i + window] for _, t in texts for i in range(len(t) - window + 1))
    want = Counter()
    for i, t in texts:
        gone = np.zeros(len(t) + 1, int)
        for k in range(len(t) - window + 1):
            if counts[t[k : k + window]] > 1:
                gone[k] += 1
                gone[k + window] -= 1
        mask = np.cumsum(gone)[: len(t)] > 0
        want[(i, len(t), int(mask.sum()), bytes(np.frombuffer(t, np.uint8)[~mask]))] += 1
    got = suffix_dedup.suffix_dedup(docs, window, keep=KEEP).collect()
    assert Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), bytes(r.kept)) for r in got) == want


def suffix_by_hand(texts, window):
    counts = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for k in range(len(t) - window + 1):
            if counts[t[k : k + window]] > 1:
                gone[k] += 1
                gone[k + window] -= 1
        out.append(bytes(np.frombuffer(t, np.uint8)[~(np.cumsum(gone)[: len(t)] > 0)]))
    return out


def test_suffix_after_many_short_texts(spark, tmp_path, monkeypatch):
    """A long text after 1.5 MB of texts shorter than the window meets its copy before them."""
    rng = np.random.default_rng(6)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage = word(3000)
    texts = [word(500) + passage, *(word(300) for _ in range(5000)), word(900) + passage + word(200)]
    monkeypatch.setattr(suffix_dedup.X, "counts", lambda *a, **k: (1, 1))
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).sortWithinPartitions("doc_id").write.parquet(path)
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.suffix_dedup(spark.read.parquet(path)).collect()}
    assert [got[i] for i in range(len(texts))] == suffix_by_hand([t.encode() for t in texts], 400)
    assert len(got[0]) == 500


def test_suffix_reports_shorter_passages(spark):
    """A passage of over 50 words and under 400 bytes stays, and shows in n_shared of all that have it, and of no other."""
    rng = np.random.default_rng(11)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage = " ".join(word(5) for _ in range(52))
    texts = [word(int(rng.integers(300, 900))) for _ in range(40)]
    for i in (3, 17, 31):
        texts[i] = word(100 * i) + passage + word(40)
    got = {r.doc_id: r for r in suffix_dedup.suffix_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), passages=True).collect()}
    assert {i for i, r in got.items() if r.n_shared} == {3, 17, 31}
    assert all(240 <= got[i].n_shared <= len(passage) and not got[i].removed for i in (3, 17, 31))


def test_suffix_hot_anchor(spark, tmp_path, monkeypatch):
    """A passage that all rows share amid different surroundings is not gathered in one part, and results are whole."""
    rng = np.random.default_rng(7)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage, other = word(450), word(700)
    texts = [word(int(rng.integers(100, 400))) + passage + word(int(rng.integers(100, 400))) for _ in range(60)]
    texts += [word(300) + other, other + word(200), texts[0], texts[1] + word(50), passage[:420] + word(90), word(1000)]
    monkeypatch.setattr(suffix_dedup, "PART", 5000)
    held, real = [], suffix_dedup._repeated_windows
    monkeypatch.setattr(suffix_dedup, "_repeated_windows", lambda t, *a: (held.append(sum(map(len, t))), real(t, *a))[1])
    table = lambda chunk, some: suffix_dedup.pa.table({"k0": [0] * len(some), "body": some, "chunk": [chunk] * len(some)})
    both = [table(c, texts[c::4]) for c in range(4)]

    def grouped(tables, by, f):
        rows = suffix_dedup.pa.concat_tables(tables)
        keys = sorted(set(rows[by].to_pylist()))
        return [f(rows.filter(suffix_dedup.pa.array([x == k for x in rows[by].to_pylist()]))) for k in keys]

    def of(tables, c):
        rows = suffix_dedup.pa.concat_tables(tables)
        return rows.filter(suffix_dedup.pa.array([x == c for x in rows["chunk"].to_pylist()], suffix_dedup.pa.bool_()))

    shared = grouped([suffix_dedup._anchors(6, 400)(t) for t in both], "bucket", suffix_dedup._shared_anchors(6))
    sent = [suffix_dedup._send_segments(6, 400)(t, of(shared, c)) for c, t in enumerate(both)]
    found = grouped(sent, "bucket", suffix_dedup._shard(6, 400, None))
    kept = [suffix_dedup._cut(6, 400, 1)(t, of(found, c))["kept"].to_pylist() for c, t in enumerate(both)]
    want = suffix_by_hand([t.encode() for t in texts], 400)
    assert kept == [want[c::4] for c in range(4)]
    assert max(held) <= 5000
    assert any(b < 0 for t in sent for b in t["bucket"].to_pylist())


@pytest.mark.parametrize("limit", [1 << 30, 64])
def test_induced_sorting(limit, tmp_path):
    rng = np.random.default_rng(1)
    for _ in range(60):
        t = np.append(rng.integers(1, rng.choice([2, 3, 6]), rng.integers(1, 50)), 0).astype(np.uint16)
        x = t.tolist()
        order = sorted(range(len(x)), key=lambda i: x[i:])
        same = lambda a, b: next((k for k in range(len(x)) if max(a, b) + k >= len(x) or x[a + k] != x[b + k]), len(x))
        place, lcp = suffix_dedup.sort_suffixes(t, 1000, str(tmp_path), limit)
        assert place.tolist() == order
        assert lcp.tolist() == [0, *(same(a, b) for a, b in zip(order, order[1:]))]
    assert not list(tmp_path.iterdir())


def test_lines(docs, rows):
    from conftest_lines import by_hand

    got = line_dedup.line_dedup(docs, keep=KEEP).collect()
    assert sorted(map(str, ((r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in got))) == sorted(map(str, by_hand([(r[0], r[1]) for r in rows])))
    assert sum(r.n_removed for r in got) > 0


def test_lines_of_equal_rows_and_rows_without_id(spark, tmp_path):
    """A third of all rows is one text without an id: the first keeps its lines, all others lose them; as its SQL says."""
    import duckdb
    from conftest_lines import by_hand

    copy, other = "one\ntwo\nthree\nfour\nfive", "six\nseven\neight\nnine"
    rows = [(None, copy)] * 40 + [(i % 40, f"own {i % 40}\n{other}" if i % 3 else f"{i % 40}") for i in range(80)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5).write.parquet(path)
    got = [tuple(r) for r in line_dedup.line_dedup(spark.read.parquet(path), keep=["doc_id"]).collect()]
    assert sorted(map(str, got)) == sorted(map(str, by_hand(rows)))
    assert sorted(r[2] for r in got if r[0] is None) == [0] + [5] * 39
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert sorted(map(str, con.sql(line_dedup.SQL).fetchall())) == sorted(map(str, got))


def test_equal_rows_spread_over_all_chunks(spark, tmp_path):
    from pyspark.sql import functions as F

    from lexledger.llm import exchange

    path = str(tmp_path / "docs")
    spark.createDataFrame([(None, "same text")] * 1000 + [(i, f"text {i}") for i in range(1000)], "doc_id bigint, text string").repartition(3).write.parquet(path)
    dealt = exchange.chunked(spark.read.parquet(path), ["doc_id"], "text", 20)
    for _ in range(2):  # the same at every evaluation
        n = {r.chunk: r.n for r in dealt.filter("k0 IS NULL").groupBy("chunk").agg(F.count("*").alias("n")).collect()}
        assert len(n) == 20 and max(n.values()) < 100
    assert dealt.count() == 2000


@pytest.mark.parametrize("operator, kept", [(substring_dedup.substring_dedup, "kept_text"), (suffix_dedup.suffix_dedup, "kept")])
def test_a_third_of_all_rows_equal(spark, operator, kept):
    """Every copy goes, with or without an id; other texts stay."""
    rng = np.random.default_rng(3)
    text = lambda: " ".join("".join(map(chr, rng.integers(97, 123, 7))) for _ in range(80))
    copy, others = text(), [text() for _ in range(60)]
    rows = [(None, copy)] * 30 + [(i, t) for i, t in enumerate(others)]
    got = operator(spark.createDataFrame(rows, "doc_id bigint, text string"), keep=["doc_id"]).collect()
    assert len(got) == 90
    for r in got:
        value = r[kept] if isinstance(r[kept], str) else bytes(r[kept]).decode()
        assert value == ("" if r.doc_id is None else others[r.doc_id])


def sets_of(rows, words=5):
    out = []
    for r in rows:
        w = (r[1] or "").encode().split()
        out.append((r[0], frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])))
    return out


def test_jaccard(docs, rows):
    sets = sets_of(rows)
    kinds = sorted({s for _, s in sets if s}, key=lambda s: sorted(s))
    link = {a: {b for b in kinds if b != a and len(a & b) >= 0.8 * len(a | b) - 1e-12} for a in kinds}
    owner = defaultdict(list)
    for i, s in sets:
        owner[s].append(i)
    want = Counter()
    for i, s in sets:
        if not s:
            want[(i, i, 0, 1)] += 1
            continue
        group, todo = {s}, [s]
        while todo:
            for b in link[todo.pop()] - group:
                group.add(b)
                todo.append(b)
        want[(i, min(x for g in group for x in owner[g] if x is not None), len(link[s]), len(owner[s]))] += 1
    got = jaccard_join.jaccard_join(docs).collect()
    assert Counter((r.id, r.class_id, r.n_links, r.n_copies) for r in got) == want
    assert any(r.n_links for r in got)
    kept = jaccard_join.one_of_each(docs).collect()
    assert len(kept) == sum(r.first for r in got) == len({r.class_id for r in got if r.n_copies and r.id is not None or r.class_id is not None}) + sum(1 for i, s in sets if i is None and not s)
    assert kept[0].asDict().keys() == dict.fromkeys(docs.columns).keys()


def test_jaccard_large_group(spark, tmp_path):
    """A group of near copies beyond every in-memory limit of the search is one class, each link counted once."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    data = []
    for i in range(300):
        w = list(base)
        w[int(rng.integers(0, 120))] = f"u{i}"
        data.append((i, " ".join(w)))
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(data, "doc_id bigint, text string").repartition(2).write.parquet(path)
    sets = [s for _, s in sets_of(data)]
    degree = [sum(len(a & b) >= 0.8 * len(a | b) - 1e-12 for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
    got = sorted(jaccard_join.jaccard_join(spark.read.parquet(path)).collect(), key=lambda r: r.id)
    assert {r.class_id for r in got} == {0}
    assert [r.n_links for r in got] == degree


def test_jaccard_recall_of_graded_copies(spark, tmp_path):
    """Near copies of 0.80 to 0.99: links, counted without expanding them, against brute force."""
    rng = np.random.default_rng(9)
    data = []
    for i in range(150):
        base = [f"w{int(x)}" for x in rng.integers(0, 5000, 200)]
        data.append(base)
        for k in rng.integers(1, 5, 3):
            w = list(base)
            for at in rng.choice(200, int(k), replace=False):
                w[at] = f"u{len(data)}x{at}"
            data.append(w)
    data = [(i, " ".join(w)) for i, w in enumerate(data)]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(data, "doc_id bigint, text string").repartition(3).write.parquet(path)
    sets = [s for _, s in sets_of(data)]
    same = {(i, j): len(a & b) / len(a | b) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a & b}
    degree = Counter(x for p, v in same.items() if v >= 0.8 - 1e-12 for x in p)
    assert sum(0.8 <= v < 0.9 for v in same.values()) > 100 and sum(0.9 <= v < 1 for v in same.values()) > 100
    got = {r.id: r.n_links for r in jaccard_join.jaccard_join(spark.read.parquet(path)).collect()}
    assert all(n <= degree[i] for i, n in got.items())
    assert sum(got.values()) >= 0.99 * sum(degree.values())


@pytest.mark.parametrize("limit", ["BLOCK_SETS", "BLOCK_ITEMS"])
def test_jaccard_several_blocks(spark, tmp_path, monkeypatch, limit):
    """Every pair of a component of several blocks is compared, whatever block pair comes first in a batch."""
    monkeypatch.setattr(jaccard_join, limit, {"BLOCK_SETS": 16, "BLOCK_ITEMS": 2000}[limit])
    rng = np.random.default_rng(4)
    data = []
    for i in range(120):
        w = [f"w{k}" for k in range(120)]
        w[int(rng.integers(0, 120))] = f"u{i}"
        data.append((i, " ".join(w)))
    data += [(120 + i, data[i][1]) for i in range(3)]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(data, "doc_id bigint, text string").repartition(2).write.parquet(path)
    sets = [s for _, s in sets_of(data)]
    degree = [sum(len(a & b) >= 0.8 * len(a | b) - 1e-12 for b in set(sets) - {a}) for a in sets]
    got = sorted(jaccard_join.jaccard_join(spark.read.parquet(path)).collect(), key=lambda r: r.id)
    assert {r.class_id for r in got} == {0}
    assert [r.n_links for r in got] == degree


def test_empty(empty):
    assert substring_dedup.substring_dedup(empty, 35, keep=["doc_id"]).collect() == []
    assert suffix_dedup.suffix_dedup(empty, keep=["doc_id"]).collect() == []
    assert line_dedup.line_dedup(empty, keep=["doc_id"]).collect() == []
    assert jaccard_join.jaccard_join(empty).collect() == []
    assert jaccard_join.one_of_each(empty).collect() == []


def test_clashing_results_are_an_error(docs):
    with pytest.raises(ValueError, match="n_words"):
        substring_dedup.substring_dedup(docs, keep=["n_words"])
