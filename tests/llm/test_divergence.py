"""Source divergence against plain counting, and against its SQL."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from lexledger.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def by_hand(rows, min_docs, top=50):
    rows = [(a or "", b or "", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for a, b, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        df, count = Counter(), defaultdict(Counter)
        sources = sorted({r[1] for r in rows if r[0] == lang}, key=lambda s: s.encode())
        for a, s, t in rows:
            if a == lang:
                words = TERM.findall(t)
                df.update(set(words))
                count[s].update(words)
        kept = [w for w, n in df.items() if n >= min_docs]
        whole = Counter()
        for s in sources:
            whole.update({w: count[s][w] for w in kept})
        share = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for w in kept}
        p, q = {s: share(count[s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [(o, sum(abs(p[s][w] - p[o][w]) for w in kept)) for o in sources if o != s]
            terms = [(w, p[s][w] - q[w]) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i) for i, (item, v) in enumerate(found, 1) if part == "pair" or i <= top]
    return sorted(out)


def got(df, *args, **more):
    return sorted(tuple(r) for r in D.divergence(df, *args, **more).collect())


ROWS = [("en", f"s{i % 4}", f"The cat{'s' if i % 3 else ''} sat, x{i % 5} ÉCOLE école naïve—{'dog ' * (i % 7)}") for i in range(60)] + [
    ("en", None, "only here The"), ("en", "empty", None), ("en", "empty2", ""), (None, "s1", "le le chat"), ("", None, "le"), ("de", "alone", "ein ein Wort"), ("fr", "a", " 　mot"), ("fr", "b", "123 _ -"), ("en", "ß", "THE the tHe"), ("en", "Z", "cat"),
]


@pytest.mark.parametrize("min_docs, top", [(1, 3), (5, 50), (30, 50), (10_000, 50)])
def test_equal_to_plain_counting(spark, min_docs, top):
    df = spark.createDataFrame(ROWS * 2, "lang string, source string, text string").repartition(5)
    want = by_hand(ROWS * 2, min_docs, top)
    assert got(df, min_docs, top) == want
    if min_docs == 10_000:
        assert {r[4] for r in want} == {0} and {r[2] for r in want} == {"pair"}


def test_small_pieces_and_clashing_names(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(D, "PIECE", 200)
    renamed = docs.withColumnRenamed("lang", "l").withColumnRenamed("text", "value").withColumnRenamed("score", "rank")
    assert got(renamed, 3, lang="l", text="value") == by_hand([(r[2], r[3], r[1]) for r in rows], 3)


def test_counts_beyond_a_long_stay_exact(spark):
    """Shares of counts near 2**62: decimals, no overflow."""
    big = 2**62
    e = f"SELECT {D.share('c', 't')} AS p FROM VALUES ({big}L, {big + 7}L, 3L) AS x(c, t, v)"
    assert spark.sql(e).first().p == 1 + 10**9 * (big + 5) // (big + 7 + 15)


def test_empty_table(spark, empty):
    assert got(empty) == []


def test_its_sql(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(ROWS * 3, "lang string, source string, text string").write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert sorted(con.sql(D.SQL).fetchall()) == got(spark.read.parquet(path)) == by_hand(ROWS * 3, 30)


def test_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_BYTES", 0)
    assert got(spark.createDataFrame(ROWS, "lang string, source string, text string"), 5) == by_hand(ROWS, 5)
