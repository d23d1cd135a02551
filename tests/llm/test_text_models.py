"""BPE, decontamination, LM, classifier, language ID, neighbours and pipeline."""

import math
import random
import types
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest_lines import by_hand
from lexledger.llm import bpe, decontaminate, langid, lm, neighbours, quality

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def rest(i, by):
    return zlib.crc32(str(i).encode()) % by


def test_pretokens_match_the_pattern():
    import public_tokenizers
    import regex

    pattern, rng = regex.compile(public_tokenizers.PATTERN), random.Random(1)
    alphabet = list("ab stmdrevl'''  \n\t12é!  ?　ßl'd\r½中 ")
    for _ in range(1500):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(3)]
        data, offsets = bpe.flat(pa.chunked_array([pa.array(texts)]))
        s, e, f = bpe.pretokens(data, offsets)
        assert [[data[a:b].tobytes().decode() for a, b in zip(s[f[i] : f[i + 1]], e[f[i] : f[i + 1]])] for i in range(3)] == [pattern.findall(t) for t in texts]


@pytest.mark.parametrize("chunk", [400, 1 << 20])
def test_bpe(docs, rows, chunk):
    encode = bpe._encoding("byte_bpe_50k.tiktoken").encode_ordinary
    got = bpe.bpe(docs, keep=["doc_id", "chunk", "body"], chunk_bytes=chunk).collect()
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == Counter((r[0], tuple(encode(r[1] or "")), (r[1] or "").encode()) for r in rows)


def test_bpe_of_a_plan_that_is_no_scan(docs, rows):
    assert bpe.bpe(docs.repartition(5, "source"), keep=["doc_id"]).count() == len(rows)


@pytest.mark.parametrize("block", [1, 1 << 25])
def test_decontamination(spark, docs, rows, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block * 200 if block == 1 else block)
    items = [(1, rows[2][1]), (2, "one two"), (10, rows[2][1]), (3, None), (4, "!!"), (5, " ".join(rows[8][1].split()[:20])), (None, "word"), (6, "absent " * 20)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(LOW))
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if i is None else str(i))
    want = Counter()
    for r in rows:
        w, hit, found = words(r[1]), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        want[(r[0], len(w), len(hit), tuple(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w))] += 1
    out = decontaminate.contamination(docs, benchmark, keep=["doc_id", "body"]).withColumn("bad", decontaminate.is_contaminated())
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.bad) for r in out.collect()) == want


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(0)
    w = rng.integers(1, 4, 300).astype(np.uint64)
    first = np.array([0, 100, 100, 300])
    room = np.repeat(first[1:], np.diff(first)) - np.arange(300)
    sa = decontaminate.suffix_array(w, room, 512)
    assert sorted(sa.tolist()) == list(range(300))
    keys = [tuple(w[i : i + room[i]].tolist()) for i in sa.tolist()]
    assert keys == sorted(keys)


def token_law(by_bytes, single, pair, triple, counted, total):
    """One text's tokens by hand: the mixture of lm.token_log_probabilities, token by token."""
    off = int(counted)
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    moved, curve, out, block_of, pending = [0.0] * 3, [lm.TOKEN_DAMP] * 3, [], 0, []
    for i in range(len(by_bytes)):
        block = max(0, math.frexp(i // lm.TOKEN_BLOCK)[1])
        if block != block_of:
            for k in range(3):
                curve[k] += sum(left * q * (1 - q) for g, left, q in (e[k] for e in pending))
                moved[k] += sum(g - left * q for g, left, q in (e[k] for e in pending)) / curve[k]
                moved[k] = max(-lm.TOKEN_MOVE, min(lm.TOKEN_MOVE, moved[k]))
            block_of, pending = block, []
        seen2, seen1 = (max(0, pair[i - 1] - off) if i > 1 else 0), (max(0, single[i - 1] - off) if i > 0 else 0)
        q = [
            sigmoid(lm.TRIPLE[0] + lm.TRIPLE[1] * math.log(seen2) + moved[0]) if seen2 else 0.0,
            sigmoid(lm.PAIR[0] + lm.PAIR[1] * math.log(seen1) + moved[1]) if seen1 else 0.0,
            sigmoid(lm.SINGLE + moved[2]) if total else 0.0,
        ]
        laws = [max(0, triple[i] - off) / seen2 if seen2 else 0.0, max(0, pair[i] - off) / seen1 if seen1 else 0.0, max(0, single[i] - off) / max(1, total - off)]
        parts, rest = [], 1.0
        for share, law in zip(q, laws):
            parts.append(rest * share * law)
            rest *= 1 - share
        p = sum(parts) + rest * math.exp(by_bytes[i])
        left, event = 1.0, []
        for share, part in zip(q, parts):
            event.append((part / p, left, share))
            left -= part / p
        pending.append(event)
        out.append(math.log10(p))
    return sum(out)


def test_lm(spark, docs, rows):
    """Everything but the bytes' probabilities by hand: counts, base score, and the mixture of each token."""
    learns = lambda c: quality.remainder(c, 7) != 2
    got = lm.lm_score(docs, learns=learns, keep=["doc_id", "body"]).collect()
    tokens = [(r[0], [*(r[1] or "").encode().translate(LOW).split(), None]) for r in rows]
    learned = [i is not None and rest(i, 7) != 2 for i, _ in tokens]
    counts = [Counter(tuple(w[k : k + n]) for (_, w), own in zip(tokens, learned) if own for k in range(len(w) - n + 1)) for n in (1, 2, 3)]
    n, v = sum(counts[0].values()), len(counts[0])
    model, _, _ = lm.train(docs.select(lm.F.col("doc_id").alias("id"), lm.F.col("text").alias("body"), lm.F.coalesce(learns(lm.F.col("doc_id")), lm.F.lit(False)).alias("counted")))
    assert (model["tokens"], model["kinds"]) == (n, v)
    want = Counter()
    for (i, w), (_, text, *_), own in zip(tokens, rows, learned):
        by_bytes, _ = lm.byte_log_probabilities(model, *lm.flat(pa.chunked_array([pa.array([text or ""])])))
        assert len(by_bytes) == len(w)
        seen = [[counts[k][tuple(w[j - k : j + 1])] if j >= k else 0 for j in range(len(w))] for k in range(3)]
        score = token_law(by_bytes.tolist(), *seen, own, n)
        want[(i, len(w), sum(c > 0 for c in seen[0]), n, round(sum(math.log10((c + 1) / (n + v + 1)) for c in seen[0]), 6), f"{score:.3e}")] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), f"{r.score:.3e}") for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    by = {(r.doc_id, r.n_tokens): r.score for r in got}
    assert all(by[(r.doc_id, r.n_tokens)] == r.score for r in got)  # repeated rows score alike


@pytest.mark.parametrize("before", [10, 5])
def test_lm_byte_probabilities(before):
    """The 256 next bytes have probability one together, with a tree for the bytes before and without."""
    keys = np.array([(10 << 16) | (10 << 8) | b for b in b"abc"], np.int64)
    trees = lm.Trees(keys, np.array([5.0, 3.0, 1.0]))
    begin = np.concatenate(([0], np.cumsum(lm._table_sizes(trees))))
    rng = np.random.default_rng(0)
    table = (rng.integers(-900, 900, begin[-1]) * 4 + rng.integers(0, 4, begin[-1])).astype(np.int16)
    model = {"trees": trees, "table": table, "begin": begin}
    back = [np.array([before], np.uint8)] * 6
    h = [*lm.hashes(back), np.zeros(1, np.uint32)]

    def probability(step):
        x, _ = lm._inputs(model, step, lm.slots(h, np.zeros(len(step), np.int64), step >> 1))
        z = sum(0.3 * v.astype(float) for v in x)
        return float(np.prod(np.where(step & 1, 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(z)))))

    total = sum(probability(trees.events(np.array([b], np.uint8), back[0], back[1])[0]) for b in range(256))
    assert total == pytest.approx(1.0, abs=1e-9)
    # Bytes coded together give the decisions that each gives alone.
    every = np.arange(256, dtype=np.uint8)
    step, at = trees.events(every, np.full(256, before, np.uint8), np.full(256, before, np.uint8))
    assert all(step[at == b].tolist() == trees.events(every[b : b + 1], back[0], back[1])[0].tolist() for b in range(256))


def test_lm_token_law_sums_to_one():
    """All next tokens after one context, with what the bytes leave, have probability one together."""
    words = ["a b", "a b", "a c", "d", "a b c"]
    tokens = [[*t.split(), None] for t in words]
    count = lambda *g: sum(tuple(w[k : k + len(g)]) == g for w in tokens for k in range(len(w) - len(g) + 1))
    kinds = sorted({x for w in tokens for x in w}, key=str)
    total = sum(map(len, tokens))
    law = 0.0
    for t in kinds:
        own = ["a", "b", t]
        seen = [[float(count(*own[j - k : j + 1])) if j >= k else 0.0 for j in range(3)] for k in range(3)]
        by_bytes = np.log(np.array([0.5, 0.25, 1 / len(kinds)]))
        law += math.exp(lm.token_log_probabilities(by_bytes, *map(np.array, seen), np.array([0, 3]), np.array([False]), total)[2])
    assert law == pytest.approx(1.0, abs=1e-12)


def test_lm_bytes_depend_on_their_text_only():
    texts = ["the one of the sea", "", "other words here and there " * 40, "x"]
    data, offsets = lm.flat(pa.chunked_array([pa.array(texts)]))
    keys, n = np.unique(np.array([(116 << 16) | (104 << 8) | 101, (10 << 16) | (10 << 8) | 116], np.int64), return_counts=True)
    trees = lm.Trees(keys, n.astype(float))
    begin = np.concatenate(([0], np.cumsum(lm._table_sizes(trees))))
    table = (np.random.default_rng(2).integers(-900, 900, begin[-1]) * 4).astype(np.int16)
    model = {"trees": trees, "table": table, "begin": begin, "weights": np.full((lm.GATES, lm.INPUTS), 0.3)}
    whole, _ = lm.byte_log_probabilities(model, data, offsets)
    alone = [lm.byte_log_probabilities(model, *lm.flat(pa.chunked_array([pa.array([t])])))[0] for t in texts]
    assert whole == pytest.approx(np.concatenate(alone), rel=1e-5)
    assert [len(x) for x in alone] == [len(t.split()) + 1 for t in texts]


def small_model(texts):
    """Made-up tables and weights over trees of the texts' bytes."""
    data, offsets = lm.flat(pa.chunked_array([pa.array(texts)]))
    out, first = lm.stream(data, offsets)
    p1, p2 = lm.before(out, first, 2)
    keys, n = np.unique(p2[::3].astype(np.int64) << 16 | p1[::3].astype(np.int64) << 8 | out[::3], return_counts=True)
    trees = lm.Trees(keys, n.astype(float))
    begin = np.concatenate(([0], np.cumsum(lm._table_sizes(trees))))
    rng = np.random.default_rng(3)
    table = (rng.integers(-900, 900, begin[-1]) * 4 + rng.integers(0, 4, begin[-1])).astype(np.int16)
    return data, offsets, {"trees": trees, "table": table, "begin": begin, "weights": rng.random((lm.GATES, lm.INPUTS)) * 0.4}


def bytes_by_hand(model, text):
    """One text's tokens, each byte for itself: ln probabilities by weights that are refined block by block."""
    out, first = lm.stream(*lm.flat(pa.chunked_array([pa.array([text])])))
    back = lm.before(out, first)
    step, at = model["trees"].events(out, back[0], back[1])
    x, gate = lm._inputs(model, step, lm.slots([*lm.hashes(back), lm.word_so_far(out, back[0])], at, step >> 1))
    w, bit = model["weights"][gate], step & 1
    base = sum(w[:, k] * x[k] for k in range(lm.INPUTS - 1)) + 0.3 * w[:, -1]
    moved, curve, tokens = [0.0, 0.0], [lm.DAMP, lm.DAMP], np.zeros(len(text.split()) + 1)
    block = np.maximum(0, np.frexp(np.arange(len(out)) // 32)[1])[at]
    token = np.cumsum(np.isin(np.append(0, out[:-1]), (lm.BLANK, lm.END)))[at]
    for b in range(block.max() + 1):
        own = block == b
        p = 1 / (1 + np.exp(-np.clip(base[own] * (1 + moved[0]) + x[2][own] * moved[1], -16, 16)))
        tokens += np.bincount(token[own], np.log(np.where(bit[own], p, 1 - p)), len(tokens))
        for k, v in enumerate((base[own], x[2][own])):
            curve[k] += (p * (1 - p) * v * v).sum()
            moved[k] = min(0.4, max(-0.4, moved[k] + ((bit[own] - p) * v).sum() / curve[k]))
    return tokens


@pytest.mark.parametrize("bits", [22, 3])
def test_lm_equal_places_are_worked_out_once(bits, monkeypatch):
    """Bytes with equal contexts share their decisions, also where slots collide; results are those of each byte alone."""
    rng = random.Random(5)
    words = ["sea", "other", "Wörter", "there", "remarkable", "of", "extraordinarily"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 7, 60, 400)] * 30 + ["", "x", "  "]
    data, offsets, model = small_model(texts)
    asked, events = [], lm.Trees.events
    monkeypatch.setattr(lm, "PLACE_BITS", bits)
    monkeypatch.setattr(lm, "PIECE", 3000)
    with monkeypatch.context() as m:
        m.setattr(lm.Trees, "events", lambda self, s, p1, p2: (asked.append(len(s)), events(self, s, p1, p2))[1])
        got, size = lm.byte_log_probabilities(model, data, offsets)
    assert got == pytest.approx(np.concatenate([bytes_by_hand(model, t) for t in texts]), rel=2e-3, abs=1e-4)
    assert len(size) == len(texts)
    if bits == 22:
        assert sum(asked) < size.sum() / 20
    # Learning counts each decision as often as it is taken.
    monkeypatch.setattr(lm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    batches = [pa.RecordBatch.from_pydict({"body": pa.array(t)}) for t in (texts[:50], texts[50:], [])]
    table = np.zeros((model["begin"][-1] // lm.SLICE, 2 * lm.SLICE), np.uint64)
    for batch in lm._learn(types.SimpleNamespace(value=model["trees"]))(iter(batches)):
        table[batch["slice"][0].as_py()] = lm._wide(batch["payload"][0].as_py())
    step, where = lm._decisions(model["trees"], data, offsets)
    for begin, x in zip(model["begin"], [step >> 1, *where]):
        want = np.bincount((x + begin) << 1 | step & 1, minlength=table.size)
        end = 2 * model["begin"][model["begin"].tolist().index(begin) + 1]
        assert (table.ravel()[2 * begin : end] == want[2 * begin : end]).all()


def test_lm_keys_and_places_sorted_in_one_word():
    rng = np.random.default_rng(4)
    for keys, bits in ((rng.integers(0, 50, 900, dtype=np.uint64), 33), (rng.integers(0, 1 << 60, 900, dtype=np.uint64), 60), (rng.integers(0, 40, 900, dtype=np.uint64), 64), (np.zeros(0, np.uint64), 60)):
        got, order = lm._ordered(keys, bits)
        want = np.argsort(keys, kind="stable")
        assert order.tolist() == want.tolist() and got.tolist() == keys[want].tolist()


def test_lm_gathers_more_from_more(spark):
    """What is gathered grows with the input, and a text that occurs elsewhere too stands out."""
    rng = random.Random(8)
    text = lambda: " ".join(rng.choice(["ba", "co", "di", "fu", "ge"]) + rng.choice("klmnprst") + rng.choice("aeiou") for _ in range(60))
    rows = [(i, text()) for i in range(120)]
    rows += [(200, rows[3][1])]
    frame = lambda r: spark.createDataFrame(r, "doc_id bigint, text string")
    few, many = (lm.lm_score(frame(r), keep=["doc_id"]).agg(lm.F.max("train_tokens")).first()[0] for r in (rows[:40], rows))
    assert many > few
    got = {r.doc_id: r.bits_per_byte for r in lm.lm_score(frame(rows), keep=["doc_id"]).collect()}
    assert max(got[3], got[200]) < min(v for i, v in got.items() if i not in (3, 200))


def brute_quality(text, weights):
    """A document's score, gram by gram."""
    kind = lambda c: 0 if c in b"\x20\x09\x0a\x0b\x0c\x0d" else 1 if chr(c).isalnum() and c < 128 or c >= 128 else 2
    words, raw, i = [], (text or "").encode(), 0
    while i < len(raw):
        j = i
        while j < len(raw) and kind(raw[j]) == kind(raw[i]):
            j += 1
        if kind(raw[i]):
            words.append(quality.word_hashes(np.frombuffer(raw[i:j], np.uint8), np.array([0]), np.array([j - i]))[0])
        i = j
    with np.errstate(over="ignore"):
        grams = [*words, *(quality.SAME if a == b else quality.mix(np.array([a * np.uint64(3) + b]))[0] for a, b in zip(words, words[1:]))]
    total = sum(float(weights[int(g >> np.uint64(64 - quality.BITS))]) for g in grams)
    return 1 / (1 + math.exp(-(float(weights[quality.BUCKETS]) + quality.SCALE * total / (quality.PRIOR + len(grams)))))


def test_quality_by_hand(docs, rows):
    w = np.random.default_rng(3).normal(0, 0.2, quality.BUCKETS + 1).astype(np.float32)
    got = Counter((r.doc_id, round(r.score, 6)) for r in quality.score(docs, w, keep=["doc_id"]).collect())
    assert got == Counter((r[0], round(brute_quality(r[1], w), 6)) for r in rows)


def test_ftrl_by_hand():
    """The weights after some steps of follow-the-regularised-leader, coordinate by coordinate."""
    rng = random.Random(4)
    examples = [(np.array(sorted(rng.sample(range(6), 3)) + [6]), np.array([rng.random() for _ in range(3)] + [1.0]), float(rng.random() < 0.5)) for _ in range(30)]
    z, n = [0.0] * 7, [0.0] * 7
    weight = lambda i: 0.0 if abs(z[i]) <= quality.L1 else -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)
    for _ in range(2):
        for f, x, y in examples:
            w = [weight(i) for i in f]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
            for i, v, a in zip(f, x, w):
                g = (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * a
                n[i] += g * g
    assert quality.ftrl(examples, 2, 7) == pytest.approx([weight(i) for i in range(7)], rel=1e-5)


def test_quality(spark, docs, rows):
    rng = random.Random(2)
    good = [(i, " ".join(rng.choice(["the", "of", "sea", "land", "is"]) for _ in range(40))) for i in range(80)]
    bad = [(i, " ".join(rng.choice(["BUY!!", "NOW!!", "WIN", "|"]) for _ in range(40))) for i in range(80, 160)]
    train = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 80), 0) for i in range(160)] + [(3, None, 0), (5, 1, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int")
    w = quality.train(train, labels, learns=lambda c: quality.remainder(c, 4) != 2)
    got = {r.doc_id: r.score for r in quality.score(train, w).collect()}
    held = [i for i in range(160) if rest(i, 4) == 2]
    assert all((got[i] >= 0.7) == (i < 80) for i in held)
    awkward = quality.score(docs, w, keep=["doc_id", "body"]).collect()
    assert len(awkward) == len(rows) and all(0 <= r.score <= 1 for r in awkward)
    assert len({r.score for r in awkward if r.doc_id in (24, 25, 26)}) == 1  # null, empty, blank
    assert {r.score for r in quality.score(docs, quality.train(docs, labels.limit(0)), keep=["doc_id"]).collect()} == {0.5}


def test_language(spark, docs, rows):
    rng = random.Random(3)
    words = {"en": ["the", "and", "with", "thing"], "de": ["der", "und", "schön", "über"], "fr": ["le", "été", "avec", "ça"]}
    data = [(i, " ".join(rng.choice(words[x]) for _ in range(30)), x) for i, x in enumerate(list(words) * 60)]
    train = spark.createDataFrame([*data, (900, "no language", None), (None, "der und", "xx")], "doc_id bigint, text string, lang string")
    model = langid.train(train, learns=lambda c: quality.remainder(c, 5) != 0)
    assert model["langs"] == ["de", "en", "fr"]
    got = {r.doc_id: r for r in langid.predict(train.drop("lang"), model).collect()}
    assert all(got[i].lang_pred == x for i, _, x in data if rest(i, 5) == 0)
    awkward = langid.predict(docs, model, keep=["doc_id", "body"]).collect()
    assert len(awkward) == len(rows)
    assert all((r.lang_pred == "und") == (r.doc_id in (24, 25, 26) or r.score == 0) for r in awkward)
    nothing = langid.train(train.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing, keep=["doc_id"]).collect()} == {"und"}


def test_language_by_hand(spark):
    """Every prediction from the model's numbers, gram by gram; document frequencies by hand."""
    rng = random.Random(6)
    words = {"en": ["the", "and", "Thing"], "de": ["der", "schön", "über"], "zz": ["ça", "été", "42"]}
    data = [(i, " ".join(rng.choice(words[x]) for _ in range(rng.randint(1, 12))), x) for i, x in enumerate(list(words) * 30)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, lang string")
    model = langid.train(frame, learns=lambda c: quality.remainder(c, 5) != 0)

    def places(text):
        g, begin, size, _ = langid.grams([text])
        return [row.tolist() for row in g[begin[0] : begin[0] + size[0]]]

    learned = [t for i, t, _ in data if rest(i, 5) != 0]
    df = Counter(b for t in learned for b in {b for row in places(t) for b in row})
    idf = np.array([math.log((1 + len(learned)) / (1 + df[b])) + 1 for b in range(langid.BUCKETS)])
    assert model["table"][:, -1] == pytest.approx(idf, rel=1e-5)
    for r in langid.predict(frame, model, keep=["doc_id"]).collect():
        if not any(c.isalpha() for c in dict((i, t) for i, t, _ in data)[r.doc_id]):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        total = np.zeros(len(model["langs"]) + 1)
        for row in places(dict((i, t) for i, t, _ in data)[r.doc_id]):
            for b in row:
                total += model["table"][b]
        logit = total[:-1] / total[-1] + model["intercept"]
        p = np.exp((logit - logit.max()) / model["temperature"])
        p /= p.sum()
        assert r.lang_pred == model["langs"][int(p.argmax())] and r.score == pytest.approx(p.max(), rel=1e-4)


def test_language_does_not_depend_on_neighbours():
    a, _, _, _ = langid.grams(["abc", "de"])
    b, begin, size, _ = langid.grams(["de"])
    _, begin2, size2, _ = langid.grams(["abc", "de"])
    assert a[begin2[1] : begin2[1] + size2[1]].tolist() == b[begin[0] : begin[0] + size[0]].tolist()


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 200)
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 150)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1200, 16)).round(3)
    x[300:700] = x[300]  # a third of all rows are one vector
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    data += [(2000, None), (2050, [0.0] * 16), (2001, [float("nan")] * 16), (2100, [float("inf")] + [0.0] * 15), (2002, [None] + [1.0] * 15), (2150, [1.0] * 3), (50, x[50].tolist()), (None, x[1].tolist())]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>").withColumn("score", neighbours.F.lit("clash"))
    got: dict[int, list] = {}
    for r in neighbours.nearest(df, lambda c: c % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1200, 50))
    u = x / np.sqrt((x * x).sum(1))[:, None]
    hits = 0
    for q, found in got.items():
        s = u @ u[q]
        s[300:700] = s[300]
        order = [i for i in np.lexsort((np.arange(1200), -s)).tolist() if i != q][:5]
        hits += len({i for i, _ in found} & set(order))
        assert len(found) == 5 and all(abs(s[i] - v) < 1e-12 for i, v in found)
        if 300 <= q < 700:
            assert [i for i, _ in found] == order
    assert hits >= 0.9 * 5 * len(got)


@pytest.mark.parametrize("top", [256, 2])
def test_neighbours_clustered(spark, monkeypatch, top):
    """The stopping test stops: few candidates of clustered vectors are verified, with full recall."""
    monkeypatch.setattr(neighbours, "CELL_ROWS", 300)
    monkeypatch.setattr(neighbours, "TOP", top)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((40, 32))[rng.integers(0, 40, 2400)] + 0.15 * rng.standard_normal((2400, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got: dict[int, list] = {}
    for r in neighbours.nearest(df, lambda c: c % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.n_verified))
    u = x / np.sqrt((x * x).sum(1))[:, None]
    hits = sum(len({i for i, _ in found} & set([i for i in np.argsort(-(u @ u[q])).tolist() if i != q][:5])) for q, found in got.items())
    assert hits >= 0.95 * 5 * 48
    assert sum(found[0][1] for found in got.values()) < 0.2 * 48 * 2400


def test_neighbours_of_one_id_with_two_vectors(spark):
    rows = [(0, [1.0, 0.0]), (7, [1.0, 0.1]), (7, [1.0, 0.5]), (8, [1.0, 0.3]), (9, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert [r.vec_id for r in neighbours.nearest(df, lambda c: c % 50 == 0).orderBy("rank").collect()] == [7, 8, 9]


def test_neighbours_few(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.nearest(few, lambda c: c % 50 == 0).collect()] == [(0, 1, 1, 0.0)]
    assert neighbours.nearest(few.limit(0), lambda c: c % 50 == 0).collect() == []


def test_empty(empty, spark):
    assert bpe.bpe(empty, keep=["doc_id"]).collect() == []
    assert decontaminate.contamination(empty, spark.createDataFrame([(1, "a b")], "item_id int, text string"), keep=["doc_id"]).collect() == []
    assert lm.lm_score(empty, keep=["doc_id"]).collect() == []
    assert langid.predict(empty, langid.train(empty), keep=["doc_id"]).collect() == []


def test_empty_benchmark(docs, rows, spark):
    out = decontaminate.contamination(docs, spark.createDataFrame([], "item_id int, text string"), keep=["doc_id"]).collect()
    assert len(out) == len(rows) and not any(r.n_hit for r in out)


def one_of_each_class(rows):
    """The doc_ids that stay when of each class of near duplicates the least one does; rows without words all stay."""
    from test_dedup import sets_of

    sets = [(r.doc_id, s) for r, (_, s) in zip(rows, sets_of([(r.doc_id, r.text) for r in rows]))]
    out, todo = [i for i, s in sets if not s], {s for _, s in sets if s}
    while todo:
        group, work = set(), [todo.pop()]
        while work:
            a = work.pop()
            group.add(a)
            near = {b for b in todo if len(a & b) >= 0.8 * len(a | b) - 1e-12}
            todo -= near
            work += near
        out.append(min((i for i, s in sets if s in group), key=lambda i: (i is None, i)))
    return out


def contaminated(text, items):
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(LOW))
    w, hit = words(text), set()
    for item in map(words, items):
        n = min(13, len(item))
        windows = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)}
        hit |= {k + j for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for j in range(n)}
    return bool(hit) and 20 * len(hit) >= len(w)


def test_pipeline(spark, docs, rows, tmp_path):
    """Stages against brute force, each over what the stage before kept."""
    import corpus_pipeline as p

    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 0 if (r[1] or "").isupper() else 1, 0) for r in rows if r[0] is not None]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(rows[9][1].split()[:30])), (2, "one two three")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in p.STAGES:
        stage(spark, now, folder).write.parquet(f"{folder}/out-{name}")
        before, now = now, spark.read.parquet(f"{folder}/out-{name}")
        kept[name] = (before.collect(), now.collect())
        if name != "byte_bpe":
            assert now.columns == docs.columns
    before, after = kept["quality_classifier"]
    weights = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"), learns=lambda c: quality.remainder(c, 4) != 2)
    good = Counter(tuple(r) for r in before if brute_quality(r.text, weights) >= quality.THRESHOLD)
    assert Counter(tuple(r) for r in after) == good and 0 < sum(good.values()) < len(before)
    before, after = kept["line_dedup"]
    want = by_hand([(r.doc_id, r.text) for r in before])
    assert Counter((r.doc_id, r.text) for r in after) == Counter((i, t) for i, _, _, t in want) and sum(n for _, _, n, _ in want) > 0
    before, after = kept["jaccard_join"]
    assert Counter(r.doc_id for r in after) == Counter(one_of_each_class(before))
    before, after = kept["decontamination"]
    items = [" ".join(rows[9][1].split()[:30]), "one two three"]
    clean = Counter(tuple(r) for r in before if not contaminated(r.text, items))
    assert Counter(tuple(r) for r in after) == clean and sum(clean.values()) < len(before)
    encode = bpe._encoding("byte_bpe_50k.tiktoken").encode_ordinary
    assert sorted((r.doc_id or -1, r.n_tokens) for r in kept["byte_bpe"][1]) == sorted((r.doc_id or -1, len(encode(r.text or ""))) for r in kept["decontamination"][1])
    assert sorted((r.doc_id or -1, r.ids_sha256) for r in p.run(spark, folder).collect()) == sorted((r.doc_id or -1, r.ids_sha256) for r in kept["byte_bpe"][1])


def test_neighbours_of_vectors_of_any_length(spark):
    """Squares that vanish or overflow: true cosines all the same, and nobody else's answer is lost."""
    from fractions import Fraction
    from math import isclose, sqrt

    from lexledger.llm import neighbours

    rows = [(0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.3, 1.0]), (3, [1e-200, 0.0]), (4, [1e200, 1e200]), (5, [5e-324, 1e-320]), (6, [-1.7e308, 1.6e308]), (50, [3e-310, 4e-310])]
    got: dict = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), lambda c: c % 50 == 0, k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))

    def cosine(a, b):
        a, b = ([Fraction(x) / Fraction(max(map(abs, v))) for x in v] for v in (a, b))
        dot = lambda x, y: sum(p * q for p, q in zip(x, y))
        return float(dot(a, b)) / sqrt(dot(a, a)) / sqrt(dot(b, b))

    for q in (0, 50):
        want = sorted(((i, cosine(dict(rows)[q], v)) for i, v in rows if i != q), key=lambda x: (-x[1], x[0]))
        assert [i for i, _ in got[q]] == [i for i, _ in want]
        assert all(isclose(a, b, abs_tol=1e-15, rel_tol=1e-12) for (_, a), (_, b) in zip(got[q], want))
