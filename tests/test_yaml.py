"""Nested YAML against what it stands for."""

import json

import pytest

from lexledger.sources import yamls

CASES = [
    ("", []),
    ("a: 1", [{"a": 1}]),
    ("# c\n- x\n- 'it''s'\n- \"a\\tb # no\" # yes\n- -3.5e2\n- ~\n- 2010-01-02\n- true", [["x", "it's", "a\tb # no", -350.0, None, "2010-01-02", True]]),
    ("rules:\n- id: r1\n  aliases:\n  - Ley 24/1988: no\n  - [LMV, 'a, b', {k: v, n: [1, 2]}]\n  when:\n    from: 1988-07-29\n    to:\n- id: r2", [{"rules": [{"id": "r1", "aliases": [{"Ley 24/1988": "no"}, ["LMV", "a, b", {"k": "v", "n": [1, 2]}]], "when": {"from": "1988-07-29", "to": None}}, {"id": "r2"}]}]),
    ("a: |\n  one\n   two\n\n  three\n\nb: >-\n  one\n  two\n\n  three\n\n\nc: |+\n  x\n\nd: >\n  p\n   q\n  r\n", [{"a": "one\n two\n\nthree\n", "b": "one two\nthree", "c": "x\n\n", "d": "p\n q\nr\n"}]),
    ("a: first\n  second # c\n  third\nb: \"x\n  y\n\n  z\"\nc: [1,\n  2,\n  3]", [{"a": "first second third", "b": "x y\nz", "c": [1, 2, 3]}]),
    ("- - a\n  - b\n-\n  - c\n- k: 1\n  l:\n    - m: n\n      o: p", [[["a", "b"], ["c"], {"k": 1, "l": [{"m": "n", "o": "p"}]}]]),
    ("a: http://x.y/z#f\n'q: r': s\nurl: a:b\ne: {}\nf: []", [{"a": "http://x.y/z#f", "q: r": "s", "url": "a:b", "e": {}, "f": []}]),
    ("---\na: 1\n---\n- 2\n...\n", [{"a": 1}, [2]]),
    ("plain text", ["plain text"]),
]


@pytest.mark.parametrize("text, want", CASES)
def test_documents(text, want):
    assert list(yamls.documents(text)) == want
    assert list(yamls.documents(text.replace("\n", "\r\n"))) == want


@pytest.mark.parametrize("text", ["a: 1\na: 2", "a:\n\tb: 1", "a: &x 1", "a: [1, 2", "a: 'x", "a: 1\n   b: 2", '- "\\q"', "{a: 1, a: 2}", "a: [1] x"])
def test_what_is_refused(text):
    with pytest.raises(ValueError):
        list(yamls.documents(text))


def emit(v, indent=0):
    """Block form of nested values."""
    pad = " " * indent
    if isinstance(v, dict) and v:
        return "".join(f"{pad}{json.dumps(k)}:" + (f"\n{emit(x, indent + 2)}" if isinstance(x, (dict, list)) and x else f" {json.dumps(x)}\n") for k, x in v.items())
    if isinstance(v, list) and v:
        return "".join(f"{pad}-" + (f"\n{emit(x, indent + 2)}" if isinstance(x, (dict, list)) and x else f" {json.dumps(x)}\n") for x in v)
    return f"{pad}{json.dumps(v)}\n"


def test_round_trips_of_nested_values():
    import random

    rng = random.Random(4)

    def value(depth):
        kind = rng.randrange(3) if depth else 2
        if kind == 0:
            return {rng.choice(["a", "b c", "ñ: x", "#k", "-"]) + str(i): value(depth - 1) for i in range(rng.randrange(4))}
        if kind == 1:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return rng.choice([None, True, 3, -2.5, "", "text", "a: b", "# no", "1", "línea\ncon \"citas\" \\ ", "[x]", "- y"])

    for _ in range(300):
        v = value(4)
        assert list(yamls.documents(emit(v))) == [v]


def test_a_table_of_texts(spark):
    rows = [(1, "- a: 1\n- b: [x]"), (2, "k:\n  l: |\n    m"), (3, "a: [1"), (4, None), (4, "")]
    got = [tuple(r) for r in yamls.yaml_rows(spark.createDataFrame(rows, "id int, text string"), "text", ["id"]).collect()]
    assert sorted((i, at or 0, json.loads(x) if x else None, bool(e)) for i, at, x, e in got if i < 4) == sorted([(1, 0, {"a": 1}, False), (1, 1, {"b": ["x"]}, False), (2, 0, {"k": {"l": "m"}}, False), (3, 0, None, True)], key=lambda r: r[:2])
    assert not [r for r in got if r[0] == 4]
