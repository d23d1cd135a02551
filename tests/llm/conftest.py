import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, chunk int, body string, n_words string, score string"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["the", "on", "ea", "sh", "ing", "er", "tion", "é", "ö"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents() -> list[tuple]:
    """A small corpus with everything awkward: nulls, empties, white space, copies, near copies, repeated rows, shared
    passages, a very long text, a text of one word repeated, and columns whose names clash with the operators' own."""
    rng = random.Random(5)
    texts: list[str | None] = [prose(rng, rng.randint(5, 120)) for _ in range(24)]
    passage = prose(rng, 70)
    lines = "\n".join(prose(rng, 9) for _ in range(4))
    texts += [None, "", "   \n\t ", "word", "one two three", texts[0], texts[0], texts[1] + " tail", "x " + passage + " " + prose(rng, 30), prose(rng, 20) + "\n" + passage, "Ab " * 300, texts[3].upper(), "ÀÉ 中文 ½ don't they'll \x00\x1f"]
    texts += [f"{prose(rng, 5)}\n{lines}\n{prose(rng, 6)}", f"{lines}\n{prose(rng, 6)}", f"a\nb\nc\n{lines}"]
    near = texts[2] + " " + prose(rng, 200)
    texts += [near, near.replace(" the", " thx", 1), near + " end", passage * 40]
    rows = [(i, t, "en" if i % 3 else "fr", f"s{i % 2}", len(t or ""), 7, "clash", "clash", "clash") for i, t in enumerate(texts)]
    return rows + [rows[4], rows[4], (None, texts[5], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)
