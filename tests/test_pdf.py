"""Page texts of PDF documents: round trips, odd forms, damage."""

import random
import zlib

import pytest

from lexledger.sources import pdf

TEXTS = ["", "one", "Año (5.º) \\ fin\nsegunda línea (", "€ 1.000,00\n\nla última", "x" * 5000]


@pytest.mark.parametrize("unicode", [False, True])
@pytest.mark.parametrize("packed", [False, True])
def test_pages_come_back(unicode, packed):
    pages = TEXTS + (["中文 🙂 ½", "Ελληνικά\nтекст"] if unicode else [])
    got = list(pdf.page_texts(pdf.write_pdf(pages, unicode, packed)))
    squeeze = lambda s: "\n".join(x for x in s.split("\n") if x)  # noqa: E731  empty lines don't show
    assert [(n, squeeze(t), e) for n, t, e in got] == [(i, squeeze(p), None) for i, p in enumerate(pages, 1)]


def one(content: bytes, font: bytes = b"<< /Type /Font >>", more: bytes = b"") -> bytes:
    return b"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Kids [3 0 R] >> endobj\n3 0 obj << /Type /Page /Contents [4 0 R 4 0 R] /Resources << /Font << /F 5 0 R >> >> >> endobj\n4 0 obj << /Length 6 0 R >> stream\n" + content + b"\nendstream endobj\n5 0 obj " + font + b" endobj\n6 0 obj " + str(len(content)).encode() + b" endobj\n" + more


def text_of(data):
    return [(t, e) for _, t, e in pdf.page_texts(data)]


def test_text_operators():
    body = rb"BT /F 9 Tf [(Ab) -300 (cd) 20 (ef)] TJ 0 -12 Td (g\(h\)\051\n) Tj (i) ' 5 0 Td <6A6b> Tj % (no)" + b"\nET"
    assert text_of(one(body)) == [("Ab cdef\ng(h))\n\ni jk\nAb cdef\ng(h))\n\ni jk", None)]


def test_maps_with_ranges():
    cmap = b"1 begincodespacerange <00> <ff> endcodespacerange 2 beginbfrange <41> <43> <0061> <44> <45> [<00660069> <0078>] endbfrange"
    font = b"<< /Type /Font /ToUnicode 7 0 R >>"
    assert text_of(one(b"BT /F 9 Tf (ABCDEZ) Tj ET", font, b"7 0 obj << >> stream\n" + cmap + b"\nendstream endobj"))[0][0].split("\n")[0] == "abcfix�"


def test_later_objects_win():
    data = one(b"BT (old) Tj ET") + b"4 0 obj << >> stream\nBT (new) Tj ET\nendstream endobj\n"
    assert text_of(data) == [("new\nnew", None)]


@pytest.mark.parametrize("data, error", [(None, "no PDF"), (b"", "no PDF"), (b"plain", "no PDF"), (b"%PDF-1.4 nothing", "no pages"), (one(b"") + b"trailer << /Encrypt 9 0 R >>", "encrypted"), (one(b"BT (x Tj"), "without an end")])
def test_damage_is_an_error_row(data, error):
    got = list(pdf.page_texts(data))
    assert len(got) == 1 and error in got[0][2] and got[0][1] is None


def test_cut_and_garbled_files_never_raise():
    rng = random.Random(1)
    whole = pdf.write_pdf(TEXTS, True, True)
    for _ in range(150):
        data = bytearray(whole[: rng.randrange(len(whole))] if rng.random() < 0.5 else whole)
        for _ in range(rng.randrange(20)):
            if data:
                data[rng.randrange(len(data))] = rng.randrange(256)
        list(pdf.page_texts(bytes(data)))


def test_a_bomb_is_refused(monkeypatch):
    monkeypatch.setattr(pdf, "MOST_BYTES", 1000)
    data = one(b"").replace(b"<< /Length 6 0 R >> stream\n", b"<< /Filter /FlateDecode >> stream\n" + zlib.compress(b"x" * 100_000))
    assert "too large" in text_of(data)[0][1]


def test_a_table_of_documents(spark):
    rows = [(1, "a", pdf.write_pdf(["p1", "p2"])), (2, None, b"broken"), (3, "c", None), (3, "c", pdf.write_pdf(["q"]))]
    got = pdf.pdf_pages(spark.createDataFrame(rows, "id int, error_ string, content binary"), ["id", "error_"]).collect()
    assert sorted((r.id, r.page or 0, r.text or "", bool(r.error)) for r in got) == [(1, 1, "p1", False), (1, 2, "p2", False), (2, 0, "", True), (3, 0, "", True), (3, 1, "q", False)]
    assert pdf.pdf_pages(spark.createDataFrame([], "id int, content binary"), ["id"]).count() == 0
