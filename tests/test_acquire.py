"""From days to documents to a ledger, over a local server; repeated looks at PDF documents."""

import http.server
import io
import json
import threading
from datetime import datetime

import pytest

from lexledger import cli
from lexledger.plans import maintenance
from lexledger.sources import acquire, pdf, readers, store

XML = (
    "<documento><metadatos><identificador>{0}</identificador><titulo>Resolución por la que se publica la sanción</titulo><fecha_publicacion>20200103</fecha_publicacion></metadatos><texto><p class=\"parrafo\">Imponer a Uno, S.A., "
    "por la comisión de una infracción grave tipificada en el artículo 99, letra o), de la Ley 24/1988, de 28 de julio, por no informar el 3 de marzo de 2007, una multa por importe de 100 euros.</p></texto></documento>"
)


@pytest.fixture
def site():
    pages, hits = {}, []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            hits.append(self.path)
            body = pages.get(self.path)
            self.send_response(200 if body is not None else 404)
            self.end_headers()
            self.wfile.write(body or b"")

        def log_message(self, *_):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", pages, hits
    s.shutdown()


def test_from_days_to_a_ledger(spark, site, tmp_path):
    base, pages, hits = site
    item = lambda i, title="Resolución de sanción": {"identificador": i, "titulo": title, "url_xml": f"{base}/xml/{i}"}
    pages["/d/20200103"] = json.dumps({"data": {"sumario": {"diario": [{"seccion": {"codigo": "3", "departamento": {"codigo": "1040", "item": [item("BOE-A-2020-1"), item("BOE-A-2020-2"), item("BOE-A-2020-9", "Orden")]}}}]}}}).encode()
    pages["/xml/BOE-A-2020-1"] = XML.format("BOE-A-2020-1").encode()
    out = io.StringIO()
    run = lambda *a: cli.run(spark, list(a), out)
    days, docs = str(tmp_path / "days"), str(tmp_path / "docs")
    assert run("enumerate-history", "2020-01-02", "2020-01-03", days, "--url", base + "/d/{yyyymmdd}", "--pause", "0.01") == 0
    assert '"days":2,"items":3,"errors":0' in out.getvalue()
    assert run("fetch", days, docs, "--pause", "0.01") == 0
    assert sorted(h for h in hits if h.startswith("/xml")) == ["/xml/BOE-A-2020-1", "/xml/BOE-A-2020-2"]
    pages["/xml/BOE-A-2020-2"] = XML.format("BOE-A-2020-2").encode()
    run("fetch", days, docs, "--pause", "0.01")  # the one that failed, and no other
    assert sorted(h for h in hits if h.startswith("/xml")) == ["/xml/BOE-A-2020-1", *["/xml/BOE-A-2020-2"] * 2]
    maintenance.build(spark, acquire.corpus(spark, docs, "history"), str(tmp_path / "ledger"), datetime(2024, 1, 1))
    assert readers.ledger_tables(spark, str(tmp_path / "ledger"))["cases"].count() == 2


def test_repeated_looks_at_pdf_documents(spark, site, tmp_path):
    base, pages, _ = site
    folder = str(tmp_path / "pdf")
    pages |= {"/a": pdf.write_pdf(["uno", "es firme en vía administrativa"]), "/b": b"<html>", "/c": pdf.write_pdf([""])}
    links = spark.createDataFrame([(x, f"{base}/{x}") for x in "abcd"], "boe_id string, url string")
    got = {r.boe_id: r for r in acquire.pdf_status(spark, links, folder, pause=0.01).collect()}
    assert {k: r.retrieval for k, r in got.items()} == {"a": "OK", "b": "FETCH_FAILED", "c": "EXTRACT_EMPTY", "d": "FETCH_FAILED"}
    assert [(n.kind, n.page) for n in got["a"].notes] == [("FIRMNESS", 2)] and got["d"].sha256 is None
    pages["/a"] = pdf.write_pdf(["uno", "es firme en vía administrativa", "ha interpuesto recurso de alzada"])
    pages["/d"] = pages["/c"]
    again = {r.boe_id: r for r in acquire.pdf_status(spark, links, folder, pause=0.01).collect()}
    assert again["a"].changes == 1 and len(again["a"].notes) == 2 and again["a"].first_observed_at == got["a"].first_observed_at <= again["a"].observed_at
    assert again["d"].retrieval == "EXTRACT_EMPTY" and store.objects(spark, folder).count() == 4


def test_probe_command(spark, tmp_path):
    for name, body in (("one", "<table><tr><td>1</table>"), ("two", "<section><tr><td>1</section>")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.html").write_text(body)
    out = io.StringIO()
    assert cli.run(spark, ["probe", str(tmp_path / "one"), "--out", str(tmp_path / "p")], out) == 0
    assert cli.run(spark, ["probe", str(tmp_path / "two"), "--before", str(tmp_path / "p")], out) == 0
    assert '"path":"/table","share_before":1.0,"share_now":0.0,"change":"LOST"' in out.getvalue()
