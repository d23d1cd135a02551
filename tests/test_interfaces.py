"""Commands, the read interface, releases, HTTP documents, and Column forms against their Python forms."""

import http.server
import io
import json
import threading
from datetime import datetime
from decimal import Decimal

import pytest
from test_grammar import LAW, xml

from lexledger import api, cli
from lexledger.functions import numbers
from lexledger.sources import sinks

ACT = "Imponer a {}, por la comisión de una infracción grave " + LAW + ", por no informar el 3 de marzo de 2007, una multa por importe de {} euros."


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    from lexledger.plans.assembly import assemble, parsed_corpus
    from lexledger.sources import readers

    folder = tmp_path_factory.mktemp("built")
    (folder / "in").mkdir()
    for i, who in enumerate(["Ejemplo, S.A.", "don Uno Dos", "Tercera, S.L."], 1):
        (folder / "in" / f"BOE-A-2010-{i}.xml").write_bytes(xml(ACT.format(who, f"{i}0.000"), boe=f"BOE-A-2010-{i}"))
    files = readers.xml_corpus(spark, {"dev": str(folder / "in")})
    sinks.release(spark, assemble(parsed_corpus(files), files, datetime(2010, 6, 1)), str(folder / "out"), "v0.1.0", "abc", ["not exhaustive"])
    return folder


def test_release(spark, built):
    assert sinks.is_release("v1.2.3-rc.1") and not sinks.is_release("1.2.3")
    with pytest.raises(ValueError, match="tag"):
        sinks.release(spark, {}, "/nowhere", "latest", "abc")
    sums = {r._c0: (int(r._c1), r._c2) for r in spark.read.csv(f"{built}/out/v0.1.0/_SHA256SUMS").collect()}
    assert any(p.startswith("cases.parquet/") for p in sums) and all(len(h) == 64 for _, h in sums.values())
    about = api.metadata(spark, f"{built}/out").first()
    assert (about.release, about.code_commit, len(about.corpus_logical_sha256)) == ("v0.1.0", "abc", 64)
    cover = json.loads(api.artifact(spark, f"{built}/out", api.COVERAGE).first().value)
    assert cover["counts"]["sanctions"] == 3 and cover["limitations"] == ["not exhaustive"] and cover["corpora"][0]["n_cases"] == 3


def test_read_interface(spark, built):
    from lexledger.sources import readers

    t = readers.ledger_tables(spark, f"{built}/out/v0.1.0")
    get = lambda path, **p: {k: v.collect() for k, v in api.get(spark, t, path, f"{built}/out", **p).items()}
    assert get("/health")["health"][0].asDict() == {"status": "ok", "release": "v0.1.0"}
    assert get("/metadata")["metadata"][0].api_version == "v1" and get("/coverage")["coverage"]
    assert get("/stats")["totals"][0].total_fines == "60000.00"
    assert [r.case_id for r in get("/cases", limit=2, offset=1)["cases"]] == ["CNMV-BOE-A-2010-2", "CNMV-BOE-A-2010-3"]
    assert get("/cases/CNMV-BOE-A-2010-1")["sanctions"][0].amount == Decimal(10000)
    assert not get("/cases/CNMV-BOE-A-2010-1", known_at="2000-01-01")["sanctions"]
    (one,) = get("/respondents", q="ejemplo")["respondents"]
    assert get(f"/respondents/{one.respondent_id}")["cases"][0].case_id == "CNMV-BOE-A-2010-1"
    assert get("/laws")["laws"][0].n_cases == 3 and len(get("/laws/Ley%2024/articles/99.o")["infringements"]) == 3 and len(get("/status")["status"]) == 3
    for path, p, kind in (("/nope", {}, LookupError), ("/cases", {"limit": 501}, ValueError), ("/laws", {"x": 1}, ValueError)):
        with pytest.raises(kind):
            api.get(spark, t, path, **p)
    with pytest.raises(LookupError):
        api.get(spark, t, "/health")
    assert api.metadata(spark, str(built / "in")).first().release is None


def test_commands(spark, built, tmp_path):
    tables = f"{built}/out/v0.1.0"

    def run(*argv):
        out = io.StringIO()
        return cli.run(spark, list(argv), out), out.getvalue()

    assert '"n_cases":3' in run("stats", "--tables", tables)[1]
    assert "20000.00" in run("case", "BOE-A-2010-2", "--tables", tables)[1] and run("case", "none", "--tables", tables)[0] == 1
    assert "Ejemplo" in run("respondent", "ejemplo", "--tables", tables)[1] and "99.o" in run("article", "24/1988", "99.o", "--tables", tables)[1]
    assert run("export", "cases", str(tmp_path / "c"), "--tables", tables, "--fmt", "csv")[0] == 0 and run("export", "cases", "x", "--tables", tables, "--fmt", "xml")[0] == 1
    code, text = run("validate", "--tables", tables)
    assert code == 0, text
    assert '"n_sanctions":1' in run("parse", str(built / "in"))[1] and "issues" not in run("coverage", "--tables", tables)[1]
    assert run("build", str(built / "in"), str(tmp_path / "b"))[0] == 0 and '"n_cases":3' in run("stats", "--tables", str(tmp_path / "b"))[1]


def test_publications_without_blocks_are_cases_and_issues(spark, tmp_path):
    from lexledger.grammar.udf import parse_publications
    from lexledger.operators import gates
    from lexledger.plans.assembly import assemble, parsed_corpus
    from lexledger.sources import readers

    (tmp_path / "BOE-A-2010-1.xml").write_bytes(xml("Nada que imponer.", boe="BOE-A-2010-1"))
    (tmp_path / "BOE-A-2010-2.xml").write_bytes(xml(f"Imponer a Ejemplo, S.A., por la comisión de una infracción grave {LAW}, por no informar.", boe="BOE-A-2010-2"))
    files = readers.xml_corpus(spark, {"dev": str(tmp_path)})
    t = assemble(parsed_corpus(files), files, datetime(2010, 6, 1))
    assert sorted((r.boe_id, r.kind) for r in t["parse_issues"].collect()) == [("BOE-A-2010-1", "NO_BLOCK"), ("BOE-A-2010-2", "NO_SANCTION")]
    publications = files.select("corpus", "path").join(parse_publications(files), "path").select("corpus", "publication.*")
    held = {r.gate: r.n_violations for r in gates.release_gates(gates.table_violations(t, datetime(2010, 6, 1)), gates.publication_violations(publications, t["cases"]), gates.holdout_violations(publications)).collect()}
    assert {k for k, n in held.items() if n} == {"case_has_infringement", "case_has_sanction", "publication_has_block", "publication_has_sanction", "holdout_has_sanctions"}


def test_each_gate_fails_alone(spark):
    """One planted violation turns its gate red, and only gates that speak of the same fault with it."""
    from lexledger.operators import gates

    day = "DATE'2008-06-01'"
    base = {
        "documents": "SELECT 'B' AS document_id", "parse_issues": "SELECT 'NOTE' AS kind", "respondents": "SELECT 'R' AS respondent_id", "events": "SELECT 'E' AS event_id, TIMESTAMP'2010-01-01' AS observed_at",
        "cases": f"SELECT 'C' AS case_id, 'B' AS canonical_boe_id, {day} AS sanctioning_resolution_date, {day} AS boe_publication_date, 'INCONCLUSIVE' AS appeal_observation_status, CAST(NULL AS STRING) AS coverage_basis_id",
        "infringements": f"SELECT 'I' AS infringement_id, 'C' AS case_id, 'SERIOUS' AS severity, '1' AS article_normalized, 'L' AS statute_normalized, {day} AS conduct_end_date",
        "sanctions": "SELECT 'S' AS sanction_id, 'C' AS case_id, 'I' AS infringement_id, 'R' AS respondent_id, 'MONETARY_FINE' AS sanction_type, CAST(5 AS DECIMAL(18,2)) AS amount",
        "evidence": "SELECT 'S' AS entity_id, 'B' AS document_id, 'VALUE_BINDING_PROVEN' AS proof_level, 'p' AS locator, 'sha' AS artifact_sha256, TIMESTAMP'2010-01-01' AS observed_at",
    }
    faults = {
        "documents_parsed": ("parse_issues", "'NOTE'", "'PARSE_FAILED'"), "severity_present": ("infringements", "'SERIOUS'", "'UNKNOWN'"), "article_present": ("infringements", "'1'", "CAST(NULL AS STRING)"), "statute_present": ("infringements", "'L'", "CAST(NULL AS STRING)"),
        "sanction_has_respondent": ("sanctions", "'R'", "CAST(NULL AS STRING)"), "fine_has_amount": ("sanctions", "5", "NULL"), "non_monetary_has_no_amount": ("sanctions", "MONETARY_FINE", "SUSPENSION"), "references_resolve": ("sanctions", "'R'", "'Q'"),
        "resolution_before_publication": ("cases", f"{day} AS sanct", "DATE'2009-01-01' AS sanct"), "conduct_before_publication": ("infringements", day, "DATE'2009-01-01'"), "evidence_has_document": ("evidence", "'B'", "'X'"),
        "proven_value_has_locator_and_sha": ("evidence", "'p'", "CAST(NULL AS STRING)"), "verified_negative_has_basis": ("cases", "INCONCLUSIVE", "NOT_OBSERVED_WITHIN_VERIFIED_COVERAGE"), "no_future_observation": ("events", "2010", "2030"),
        "fine_amount_is_decimal": ("sanctions", "DECIMAL(18,2)", "DOUBLE"), "sanction_has_evidence": ("evidence", "'S'", "'T'"), "sanction_id_unique": ("sanctions", "SELECT 'S'", "SELECT EXPLODE(ARRAY('S', 'S'))"),
    }
    every = {}
    for gate, (table, old, new) in ({"": ("documents", "'B'", "'B'")} | faults).items():
        assert old in base[table]
        t = {k: spark.sql(v.replace(old, new) if k == table else v) for k, v in base.items()}
        every[gate] = {r.gate for r in gates.release_gates(gates.table_violations(t, datetime(2011, 1, 1))).collect() if not r.ok}
    assert every.pop("") == set()
    assert every == {g: {g} for g in faults}


def test_documents_over_http(spark, tmp_path):
    from lexledger.sources.http import HttpDocuments

    class Handler(http.server.BaseHTTPRequestHandler):
        asked: list = []

        def do_GET(self):
            self.asked.append(self.path)
            code = 200 if self.path == "/a" or self.asked.count(self.path) > 1 and self.path == "/busy" else 429 if self.path == "/busy" else 404
            self.send_response(code)
            self.end_headers()
            if code == 200:
                self.wfile.write(b"body")

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    spark.dataSource.register(HttpDocuments)
    got = spark.read.format("http_documents").option("urls", "\n".join(f"{base}{p}" for p in ("/a", "/busy", "/none"))).option("pause", "0").option("wait", "0.01").load().collect()
    server.shutdown()
    assert [(r.url.removeprefix(base), r.status, r.content and bytes(r.content)) for r in got] == [("/a", 200, b"body"), ("/busy", 200, b"body"), ("/none", 404, None)]
    assert Handler.asked == ["/a", "/busy", "/busy", "/none"]


def test_column_and_python_forms_agree(spark):
    from pyspark.sql import functions as F

    raw = ["1.234,56", "1.234.56", "1.234.567", "12.5", "1,2,3", ",5", "5,", "x", "", "300.506.05", "0,5", "12", "1234.567,8"]
    words = ["cien mil millones", "dos millones trescientos mil", "mil", "un millón", "treinta y cinco", "veintitrés mil", "doscientas mil", "nada", "", "mil mil", "millones de euros"]
    texts = [
        "multa de 1.000 euros (mil euros)", "(12.000 €) y 5.000 euros", "importe de 1.234,5 €", "importe de 300.506,05 (letras)", "trescientos mil (300.000) euros", "multa de doscientos mil euros", "nada", "3 de mayo",
        "10.000 (diez mil) de euros", "una multa y mil quinientos euros", "€ 5", "7 euros y (8) euros",
    ]
    rows = spark.createDataFrame([(x,) for x in raw + words + texts], "x string").select("x", numbers.es_number(F.col("x")).alias("n"), numbers.words_to_int(F.col("x")).alias("w"), numbers.amount(F.col("x")).alias("a")).collect()
    for r in rows:
        assert r.n == numbers.es_number_of(r.x), r.x
        assert r.w == numbers.words_to_int_of(r.x), r.x
        assert r.a == next((v for v, _ in numbers.amounts_of(r.x)), None), r.x
