"""The grammar, rule by rule, on invented publications; assembly, gates, sinks and streams on top."""

from datetime import datetime
from decimal import Decimal

import pytest

from lexledger.functions import legal, numbers, text
from lexledger.grammar import publication as p

LAW = "tipificada en el artículo 99, letra o), de la Ley 24/1988, de 28 de julio, del Mercado de Valores"


def xml(*paragraphs: str, boe: str = "BOE-A-2010-1", title: str = "Resolución por la que se publica la sanción", kind: str = "parrafo_2") -> bytes:
    body = "".join(f'<p class="{kind}">{x}</p>' for x in paragraphs)
    return f"<documento><metadatos><identificador>{boe}</identificador><titulo>{title}</titulo><fecha_publicacion>20100310</fecha_publicacion><fecha_disposicion>20100301</fecha_disposicion></metadatos><texto>{body}</texto></documento>".encode()


def read(*paragraphs: str) -> dict:
    return p.parse(xml(*paragraphs))


def fines(r: dict) -> list:
    return [(s["subject"], s["type"], s["amount"]) for b in r["blocks"] for s in b["sanctions"]]


def test_impose_with_offence():
    r = read(f"Imponer a Ejemplo, S.A., por la comisión de una infracción muy grave {LAW}, en relación con los artículos 45, 47 y 48 de la misma Ley, por no comunicar el 3 de marzo de 2007 sus operaciones, una multa por importe de 650.000 euros.")
    (b,) = r["blocks"]
    assert (b["severity"], b["article"], b["statute"]) == ("VERY_SERIOUS", "99.o", "Ley 24/1988")
    assert [(x["article"], x["statute"]) for x in b["related"]] == [(a, "Ley 24/1988") for a in ("45", "47", "48")]
    assert (b["conduct_start"], b["conduct_end"], b["conduct_precision"]) == ("2007-03-03", "2007-03-03", "day")
    assert fines(r) == [("Ejemplo, S.A", "MONETARY_FINE", Decimal(650000))] and not r["issues"]


def test_context_header_and_bullets():
    r = read("Imponer a don Uno Dos y a Gestora, SGIIC, S.A.:", f"− Por la comisión de una infracción grave {LAW}, por no informar en 2008, multa de 10.000 euros.", f"− Por la comisión de una infracción grave {LAW}, por no informar, suspensión por plazo de tres meses.")
    assert len(r["blocks"]) == 2
    assert fines(r) == [("don Uno Dos", "MONETARY_FINE", Decimal(10000)), ("Gestora, SGIIC, S.A", "MONETARY_FINE", Decimal(10000)), ("don Uno Dos", "SUSPENSION", None), ("Gestora, SGIIC, S.A", "SUSPENSION", None)]
    assert r["blocks"][1]["sanctions"][0]["duration_raw"] == "tres meses"
    assert (r["blocks"][0]["conduct_start"], r["blocks"][0]["conduct_end"]) == ("2008-01-01", "2008-12-31")


def test_respectively():
    r = read(f"Imponer a don Uno y don Dos, por la comisión de una infracción grave {LAW}, por no informar, multas por importe de 10.000 euros y 20.000 euros, respectivamente.")
    assert fines(r) == [("don Uno", "MONETARY_FINE", Decimal(10000)), ("don Dos", "MONETARY_FINE", Decimal(20000))]


def test_sanction_before_offence_takes_the_amount_behind():
    r = read(f"Imponer a don Uno Dos una multa, por la comisión de una infracción muy grave {LAW}, al haber remitido fuera de plazo una comunicación, por un importe de ciento cincuenta mil euros (150.000 euros).")
    assert fines(r)[-1] == ("don Uno Dos", "MONETARY_FINE", Decimal(150000))


def test_lettered_sanctions():
    r = read(f"«Imponer a Banco Ajeno, S.A., por la comisión de una infracción muy grave {LAW}, por comunicar información el día 26 de febrero de 2004, las siguientes sanciones:", "a) Una multa por importe de 1.000.000 euros (un millón de euros).", "b) Una sanción de suspensión de la actividad, por plazo de tres meses.»")
    assert [(k, a) for _, k, a in fines(r)] == [("MONETARY_FINE", Decimal(1000000)), ("SUSPENSION", None)]


def test_declared_predecessor_and_successor():
    r = read("Declarar que Caja Vieja ha incurrido en la comisión de una infracción muy grave " + LAW + ", por no informar en 2009.", "Imponer a Banco Nuevo, S.A., como sucesor en la responsabilidad declarada de Caja Vieja, una multa por importe de 80.000 euros.")
    first, second = r["blocks"]
    assert first["declared"] and not first["sanctions"]
    assert second["sanctions"][0]["declared_subject"] == "Caja Vieja" and second["sanctions"][0]["amount"] == 80000


def test_subject_first_and_bare_lines():
    r = read(f"Imponer por la comisión de una infracción grave {LAW}, por no informar:", "– A don Uno Dos, multa de 5.000 euros.", "– A Tercera, S.L.: una multa por importe de 6.000 euros.")
    assert [a for _, _, a in fines(r)] == [Decimal(5000), Decimal(6000)]


def test_unread_lines_are_issues_only_in_an_open_block():
    r = read("• Algo antes", f"Imponer a Ejemplo, S.A., por la comisión de una infracción grave {LAW}, por no informar, multa de 1.000 euros.", "9. Otra cosa con 3 euros dentro")
    assert [i["kind"] for i in r["issues"]] == ["UNREAD_LINE"]


def test_flags_dates_kind_and_errors():
    r = p.parse(xml("Resolución del Consejo de fecha 3 de mayo de 2009 y 4 de junio de 2009, firme en vía administrativa; recurso contencioso-administrativo; habiéndose renunciado.", title="Corrección de errores de la Resolución"))
    assert r["sanctioning_resolution_date"] == "2009-06-04" and r["administrative_finality_observed"] and r["judicial_review_mentioned"] and r["renunciation_observed"] and not r["administrative_appeal_observed"]
    assert (r["document_kind"], r["publication_date"], r["document_date"]) == ("SUBSEQUENT_EVENT", "2010-03-10", "2010-03-01")
    assert p.parse(b"<documento><metadatos/></documento>")["issues"][0]["kind"] == "NO_TEXT"
    for bad in (b"<a", b"<!DOCTYPE x [<!ENTITY e 'x'>]><a/>"):
        with pytest.raises(ValueError):
            p.parse(bad)
    assert p.parse(xml("uno <b>dos</b> tres"))["paragraphs"][0]["text"] == "uno dos tres"


@pytest.mark.parametrize(("raw", "want"), [("9 de marzo y 29 de mayo de 2020", ("2020-03-09", "2020-05-29")), ("entre el 4 de marzo y el 18 de mayo de 2022", ("2022-03-04", "2022-05-18")), ("los días 8 y 9 de junio de 2011", ("2011-06-08", "2011-06-09")), ("según la Ley 24/1988, de 28 de julio de 1988", (None, None)), ("durante 2007 y 2009", ("2007-01-01", "2009-12-31")), ("el 31 de febrero de 2010", ("2010-01-01", "2010-12-31"))])
def test_conduct_period(raw, want):
    assert p.conduct_period(raw)[:2] == want


@pytest.mark.parametrize(("raw", "want"), [
    ("Bolsa y Ahorro, S.A.", ["Bolsa y Ahorro, S.A"]), ("Ejemplo, S.L. y su consejero delegado, don Uno", ["Ejemplo, S.L", "su consejero delegado, don Uno"]),
    ("don Uno, don Dos y doña Tres", ["don Uno", "don Dos", "doña Tres"]), ("Una, S.A. (antes, Otra, S.A.) y Dos, S.L.", ["Una, S.A. (antes, Otra, S.A.)", "Dos, S.L"]),
])
def test_split_subjects(raw, want):
    assert p.split_subjects(raw) == want


def test_split_role_and_amounts():
    assert p.split_role("don Uno (consejero delegado)") == ("don Uno", "consejero delegado")
    assert p.split_role("su presidente, don Uno") == ("don Uno", "su presidente")
    assert p.split_role("don Uno, administrador único") == ("don Uno", "administrador único")
    assert p.amounts("seiscientos cincuenta mil (650.000) euros")[0][0] == 650000
    assert p.amounts("300.506.05 euros")[0][0] == p.amounts("importe de 300.506,05 (trescientos mil)")[0][0] == Decimal("300506.05")
    assert numbers.words_to_int_of("cien mil millones") == 10**11 and numbers.words_to_int_of("nada") is None


def test_columns_agree_with_the_grammar(spark):
    from pyspark.sql import functions as F

    raw = ["93.a)", "94 bis", "99, letra z) bis", "107 quáter 3.c", "no", "300.506.05", "1.234,5", "650.000", "veintitrés mil", "Ley 22/2014, de 12", "Reglamento (UE) nº 596/2014", "muy grave"]
    rows = spark.createDataFrame([(x,) for x in raw], "x string").select("x", legal.normalize_article(F.col("x")).alias("a"), numbers.es_number(F.col("x")).alias("n"), numbers.words_to_int(F.col("x")).alias("w"), legal.normalize_statute(F.col("x")).alias("s")).collect()
    for r in rows:
        assert r.a == p.article(r.x) and r.w == numbers.words_to_int_of(r.x) and r.s == p.statute(r.x)
        assert r.n == numbers.es_number_of(r.x)


def test_text_functions(spark):
    from pyspark.sql import functions as F

    r = spark.createDataFrame([("  A &amp;  Ñandú\tpérez ", "Título (BOE de 3 de mayo).", "a b c", "b c d")], "a string, t string, x string, y string").select(
        text.collapse_ws(F.col("a")).alias("ws"), text.normalize_key(F.col("a")).alias("key"), text.title_key(F.col("t")).alias("title"), text.jaccard(F.col("x"), F.col("y")).alias("j"), text.jaccard(F.col("x"), F.lit("")).alias("z")
    ).first()
    assert (r.ws, r.key, r.title, r.j, r.z) == ("A & Ñandú pérez", "a & nandu perez", "titulo", 0.5, 0.0)


@pytest.fixture(scope="session")
def corpus(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    act = "Imponer a {}, por la comisión de una infracción grave " + LAW + ", por no informar el 3 de marzo de 2007, una multa por importe de {} euros."
    (folder / "BOE-A-2010-1.xml").write_bytes(xml("Resolución de fecha 3 de enero de 2010, firme en vía administrativa.", act.format("Ejemplo, S.A.", "10.000")))
    (folder / "BOE-A-2010-2.xml").write_bytes(xml(act.format("don Uno Dos", "20.000"), boe="BOE-A-2010-2"))
    (folder / "BOE-A-2010-3.xml").write_bytes(b"<broken")
    return str(folder)


def test_assembly_gates_and_hash(spark, corpus, tmp_path):
    from lexledger.operators import gates, ledger
    from lexledger.plans.assembly import assemble, parsed_corpus
    from lexledger.schemas import TABLES
    from lexledger.sources import readers, sinks

    files = readers.xml_corpus(spark, {"dev": corpus})
    seen = spark.createDataFrame([("BOE-A-2010-1", "s", [("APPEAL_NOTICE", 2, "interpuesto recurso")], None, "OK", "2010-04-01", "2010-05-01"), ("BOE-A-2010-2", "s", [], None, "OK", "2010-04-01", "2010-05-01")], "boe_id string, sha256 string, notes array<struct<kind: string, page: int, verbatim: string>>, status string, retrieval string, first_observed_at string, observed_at string")
    t = assemble(parsed_corpus(files), files, datetime(2010, 6, 1), observations=seen)
    assert {k: v.count() for k, v in t.items()} == {"cases": 2, "case_status": 2, "status_notes": 1, "events": 6, "documents": 3, "respondents": 2, "case_respondents": 2, "infringements": 2, "related_provisions": 0, "sanctions": 2, "evidence": 14, "parse_issues": 1, "review_items": 0}
    assert set(t) == set(TABLES)
    rules = {r.rule_resolution_status for r in t["infringements"].collect()}
    assert rules == {"NO_RULE_DEFINED"}
    states = {r.case_id: (r.appeal_observation_status, r.coverage_basis_id is not None) for r in t["cases"].collect()}
    assert states == {"CNMV-BOE-A-2010-1": ("OBSERVED", True), "CNMV-BOE-A-2010-2": ("NOT_OBSERVED_WITHIN_VERIFIED_COVERAGE", True)}
    levels = {(r.field_name, r.proof_level) for r in t["evidence"].collect()}
    assert ("amount", "VALUE_BINDING_PROVEN") in levels and ("name", "DOCUMENT_BINDING_PROVEN") in levels
    sinks.write_tables(t, str(tmp_path), files=1)
    back = readers.ledger_tables(spark, str(tmp_path))
    held = {r.gate: r.ok for r in gates.release_gates(gates.table_violations(back, datetime(2010, 6, 1))).collect()}
    assert not held.pop("documents_parsed")
    assert all(held.values()), held
    assert sinks.manifest({"cases": back["cases"], "sanctions": back["sanctions"]}).collect() == sinks.manifest({"cases": t["cases"], "sanctions": t["sanctions"]}).collect()
    assert [(r.normalized_name, r.total_amount) for r in ledger.respondents(back).collect()] == [("Uno Dos", Decimal("20000.00")), ("Ejemplo, S.A", Decimal("10000.00"))]
    assert {k: v.count() for k, v in ledger.case_detail(back, "CNMV-BOE-A-2010-1", "2009-01-01").items() if k != "case"} == dict.fromkeys(["sanctions", "infringements", "respondents", "events", "evidence", "status_notes"], 0)
    for fmt in ("json", "csv", "parquet"):
        sinks.export(t["cases"], f"{tmp_path}/x-{fmt}", fmt)
    with pytest.raises(ValueError, match="xml"):
        sinks.export(t["cases"], f"{tmp_path}/x", "xml")
    sinks.load_views(spark, {"cases": t["cases"]}, "2010-06-01")
    assert spark.sql("SELECT count(*) AS n FROM cases").first().n == 2


def test_register_and_notes(spark):
    from lexledger.sources import readers

    html = '<table><tr><th>h</th></tr><tr><td><a href="/verdocumento?x">03/05/2010</a></td><td> Sanción  a X (BOE de 3 de mayo de 2010)</td></tr></table>Página 1 de 2'
    rows, pages = readers.register_page(html)
    assert pages == 2 and rows == [{"register_entry_date": "2010-05-03", "title": "Sanción a X (BOE de 3 de mayo de 2010)", "document_url": "/verdocumento?x"}]
    df = spark.createDataFrame([(0, html), (1, html)], "page int, html string")
    found = readers.register_rows(df, "html", "page")
    assert found.count() == 2 and [(r.page_index, r.problem) for r in readers.register_integrity(found).collect()] == [(0, "SHORT")]
    notes = readers.page_notes(spark.createDataFrame([("B", 1, "es firme en vía administrativa. Ha interpuesto recurso de alzada")], "k string, p int, t string"), "k", "p", "t").collect()
    assert sorted(n.kind for n in notes) == ["APPEAL_NOTICE", "FIRMNESS"]


def test_sql_functions(spark):
    from lexledger.grammar.udf import register

    register(spark)
    assert spark.sql("SELECT split_subjects('don Uno y don Dos') AS s").first().s == ["don Uno", "don Dos"]
    assert spark.sql("SELECT conduct_period('9 de marzo y 29 de mayo de 2020')['end'] AS e").first().e == "2020-05-29"
    assert spark.createDataFrame([(xml("x"),)], "b binary").selectExpr("get_json_object(publication_json(b), '$.boe_id') AS i").first().i == "BOE-A-2010-1"


def test_streams(spark, tmp_path):
    from lexledger.streaming import incremental, observation

    schema = "id string, sha256 string, observed_at timestamp"
    for day, rows in enumerate([[("a", "1", datetime(2020, 1, 1)), ("b", "1", datetime(2020, 1, 1))], [("a", "2", datetime(2020, 1, 2)), ("a", "2", datetime(2020, 1, 2))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    assert incremental.first_seen(spark, source(), ["id", "sha256"]).count() == 3
    got = {r.id: (r.sha256, r.first_observed_at.day, r.observed_at.day, r.changes) for r in observation.observe_stream(spark, source(), "id").collect()}
    assert got == {"b": ("1", 1, 1, 0), "a": ("2", 1, 2, 1)}


def test_both_forms_tell_respondents_alike(spark):
    from pyspark.sql import functions as F

    from lexledger.functions import legal
    from lexledger.grammar.udf import respondent_kind

    names = ["Caja Uno", "Banco Dos, S.A.", "don Uno Dos", "D. Tres", "d", "Ejemplo SGIIC, S. A. U.", "ejemplo, s.l.", "Persona anónima", "alguien", "La Sala", "av de nada", "AV Cinco", "GESTORA SEIS", "Fondos Siete (SICAV)", "", "Ocho Limited.", "savia", "no se identifica"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", legal.respondent_type(F.col("n")).alias("t")).collect()
    assert {r.n: r.t for r in got} == {n: respondent_kind(n) for n in names}
    assert respondent_kind("Caja Uno") == "LEGAL_PERSON" and respondent_kind("La Sala") == respondent_kind("savia") == "UNKNOWN"
