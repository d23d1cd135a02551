"""Registered queries over sources, grammar, assembly, gates and scalars: texts are made from the tables at their scale,
go through the operators, and come back as what they were made from."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexledger.api import responses
from lexledger.functions import dates, ids, legal, numbers, text
from lexledger.grammar.udf import parse_publications
from lexledger.operators import dataflow as flow
from lexledger.operators import gates, ledger, merkle
from lexledger.plans import maintenance, star
from lexledger.plans.assembly import assemble, parsed_corpus
from lexledger.schemas import TABLES
from lexledger.sources import pdf, probe, readers, sinks, store, yamls
from lexledger.streaming.incremental import state_dir, windowed_counts


def key():
    return F.col("o_orderkey")


def cust():
    return F.col("o_custkey")


def key_text():
    return key().cast("string")


def cust_text():
    return cust().cast("string")


BUILT = datetime(2024, 1, 15)


def orders(spark, d) -> DataFrame:
    return star.read(spark, d, "orders")


def euros():
    return F.translate(F.format_number(F.floor("o_totalprice"), 0), ",", ".")


def pick(by, options: list):
    """The option of index ``by``."""
    return F.element_at(F.array(*[F.lit(x) if not hasattr(x, "alias") else x for x in options]), (by + 1).cast("int"))


# ---- grammar: one template for each rule -----------------------------------------------------------------------------

LAW = "tipificada en el artículo 99, letra o), de la Ley 24/1988, de 28 de julio"
OFFENCE = f"por la comisión de una infracción grave {LAW}, por no informar el 3 de marzo de 2007"
ITEM = "– " + OFFENCE[0].upper() + OFFENCE[1:]
DECLARED = f"Declarar que Caja Uno ha incurrido en la comisión de una infracción grave {LAW}, por no informar el 3 de marzo de 2007."
DECLARES = ["Declarar la responsabilidad de Caja Uno por:", ITEM + "."]
#: (rule, paragraphs; blocks, declared ones, sanctions, subjects, times {A} counts, euros besides, linked to a declaration, issues, underlying)
RULES = [
    ("successor", [DECLARED, f"Imponer a Banco Dos, S.A., como sucesor en la responsabilidad declarada de Caja Uno, {OFFENCE}, una multa por importe de {{A}} euros."], 2, 1, 1, "Banco Dos, S.A", 1, 0, 1, "", 0),
    ("header_and_items", ["Imponer a Ejemplo, S.A.:", f"{ITEM}, multa de {{A}} euros."], 1, 0, 1, "Ejemplo, S.A", 1, 0, 0, "", 0),
    ("inline_sanction", ["Imponer a Ejemplo, S.A., una multa por importe de {A} euros."], 1, 0, 1, "Ejemplo, S.A", 1, 0, 0, "", 0),
    ("successor_list", [DECLARED, "Imponer a Banco Dos, S.A., como sucesor en la responsabilidad declarada de:", "Caja Uno, una multa por importe de {A} euros."], 2, 1, 1, "Banco Dos, S.A.", 1, 0, 2, "", 0),
    ("sanction_before_offence", [f"Imponer a Ejemplo, S.A. una multa, {OFFENCE}, por importe de {{A}} euros."], 1, 0, 1, "Ejemplo, S.A", 1, 0, 0, "", 0),
    ("numbered", [f"1. A Ejemplo, S.A., {OFFENCE}, una multa por importe de {{A}} euros."], 1, 0, 1, "Ejemplo, S.A", 1, 0, 0, "", 0),
    ("declared_list", DECLARES, 1, 1, 0, "", 0, 0, 0, "", 0),
    ("successor_scope", [*DECLARES, "Imponer a Banco Dos, S.A.:", "Como sucesor en la responsabilidad declarada de Caja Uno por:", f"{ITEM}, multa de {{A}} euros."], 2, 1, 1, "Banco Dos, S.A", 1, 0, 1, "", 0),
    ("own_scope", [*DECLARES, "Imponer a Caja Uno:", "Como responsable de:", f"{ITEM}, multa de {{A}} euros."], 2, 1, 1, "Caja Uno", 1, 0, 1, "", 0),
    ("and_for", ["Imponer a Ejemplo, S.A.:", f"{ITEM}, multa de {{A}} euros.", f"– Y {OFFENCE}, multa de 2.000 euros."], 2, 0, 2, "Ejemplo, S.A|Ejemplo, S.A", 1, 2000, 0, "", 0),
    ("sanction_without_block", ["• Una multa por importe de {A} euros.", f"Imponer a Ejemplo, S.A., {OFFENCE}, multa de {{A}} euros."], 1, 0, 1, "Ejemplo, S.A", 1, 0, 0, "SANCTION_WITHOUT_BLOCK", 0),
    ("amount_for_predecessor", [DECLARED, f"Imponer a Banco Dos, S.A., {OFFENCE}:", "– {A} euros, como sucesor en la responsabilidad declarada de Caja Uno."], 2, 1, 1, "Banco Dos, S.A", 1, 0, 1, "", 0),
    ("bare_line", [f"Imponer a Ejemplo, S.A., {OFFENCE}:", "Una multa por importe de {A} euros."], 1, 0, 1, "Ejemplo, S.A", 1, 0, 0, "", 0),
    ("subject_first", [f"Imponer {OFFENCE}:", "– A don Uno Dos: multa de {A} euros.", "• A Tercera, S.L., 5.000 euros."], 1, 0, 2, "don Uno Dos|Tercera, S.L", 1, 5000, 0, "", 0),
    ("lettered_subject", [f"Imponer {OFFENCE}:", "a) A don Uno Dos, multa de {A} euros."], 1, 0, 1, "don Uno Dos", 1, 0, 0, "", 0),
    ("lettered_sanctions", [f"Imponer a Ejemplo, S.A., {OFFENCE}, las siguientes sanciones:", "a) Una multa por importe de {A} euros a don Uno Dos.", "b) Suspensión por un plazo de tres meses."], 1, 0, 2, "don Uno Dos|Ejemplo, S.A", 1, 0, 0, "", 0),
    ("sanction_first", [f"Imponer {OFFENCE}:", "– Multa por importe de {A} euros a don Uno Dos."], 1, 0, 1, "don Uno Dos", 1, 0, 0, "", 0),
    ("other_resolution", [f"Imponer a Ejemplo, S.A., {OFFENCE}, multa de {{A}} euros.", "2. Resolución de la Audiencia de 4 de mayo de 2007."], 1, 0, 1, "Ejemplo, S.A", 1, 0, 0, "", 1),
    ("conduct_item", [f"Imponer a Ejemplo, S.A., {OFFENCE}, multa de {{A}} euros.", "a) Entre otras cosas, el día 5 de mayo de 2007."], 1, 0, 1, "Ejemplo, S.A", 1, 0, 0, "", 0),
    ("unread", [f"Imponer a Ejemplo, S.A., {OFFENCE}, multa de {{A}} euros.", "9. Otra cosa sin más"], 1, 0, 1, "Ejemplo, S.A", 1, 0, 0, "UNREAD_LINE", 0),
    ("respectively", [f"Imponer a don Uno y don Dos, {OFFENCE}, multas por importe de {{A}} euros y 20.000 euros, respectivamente."], 1, 0, 2, "don Uno|don Dos", 1, 20000, 0, "", 0),
    ("as_many_sanctions", [f"Imponer a Ejemplo, S.A., {OFFENCE.replace('una infracción grave', 'dos infracciones graves')}, dos multas por importe de {{A}} euros y 20.000 euros."], 2, 0, 2, "Ejemplo, S.A|Ejemplo, S.A", 1, 20000, 0, "", 0),
    ("fewer_sanctions", [f"Imponer a Ejemplo, S.A., {OFFENCE.replace('una infracción grave', 'dos infracciones graves')}, una multa por importe de {{A}} euros."], 1, 0, 1, "Ejemplo, S.A", 1, 0, 0, "OFFENCES_AND_SANCTIONS_DIFFER", 0),
    ("no_operative_line", ["Nada que imponer en esta resolución."], 0, 0, 0, "", 0, 0, 0, "", 0),
]


def xml(boe, body, title="Resolución por la que se publica la sanción"):
    head = F.concat(F.lit("<documento><metadatos><identificador>"), boe, F.lit(f"</identificador><titulo>{title}</titulo><fecha_publicacion>20080110</fecha_publicacion><fecha_disposicion>20080102</fecha_disposicion></metadatos><texto>"))
    return F.encode(F.concat(head, body, F.lit("</texto></documento>")), "UTF-8")


def templates(spark, d) -> DataFrame:
    """A publication for each order, by the rule of its key."""
    body = pick(key() % len(RULES), ["".join(f'<p class="parrafo">{x}</p>' for x in r[1]) for r in RULES])
    boe = F.concat(F.lit("BOE-A-2008-"), key_text())
    return orders(spark, d).select(F.lit("star").alias("corpus"), boe.alias("boe_id"), F.concat(F.lit("/star/"), boe, F.lit(".xml")).alias("path"), xml(boe, F.replace(body, F.lit("{A}"), euros())).alias("content"))


def grammar_rules(spark, d) -> DataFrame:
    p = parse_publications(templates(spark, d)).select("publication.*")
    lines = F.flatten(F.transform("blocks", lambda b: b["sanctions"]))
    linked = F.size(F.filter("blocks", lambda b: b["declared_for"].isNotNull())) + F.size(F.filter(lines, lambda s: s["declared_subject"].isNotNull()))
    return p.select(
        "boe_id", F.size("blocks").alias("n_blocks"), F.size(F.filter("blocks", lambda b: b["declared"])).alias("n_declared"), F.size(lines).alias("n_sanctions"), F.array_join(F.transform(lines, lambda s: s["subject"]), "|").alias("subjects"),
        F.aggregate(lines, F.lit(0).cast("decimal(38,2)"), lambda t, s: (t + F.coalesce(s["amount"], F.lit(0))).cast("decimal(38,2)")).alias("total"), linked.alias("n_linked"), F.array_join(F.transform("issues", lambda i: i["kind"]), "|").alias("issues"), F.size("underlying").alias("n_underlying"),
    )


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def choose(values: list[str]) -> str:
    """SQL twin of pick over o_orderkey."""
    return f"CASE o_orderkey % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


_RULE_ROWS = ", ".join(f"({i}, {b}, {dd}, {n}, {_sql_text(s)}, {t}, {e}, {ln}, {_sql_text(iss)}, {u})" for i, (_, _, b, dd, n, s, t, e, ln, iss, u) in enumerate(RULES))
GRAMMAR_SQL = f"""SELECT 'BOE-A-2008-' || o_orderkey AS boe_id, n_blocks, n_declared, n_sanctions, subjects, CAST(floor(o_totalprice) * times + besides AS DECIMAL(38,2)) AS total, n_linked, issues, n_underlying
  FROM orders JOIN (VALUES {_RULE_ROWS}) r(k, n_blocks, n_declared, n_sanctions, subjects, times, besides, n_linked, issues, n_underlying) ON o_orderkey % {len(RULES)} = k"""


# ---- assembly ---------------------------------------------------------------------------------------------------------


def corpora(spark, d) -> DataFrame:
    """Two corpora of publications; every fifth stands in both."""
    o = orders(spark, d)
    act = F.format_string(
        "Imponer a Sociedad %d, S.A., por la comisión de una infracción %s tipificada en el artículo 99, letra o), de la Ley 24/1988, de 28 de julio, %spor no comunicar el día 3 de marzo de 2007 sus operaciones, una multa por importe de %s euros.",
        cust(), F.when(key() % 3 == 0, "muy grave").otherwise("grave"), F.when(key() % 2 == 0, "en relación con los artículos 45 y 48 de la misma Ley, ").otherwise(""), euros(),
    )
    boe = F.concat(F.lit("BOE-A-2008-"), key_text())
    body = F.concat(F.lit('<p class="parrafo">Resolución de fecha 12 de diciembre de 2007, firme en vía administrativa:</p><p class="parrafo_2">'), act, F.lit("</p>"))
    one = lambda corpus: o.select(F.lit(corpus).alias("corpus"), F.concat(F.lit(f"/{corpus}/"), boe, F.lit(".xml")).alias("path"), boe.alias("boe_id"), xml(boe, body).alias("content"), key().alias("key"))
    return one("star").unionByName(one("again").filter("key % 5 = 0")).drop("key")


def observations(spark, d) -> DataFrame:
    """What later looks found for every third publication."""
    note = F.struct(F.lit("APPEAL_NOTICE").alias("kind"), F.lit(2).alias("page"), F.concat(F.lit("interpuesto recurso "), key_text()).alias("verbatim"))
    kind = "array<struct<kind: string, page: int, verbatim: string>>"
    return orders(spark, d).filter("o_orderkey % 3 = 0").select(
        F.concat(F.lit("BOE-A-2008-"), key_text()).alias("boe_id"), F.concat(F.lit("sha"), key_text()).alias("sha256"), F.when(key() % 6 == 0, F.array(note)).otherwise(F.array()).cast(kind).alias("notes"), F.lit(None).cast("string").alias("status"),
        F.when(key() % 9 == 0, "FETCH_FAILED").otherwise("OK").alias("retrieval"), F.lit("2009-01-01").alias("first_observed_at"), F.lit("2010-01-01").alias("observed_at"),
    )


def assembled(spark, d) -> dict[str, DataFrame]:
    files = corpora(spark, d)
    return assemble(parsed_corpus(files), files, BUILT, observations=observations(spark, d))


def _changed(files: DataFrame, sql_key: str = "boe_id") -> DataFrame:
    """The files some time later: every 7th publication is gone, every 11th has another fine, others are as they were."""
    n = F.regexp_extract(sql_key, r"(\d+)$", 1).cast("bigint")
    other = F.encode(F.regexp_replace(F.decode("content", "UTF-8"), r"importe de [0-9.]+ euros", "importe de 77 euros"), "UTF-8")
    return files.filter(n % 7 != 0).withColumn("content", F.when(n % 11 == 0, other).otherwise(F.col("content")))


def rebuilt(spark, d) -> DataFrame:
    """A ledger brought up to date in two steps, beside one built at once from the same files: (table, rows, rows that only
    one of them has), and how many publications were parsed in the second step."""
    folder, files, looks = state_dir(spark), corpora(spark, d), observations(spark, d)
    new = F.regexp_extract("boe_id", r"(\d+)$", 1).cast("bigint") % 13 == 0
    maintenance.build(spark, files.filter(~new), f"{folder}/1", BUILT, observations=looks)
    later = _changed(files)
    stats = maintenance.build(spark, later, f"{folder}/2", BUILT, previous=f"{folder}/1", observations=looks.filter("boe_id not like '%5'"))
    maintenance.build(spark, later, f"{folder}/3", BUILT, observations=looks.filter("boe_id not like '%5'"))
    out = spark.createDataFrame([("parsed", stats["n_parsed"], 0)], "table_name string, n_rows bigint, n_differing bigint")
    two, three = (readers.ledger_tables(spark, f"{folder}/{i}") for i in (2, 3))
    for name in TABLES:
        both = two[name].withColumn("n", F.lit(1)).unionByName(three[name].withColumn("n", F.lit(-1)))
        row = F.unhex(F.sha2(F.to_json(F.struct(*two[name].columns)), 256))  # rows meet by their hash, not whole
        one = both.groupBy(row.alias("j")).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("here"))
        out = out.union(one.agg(F.lit(name).alias("table_name"), F.coalesce(F.sum("here"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.abs("n")), F.lit(0)).alias("n_differing")).select("table_name", "n_rows", "n_differing"))
    return out.filter("table_name IN ('parsed', 'cases', 'infringements', 'sanctions', 'respondents', 'documents', 'evidence', 'events', 'case_respondents', 'parse_issues')")


CASE = "'CNMV-BOE-A-2008-' || o_orderkey"
RESP = "'RESP-' || substr(sha256('sociedad ' || o_custkey || ', s.a|LEGAL_PERSON'), 1, 16)"
APPEAL = "CASE WHEN o_orderkey % 3 <> 0 OR o_orderkey % 9 = 0 THEN 'INCONCLUSIVE' WHEN o_orderkey % 6 = 0 THEN 'OBSERVED' ELSE 'NOT_OBSERVED_WITHIN_VERIFIED_COVERAGE' END"
BASIS = """'{"boe_id":"BOE-A-2008-' || o_orderkey || '","observed_at":"2010-01-01","sha256":"sha' || o_orderkey || '","source":"CNMV_PDF"}'"""
SEVERITY = "CASE WHEN o_orderkey % 3 = 0 THEN 'VERY_SERIOUS' ELSE 'SERIOUS' END"
EVENT = f"{CASE} || '/EV-{{0}}-' || substr(sha256({CASE} || '|{{0}}|{{1}}'), 1, 12)"
PDF = f"""{CASE} || '/PDF-' || substr(sha256('APPEAL_NOTICE|2|interpuesto recurso ' || o_orderkey), 1, 12)"""
ASSEMBLED = {
    "cases": (["case_id", "canonical_boe_id", "sanctioning_resolution_date", "publication_resolution_date", "boe_publication_date", "administrative_finality_observed", "judicial_review_mentioned", "n_infringements", "n_sanctions", "n_respondents", "appeal_observation_status", "coverage_basis_id"], f"""SELECT {CASE} AS case_id, 'BOE-A-2008-' || o_orderkey AS canonical_boe_id, DATE '2007-12-12' AS sanctioning_resolution_date, DATE '2008-01-02' AS publication_resolution_date, DATE '2008-01-10' AS boe_publication_date, true AS administrative_finality_observed, false AS judicial_review_mentioned,
      CAST(1 AS INTEGER) AS n_infringements, CAST(1 AS INTEGER) AS n_sanctions, CAST(1 AS INTEGER) AS n_respondents, {APPEAL} AS appeal_observation_status, CASE WHEN {APPEAL} <> 'INCONCLUSIVE' THEN 'cb-' || substr(sha256({BASIS}), 1, 16) END AS coverage_basis_id FROM orders"""),
    "infringements": (["infringement_id", "case_id", "ordinal", "severity", "article_raw", "statute_normalized", "article_normalized", "conduct_raw", "conduct_start_date", "conduct_end_date", "conduct_code", "rule_resolution_status", "n_related_provisions"], f"""SELECT {CASE} || '/I1' AS infringement_id, {CASE} AS case_id, CAST(1 AS INTEGER) AS ordinal, {SEVERITY} AS severity, '99, letra o)' AS article_raw, 'Ley 24/1988' AS statute_normalized, '99.o' AS article_normalized, 'por no comunicar el día 3 de marzo de 2007 sus operaciones' AS conduct_raw,
      DATE '2007-03-03' AS conduct_start_date, DATE '2007-03-03' AS conduct_end_date, 'UNKNOWN' AS conduct_code, 'NO_RULE_DEFINED' AS rule_resolution_status, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 0 END AS INTEGER) AS n_related_provisions FROM orders"""),
    "related_provisions": (["infringement_id", "article_normalized", "statute_normalized", "relation"], f"SELECT {CASE} || '/I1' AS infringement_id, unnest(['45', '48']) AS article_normalized, 'Ley 24/1988' AS statute_normalized, 'RELATED' AS relation FROM orders WHERE o_orderkey % 2 = 0"),
    "sanctions": (["sanction_id", "case_id", "respondent_id", "infringement_id", "ordinal", "sanction_type", "severity", "amount", "currency", "duration_raw"], f"""SELECT {CASE} || '/S1' AS sanction_id, {CASE} AS case_id, {RESP} AS respondent_id, {CASE} || '/I1' AS infringement_id, CAST(1 AS INTEGER) AS ordinal, 'MONETARY_FINE' AS sanction_type, {SEVERITY} AS severity, CAST(floor(o_totalprice) AS DECIMAL(18,2)) AS amount, 'EUR' AS currency, CAST(NULL AS VARCHAR) AS duration_raw FROM orders"""),
    "respondents": (["respondent_id", "raw_display_name", "normalized_name", "respondent_type", "source_anonymized", "publication_policy"], f"SELECT DISTINCT {RESP} AS respondent_id, 'Sociedad ' || o_custkey || ', S.A' AS raw_display_name, 'Sociedad ' || o_custkey || ', S.A' AS normalized_name, 'LEGAL_PERSON' AS respondent_type, false AS source_anonymized, 'PUBLIC' AS publication_policy FROM orders"),
    "case_respondents": (["case_id", "respondent_id", "role"], f"SELECT {CASE} AS case_id, {RESP} AS respondent_id, CAST(NULL AS VARCHAR) AS role FROM orders"),
    "events": (["event_id", "case_id", "event_type", "event_date", "event_payload"], f"""SELECT {EVENT.format('RESOLUTION', 0)} AS event_id, {CASE} AS case_id, 'RESOLUTION' AS event_type, DATE '2007-12-12' AS event_date, CAST(NULL AS VARCHAR) AS event_payload FROM orders
      UNION ALL SELECT {EVENT.format('ADMINISTRATIVE_FINALITY', 1)}, {CASE}, 'ADMINISTRATIVE_FINALITY', NULL, NULL FROM orders UNION ALL SELECT {EVENT.format('BOE_PUBLICATION', 2)}, {CASE}, 'BOE_PUBLICATION', DATE '2008-01-10', NULL FROM orders
      UNION ALL SELECT {PDF}, {CASE}, 'ADMINISTRATIVE_APPEAL', NULL, '{{"kind":"APPEAL_NOTICE","page":2,"verbatim":"interpuesto recurso ' || o_orderkey || '"}}' FROM orders WHERE o_orderkey % 6 = 0"""),
    "documents": (["document_id", "boe_id", "source", "corpus", "format", "title", "publication_date", "document_date"], "SELECT 'BOE-A-2008-' || o_orderkey AS document_id, 'BOE-A-2008-' || o_orderkey AS boe_id, 'AEBOE' AS source, CASE WHEN o_orderkey % 5 = 0 THEN 'again' ELSE 'star' END AS corpus, 'XML' AS format, 'Resolución por la que se publica la sanción' AS title, DATE '2008-01-10' AS publication_date, DATE '2008-01-02' AS document_date FROM orders"),
    "case_status": (["case_id", "firmness_status", "n_cnmv_notes", "pdf_sha256"], f"SELECT {CASE} AS case_id, CASE WHEN o_orderkey % 6 = 0 THEN 'APPEAL_OBSERVED' ELSE 'UNKNOWN' END AS firmness_status, CAST(CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_cnmv_notes, 'sha' || o_orderkey AS pdf_sha256 FROM orders WHERE o_orderkey % 3 = 0"),
    "status_notes": (["case_id", "kind", "page", "verbatim"], f"SELECT {CASE} AS case_id, 'APPEAL_NOTICE' AS kind, CAST(2 AS INTEGER) AS page, 'interpuesto recurso ' || o_orderkey AS verbatim FROM orders WHERE o_orderkey % 6 = 0"),
    "parse_issues": (["boe_id", "kind", "detail"], "SELECT 'BOE-A-2008-' || o_orderkey AS boe_id, 'DUPLICATE_DOCUMENT' AS kind, '/star/BOE-A-2008-' || o_orderkey || '.xml' AS detail FROM orders WHERE o_orderkey % 5 = 0"),
    "evidence": (["fact_type", "entity_id", "field_name", "document_id", "locator", "extraction_method", "proof_level", "raw_value"], f"""SELECT fact_type, CASE fact_type WHEN 'respondent' THEN {RESP} WHEN 'sanction' THEN {CASE} || '/S1' ELSE {CASE} || '/I1' END AS entity_id, field_name, 'BOE-A-2008-' || o_orderkey AS document_id, CASE WHEN fact_type <> 'respondent' THEN 'texto/p[1]' END AS locator, extraction_method, proof_level,
      CASE field_name WHEN 'severity' THEN {SEVERITY} WHEN 'article' THEN '99, letra o)' WHEN 'conduct' THEN 'por no comunicar el día 3 de marzo de 2007 sus operaciones' WHEN 'sanction_text' THEN 'una multa por importe de ' || replace(format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)), ',', '.') || ' euros'
      WHEN 'amount' THEN replace(format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)), ',', '.') || ' euros' ELSE 'Sociedad ' || o_custkey || ', S.A' END AS raw_value
      FROM orders, (VALUES ('infringement', 'severity', 'NORMALIZED', 'LOCATION_PROVEN'), ('infringement', 'article', 'DIRECT', 'VALUE_BINDING_PROVEN'), ('infringement', 'conduct', 'DIRECT', 'VALUE_BINDING_PROVEN'), ('sanction', 'subject', 'DIRECT', 'LOCATION_PROVEN'), ('sanction', 'sanction_text', 'DIRECT', 'VALUE_BINDING_PROVEN'), ('sanction', 'amount', 'NORMALIZED', 'VALUE_BINDING_PROVEN'), ('respondent', 'name', 'DIRECT', 'DOCUMENT_BINDING_PROVEN')) f(fact_type, field_name, extraction_method, proof_level)"""),
}


# ---- register, summaries, manifests, notes ---------------------------------------------------------------------------


def register_pages(spark, d) -> DataFrame:
    """The customers as a register of five rows a page, page 3 with a row too few and page 5 lost."""
    c = star.read(spark, d, "customer").select("c_custkey", "c_name")
    at = F.col("c_custkey") - F.col("low")
    low = c.agg(F.min("c_custkey").alias("low"), F.max("c_custkey").alias("high"))
    rows = c.join(F.broadcast(low)).select((at / 5).cast("int").alias("page"), at.alias("at"), F.floor((F.col("high") - F.col("low")) / 5 + 1).alias("pages"), F.format_string('<tr><td><a href="/verdocumento?e=%d">%02d/0%d/2010</a></td><td> Sanción  a %s</td></tr>', "c_custkey", 1 + F.col("c_custkey") % 28, 1 + F.col("c_custkey") % 9, "c_name").alias("row"))
    pages = rows.filter("page <> 5 AND at <> 16").groupBy("page", "pages").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "row"))), lambda x: x["row"]), "").alias("body"))
    return pages.select("page", F.concat(F.lit("<table><tr><th>Fecha</th><th>Texto</th></tr>"), "body", F.format_string("</table>Página %d de %d", F.col("page") + 1, "pages")).alias("html"))


AT = "c_custkey - (SELECT min(c_custkey) FROM customer)"
PAGES = "(SELECT (max(c_custkey) - min(c_custkey)) // 5 + 1 FROM customer)"
LISTED = f"(SELECT CAST(({AT}) // 5 AS INTEGER) AS page_index, * FROM customer WHERE ({AT}) // 5 <> 5 AND {AT} <> 16)"


def summaries(spark, d) -> DataFrame:
    """A daily summary for each order, with its items in both nesting shapes, one of them of another department."""
    item = lambda n: F.concat(F.lit('{"identificador":"A-'), key_text(), F.lit(f'-{n}","titulo":'), F.when(key() % 3 == 0, F.concat(F.lit('{"texto":"T'), cust_text(), F.lit('"}'))).otherwise(F.concat(F.lit('"T'), cust_text(), F.lit('"'))), F.lit(',"url_pdf":{"texto":"/p.pdf","pagina_inicial":7}}'))
    new = F.concat(F.lit('{"data":{"sumario":{"diario":{"seccion":[{"codigo":"3","departamento":{"codigo":"1040","epigrafe":[{"nombre":"E","item":['), item(1), F.lit(","), item(2), F.lit("]}]}},{\"codigo\":\"3\",\"departamento\":{\"codigo\":\"9\",\"item\":"), item(3), F.lit("}}]}}}}"))
    old = F.concat(F.lit('{"data":{"sumario":{"diario":[{"seccion":{"codigo":"3","departamento":[{"codigo":"1040","item":'), item(1), F.lit('},{"codigo":"1040","item":['), item(2), F.lit("]},{\"codigo\":\"9\",\"item\":"), item(3), F.lit("}]}}]}}}"))
    return orders(spark, d).select(key().alias("day"), F.when(key() % 2 == 0, new).otherwise(old).alias("payload"))


NOTES = ["es firme en vía administrativa", "se ha renunciado a la interposición de recursos", "ha interpuesto recurso de alzada {k}", "recurso contencioso-administrativo número {k}", "sentencia de fecha {k} de mayo"]
NOTE_KINDS = ["FIRMNESS", "RENUNCIATION", "APPEAL_NOTICE", "JUDICIAL_APPEAL", "JUDGMENT"]


def noted(spark, d) -> DataFrame:
    """Notes found in a page text for each event."""
    say = F.replace(pick(F.col("event_id") % 5, NOTES), F.lit("{k}"), F.col("event_id").cast("string"))
    pages = star.read(spark, d, "events").select("event_id", F.col("user_id").cast("int").alias("p"), F.concat(F.lit("Nota:  "), say, F.lit(". Fin")).alias("t"))
    return readers.page_notes(pages, "event_id", "p", "t").select("event_id", "page", "kind", "verbatim")


def _made_pdfs(df: DataFrame, key: str) -> DataFrame:
    """(key, content): a document of (key, pages); keys that 50 divides with a rest of 7 get an error page instead."""

    def run(batches):
        for b in batches:
            out = []
            for k, pages in zip(b.column(key).to_pylist(), b.column("pages").to_pylist()):
                plain = all(p.encode("cp1252", "ignore").decode("cp1252") == p for p in pages)
                out.append(b"<html>not found</html>" if k % 50 == 7 else pdf.write_pdf(pages, unicode=not plain or k % 2 == 0, packed=k % 3 == 0))
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(out, pa.binary())], names=[key, "content"])

    return df.select(key, "pages").mapInArrow(run, f"{key} {dict(df.dtypes)[key]}, content binary")


def pdf_texts(spark, d) -> DataFrame:
    """Documents set as PDF, forty lines a page, and read back page by page."""
    lines = F.split("text", "\n")
    pages = F.transform(F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 40).cast("int")), lambda i: F.array_join(F.slice(lines, i * 40 + 1, F.lit(40)), "\n"))
    docs = star.read(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", pages.alias("pages"))
    read = pdf.pdf_pages(_made_pdfs(docs, "doc_id"), ["doc_id"])
    return read.select("doc_id", "page", F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")).alias("text"), F.col("error").isNotNull().alias("failed"))


def pdf_notes(spark, d) -> DataFrame:
    """Status notes of PDF documents, one for each user, a page for each event."""
    say = F.concat(F.lit("Nota:  "), F.replace(pick(F.col("event_id") % 5, NOTES), F.lit("{k}"), F.col("event_id").cast("string")), F.lit(". Fin"))
    each = star.read(spark, d, "events").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_id", say.alias("say")))).alias("e"))
    read = pdf.pdf_pages(_made_pdfs(each.select("user_id", F.col("e.say").alias("pages")), "user_id"), ["user_id"])
    return readers.page_notes(read.filter("error IS NULL"), "user_id", "page", "text").select("user_id", "page", "kind", "verbatim")


TITLES = ["Resolución por la que se publica la sanción", "Corrección de errores de la resolución", "Resolución sobre suspensión cautelar", "Orden de nombramiento", "Resolución de expediente sancionador por infracción grave", "Medidas de intervención", "Anuncio de MULTA"]
TITLE_KINDS = [("ENFORCEMENT", True), ("CORRECTION", False), ("MEASURE", True), ("OTHER", False), ("ENFORCEMENT", True), ("MEASURE", False), ("OTHER", True)]
YAML = "# defects\n- defect_id: D{k}\n  defect_class: \"class {r}\"\n  description: 'nation {k}'\n  fixtures: [BOE-A-{k}, 'BOE-A-{m}']\n"


def registry(spark, d) -> DataFrame:
    """A defect registry of one entry for each nation, written as YAML and read back."""
    n, r = F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")
    entry = F.replace(F.replace(F.replace(F.lit(YAML), F.lit("{k}"), n), F.lit("{r}"), r), F.lit("{m}"), (F.col("n_nationkey") + 1000).cast("string"))
    doc = star.read(spark, d, "nation").agg(F.array_join(F.sort_array(F.collect_list(entry)), "").alias("yaml"))
    m = readers.yaml_records(doc, "yaml").select(*[F.col("record")[c].alias(c) for c in ("defect_id", "defect_class", "description", "fixtures")])
    return m.withColumn("fixtures", readers.yaml_list(F.col("fixtures")))


NESTED_YAML = """# rules of {k}
- rule_id: R{k}
  aliases:
  - name: '{n}'
    valid: {from: 19{y}-01-01, to: ~}   # open
  - [A{k}, "B: {k} # no comment"]
  description: |
    {n}
      indented {k}

    last
- rule_id: S{k}
  amount: {k}
  note: >-
    {n}
    folded
"""


def nested_rules(spark, d) -> DataFrame:
    """Rules of each part written as nested YAML and read back."""
    doc = F.lit(NESTED_YAML)
    for mark, value in (("{k}", F.col("p_partkey").cast("string")), ("{n}", F.replace("p_name", F.lit("'"), F.lit(""))), ("{y}", F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0"))):
        doc = F.replace(doc, F.lit(mark), value)
    rows = yamls.yaml_rows(star.read(spark, d, "part").select("p_partkey", doc.alias("yaml")), "yaml", ["p_partkey"]).filter("error IS NULL")
    r = rows.select("p_partkey", "at", F.parse_json("record").alias("v"))
    get = lambda path, t="string": F.try_variant_get("v", path, t)
    return r.select(
        "p_partkey", "at", get("$.rule_id").alias("rule_id"), get("$.aliases[0].name").alias("name"), get("$.aliases[0].valid.from").alias("valid_from"), get("$.aliases[1][1]").alias("alias"),
        get("$.description").alias("description"), get("$.amount", "bigint").alias("amount"), get("$.note").alias("note"),
    )


def summary_drift(spark, d) -> DataFrame:
    """Drift of daily summaries, of which every third has a level renamed later."""
    s = summaries(spark, d)
    renamed = F.when(F.col("day") % 3 == 0, F.replace("payload", F.lit('"departamento"'), F.lit('"organismo"'))).otherwise(F.col("payload"))
    moved = probe.drift(probe.profile(s, "payload", "json"), probe.profile(s.select(renamed.alias("payload")), "payload", "json")).filter("path LIKE '%.departamento' OR path LIKE '%.organismo'")
    return moved.groupBy(F.regexp_extract("path", "([a-z]+)$", 1).alias("level"), "change").agg(F.round(F.sum("share_now") - F.sum("share_before"), 9).alias("moved"))


def page_drift(spark, d) -> DataFrame:
    """Drift of web pages whose articles became sections and whose menus became longer."""
    p = star.read(spark, d, "pages")
    now = F.replace(F.replace(F.replace("html", F.lit("<article>"), F.lit("<section>")), F.lit("</article>"), F.lit("</section>")), F.lit("<li>"), F.lit("<li>x</li><li>"))
    moved = probe.drift(probe.profile(p, "html", "html"), probe.profile(p.select(now.alias("html")), "html", "html"))
    return moved.filter(F.col("path").rlike("/(article|section)$")).select(F.regexp_extract("path", "([a-z]+)$", 1).alias("element"), "change", F.round("share_before", 9).alias("share_before"), F.round("share_now", 9).alias("share_now"))


def nation_documents(spark, d) -> DataFrame:
    """A document for each nation but every sixth."""
    return star.read(spark, d, "nation").filter("n_nationkey % 6 <> 5").select(F.concat(F.lit("BOE-A-"), F.col("n_nationkey").cast("string")).alias("document_id"), F.md5("n_name").alias("sha256"))


# ---- scalars ----------------------------------------------------------------------------------------------------------

FLOOR = "CAST(floor(o_totalprice) AS DECIMAL(18,2))"
KINDS = [("multa por importe de 3 euros", "MONETARY_FINE"), ("una sanción de suspensión", "SUSPENSION"), ("la amonestación pública", "PUBLIC_REPRIMAND"), ("Comiso del beneficio", "DISGORGEMENT"), ("dos sanciones consistente en inhabilitación", "DISQUALIFICATION"), ("separación del cargo", "DISQUALIFICATION"), ("otra cosa", "UNKNOWN")]


def amounts(spark, d) -> DataFrame:
    e = euros()
    say = lambda a, b="": F.concat(F.lit(a), e, F.lit(b))
    t = pick(key() % 7, [say("una multa de ", " euros."), say("multa (", " €)"), say("por importe de ", ",05 (letras)"), "multa de quinientos cincuenta mil euros", say("trescientos mil (", ") euros y 7 euros"), "sin importe", say("", " (letra) de euros")])
    return orders(spark, d).select(key().alias("o_orderkey"), numbers.amount(t).alias("amount"), numbers.euro_amount(t).alias("plain"))


def legal_texts(spark, d) -> DataFrame:
    n = (1 + key() % 40).cast("string")
    t = pick(key() % 4, [F.concat(F.lit("la Ley "), n, F.lit("/2001 y la Circular 3/1997, de la LMV")), F.concat(F.lit("Reglamento (UE) nº "), n, F.lit("/2014 y Real Decreto-ley 5/2009")), "la Ley Concursal", "nada"])
    a = F.concat(pick(key() % 3, ["artículo ", "art. ", ""]), (1 + key() % 300).cast("string"), F.lit(", letra o) de la Ley"))
    return orders(spark, d).select(key().alias("o_orderkey"), F.array_join(legal.statute_mentions(t), "|").alias("mentions"), legal.extract_article(a).alias("article"), legal.sanction_type(pick(key() % 7, [k for k, _ in KINDS])).alias("kind"), numbers.count_of(pick(key() % 5, ["3", " Dos ", "diez", "muchas", "Una"])).alias("n"),
        legal.assess(key() % 2 == 0, key() % 3 != 0, key() % 5 == 0).alias("assessed"))


def id_forms(spark, d) -> DataFrame:
    boe = F.concat(F.lit("véase BOE-A-2008-"), key_text(), F.lit(" y otros"))
    return orders(spark, d).select(
        key().alias("o_orderkey"), ids.extract_boe_id(F.when(key() % 4 != 0, boe).otherwise("nada")).alias("boe_id"), ids.source_id(F.lit("CNMV"), F.lit("PDF"), F.sha2(key_text(), 256)).alias("source_id"),
        ids.event_id(F.concat(F.lit("C"), key_text()), F.lit("X"), cust_text()).alias("event_id"), ids.pdf_event_id(F.concat(F.lit("C"), key_text()), F.lit("NOTE"), F.lit(3), F.concat(key_text(), F.repeat(F.lit("y"), 200))).alias("pdf_id"),
        text.collapse_ws(F.concat(F.lit(" A&ntilde;o&nbsp;&amp;amp; "), key_text(), F.lit("&#8364;   &euro;&lt;b&gt; &nada; "))).alias("plain"),
        dates.any_es(pick(key() % 4, [F.date_format("o_orderdate", "dd/MM/yyyy"), F.date_format("o_orderdate", "yyyyMMdd"), "el 31 de febrero de 2020", F.concat(F.lit("a 3 de mayo de "), F.date_format("o_orderdate", "yyyy"))])).alias("day"),
    )


# ---- gates ------------------------------------------------------------------------------------------------------------


def planted(spark, d) -> DataFrame:
    """Every gate's outcome over tables of one case for each order, with violations at keys divisible by a prime each."""
    o = orders(spark, d)
    off = lambda n: key() % n == 0
    unless = lambda n, v: F.when(~off(n), v)
    name = lambda p: F.concat(F.lit(p), key_text())
    day = lambda v: F.lit(v).cast("date")
    fine = F.when(key() % 2 == 0, "MONETARY_FINE").otherwise("SUSPENSION")
    later = lambda n: F.when(off(n), F.lit("2030-01-01").cast("timestamp")).otherwise(F.lit("2010-01-01").cast("timestamp"))
    t = {
        "documents": o.select(name("B").alias("document_id")),
        "cases": o.filter(~off(7)).select(name("C").alias("case_id"), name("B").alias("canonical_boe_id"), F.when(off(101), day("2009-01-01")).otherwise(day("2008-01-01")).alias("sanctioning_resolution_date"), day("2008-06-01").alias("boe_publication_date"), F.when(off(4), "NOT_OBSERVED_WITHIN_VERIFIED_COVERAGE").otherwise("INCONCLUSIVE").alias("appeal_observation_status"), unless(8, F.lit("cb")).alias("coverage_basis_id")),
        "infringements": o.filter(~off(103)).select(name("I").alias("infringement_id"), name("C").alias("case_id"), F.when(off(107), "UNKNOWN").otherwise("SERIOUS").alias("severity"), unless(109, F.lit("99.o")).alias("article_normalized"), unless(113, F.lit("L")).alias("statute_normalized"), F.when(off(127), day("2008-07-01")).otherwise(day("2008-05-01")).alias("conduct_end_date")),
        "sanctions": o.filter(~off(131)).select(F.when(off(137), "twice").otherwise(name("S")).alias("sanction_id"), name("C").alias("case_id"), name("I").alias("infringement_id"), F.when(off(149), " ").otherwise(unless(139, name("R"))).alias("respondent_id"), fine.alias("sanction_type"), F.when((key() % 2 == 0) & ~off(150), F.lit(5)).when((key() % 2 == 1) & off(157), F.lit(1)).cast("decimal(20,2)").alias("amount")),
        "respondents": o.select(name("R").alias("respondent_id")),
        "evidence": o.filter(~off(163)).select(F.when(off(137), "twice").otherwise(name("S")).alias("entity_id"), F.when(off(167), "none").otherwise(name("B")).alias("document_id"), F.lit("VALUE_BINDING_PROVEN").alias("proof_level"), unless(173, F.lit("texto/p[1]")).alias("locator"), unless(179, F.lit("sha")).alias("artifact_sha256"), later(181).alias("observed_at")),
        "events": o.select(name("E").alias("event_id"), later(191).alias("observed_at")),
        "parse_issues": o.select(F.when(off(193), "PARSE_FAILED").otherwise("NOTE").alias("kind")),
    }
    block = lambda n: F.array(F.struct(F.array(*[F.struct(F.lit("x").alias("text"))] * n).cast("array<struct<text: string>>").alias("sanctions")))
    publications = o.select(name("B").alias("boe_id"), F.when(key() % 2 == 0, "register").otherwise("history").alias("corpus"), F.when(off(7), "SUBSEQUENT_EVENT").otherwise("SANCTION_PUBLICATION").alias("document_kind"), F.lit(None).cast("string").alias("error"), F.when(off(197), F.array()).when(off(199), block(0)).otherwise(block(1)).alias("blocks"))
    nation = star.read(spark, d, "nation")
    # A corpus whose publications became no cases.
    lost = nation.select(F.concat(F.lit("L"), F.col("n_nationkey").cast("string")).alias("boe_id"), F.lit("lost").alias("corpus"), F.lit("SANCTION_PUBLICATION").alias("document_kind"), F.lit(None).cast("string").alias("error"), block(1).alias("blocks"))
    publications = publications.unionByName(lost)
    enumerated = o.filter(~off(211)).select(name("B").alias("boe_id")).union(lost.select("boe_id"))
    defects = registry(spark, d)
    tests = nation.filter("n_nationkey % 5 <> 4").select(F.format_string("test_D%d_holds", "n_nationkey").alias("name"))
    docs = nation_documents(spark, d)
    reviews = flow.seed_reviews(defects, docs, "2").select("review_id", "subject_type", F.when(F.col("subject_id") == "D3", "D0").otherwise(F.col("subject_id")).alias("subject_id"), "document_id", "raw_sha256", "review_compat_version", "status", F.lit(None).cast("string").alias("notes"))
    # A release that calls every review of a document of nations up to 5 stale, which none is.
    released = reviews.select("review_id", F.when(F.regexp_extract("document_id", r"(\d+)$", 1).cast("int") <= 5, "STALE").otherwise(F.col("status")).alias("status"))
    files = nation.select(F.col("n_name").alias("name"), F.encode("n_name", "UTF-8").alias("content"))
    sums = nation.select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 9 == 0, "0").otherwise(F.sha2(F.encode("n_name", "UTF-8"), 256)).alias("expected"))
    days = summaries(spark, d)
    return gates.release_gates(
        gates.table_violations(t, BUILT), gates.publication_violations(publications, t["cases"]), gates.review_violations(defects, tests, reviews, docs, "2", released), gates.history_violations(publications, enumerated, "register"),
        gates.holdout_violations(publications), gates.fixture_violations(files, sums), gates.summary_violations(days.unionByName(days.select((F.col("day") + 10**9).alias("day"), F.lit("{}").alias("payload")).filter("day % 223 = 0")), readers.sumario_items(days, "payload"), "day"), gates.note_violations(nation.select(F.when(F.col("n_nationkey") > 2, "NOT exhaustive history").otherwise("all").alias("note")), "note"),
    )


_O = "(SELECT o_orderkey AS k FROM orders)"
_S = "k % 131 <> 0"
PLANTED = {
    "documents_parsed": f"{_O} WHERE k % 193 = 0", "case_has_infringement": f"{_O} WHERE k % 7 <> 0 AND k % 103 = 0", "case_has_sanction": f"{_O} WHERE k % 7 <> 0 AND k % 131 = 0",
    "severity_present": f"{_O} WHERE k % 103 <> 0 AND k % 107 = 0", "article_present": f"{_O} WHERE k % 103 <> 0 AND k % 109 = 0", "statute_present": f"{_O} WHERE k % 103 <> 0 AND k % 113 = 0",
    "sanction_has_respondent": f"{_O} WHERE {_S} AND k % 139 = 0 AND k % 149 <> 0", "fine_has_amount": f"{_O} WHERE {_S} AND k % 150 = 0", "non_monetary_has_no_amount": f"{_O} WHERE {_S} AND k % 2 = 1 AND k % 157 = 0",
    "references_resolve": f"(SELECT k FROM {_O} WHERE {_S} AND k % 103 = 0 UNION ALL SELECT k FROM {_O} WHERE {_S} AND k % 149 = 0)", "sanction_id_unique": f"(SELECT 1 FROM {_O} WHERE {_S} AND k % 137 = 0 HAVING count(*) > 1)",
    "sanction_has_evidence": f"{_O} WHERE {_S} AND k % 163 = 0 AND (k % 137 <> 0 OR NOT EXISTS (SELECT 1 FROM {_O} e WHERE e.k % 137 = 0 AND e.k % 163 <> 0))", "resolution_before_publication": f"{_O} WHERE k % 7 <> 0 AND k % 101 = 0", "conduct_before_publication": f"{_O} WHERE k % 7 <> 0 AND k % 103 <> 0 AND k % 127 = 0",
    "evidence_has_document": f"{_O} WHERE k % 163 <> 0 AND k % 167 = 0", "proven_value_has_locator_and_sha": f"{_O} WHERE k % 163 <> 0 AND (k % 173 = 0 OR k % 179 = 0)", "verified_negative_has_basis": f"{_O} WHERE k % 7 <> 0 AND k % 8 = 0",
    "no_future_observation": f"(SELECT k FROM {_O} WHERE k % 163 <> 0 AND k % 181 = 0 UNION ALL SELECT k FROM {_O} WHERE k % 191 = 0)", "sanction_respondent_not_empty": f"{_O} WHERE {_S} AND k % 149 = 0", "evidence_bound_to_artifact": f"{_O} WHERE k % 163 <> 0 AND k % 179 = 0", "fine_amount_is_decimal": f"{_O} WHERE {_S} AND k % 2 = 0",
    "publication_has_block": f"{_O} WHERE k % 7 <> 0 AND k % 197 = 0", "publication_has_sanction": f"{_O} WHERE k % 7 <> 0 AND (k % 197 = 0 OR k % 199 = 0)", "documents_reconcile_with_cases": "(SELECT DISTINCT 'lost' FROM nation)",
    "defects_have_tests": "(SELECT 1 FROM nation WHERE n_nationkey % 5 = 4 UNION ALL SELECT 1 FROM nation WHERE n_nationkey = 3)", "staleness_as_expected": "nation WHERE n_nationkey <= 4", "history_is_enumerated": f"{_O} WHERE k % 2 = 1 AND k % 211 = 0",
    "holdout_has_sanctions": f"{_O} WHERE k % 197 = 0 OR k % 199 = 0", "fixtures_match_sums": "nation WHERE n_nationkey % 9 = 0", "summaries_give_items": f"{_O} WHERE (k + 1000000000) % 223 = 0", "coverage_note_is_honest": "nation WHERE n_nationkey <= 2",
}
PLANTED_SQL = "SELECT gate, n_violations, n_violations = 0 AS ok FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS gate, count(*) AS n_violations FROM {v}" for k, v in PLANTED.items()) + ")"


# ---- sinks read back ---------------------------------------------------------------------------------------------------


def exported(spark, d) -> DataFrame:
    """The nations through every export format and back."""
    n, folder = star.read(spark, d, "nation"), state_dir(spark)
    schema = n.schema.simpleString()[len("struct<") : -1]
    out = None
    for fmt in sinks.FORMATS:
        sinks.export(n, f"{folder}/{fmt}", fmt)
        back = readers.jsonl(spark, f"{folder}/json", schema.replace(":", " ")) if fmt == "json" else spark.read.option("header", True).schema(n.schema).format(fmt).load(f"{folder}/{fmt}")
        one = back.select(F.lit(fmt).alias("fmt"), *n.columns)
        out = one if out is None else out.union(one)
    return out


def ledger_twice(spark, d) -> DataFrame:
    """Two batches that overlap, appended to one ledger: every key once, as it came first."""
    c, folder = star.read(spark, d, "customer").select("c_custkey", F.lit("first").alias("batch")), state_dir(spark)
    c.filter("c_custkey < 0").write.json(f"{folder}/ledger")
    sinks.append_ledger(spark, c.filter("c_custkey % 3 <> 0"), f"{folder}/ledger", "c_custkey")
    sinks.append_ledger(spark, c.withColumn("batch", F.lit("second")), f"{folder}/ledger", "c_custkey")
    return readers.jsonl(spark, f"{folder}/ledger", "c_custkey bigint, batch string")


def stored_twice(spark, d) -> DataFrame:
    """Documents put into the content store twice: bytes once by hash, a manifest row for each retrieval."""
    docs, folder = star.read(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.encode("text", "UTF-8").alias("content")).withColumn("sha256", F.sha2("content", 256)), state_dir(spark)
    for _ in range(2):
        store.store(spark, docs, folder)
    kept, seen = store.objects(spark, folder), readers.jsonl(spark, f"{folder}/manifest", "doc_id bigint, sha256 string")
    return kept.groupBy("sha256").agg(F.count(F.lit(1)).alias("n_stored")).join(seen.groupBy("sha256").agg(F.count(F.lit(1)).alias("n_retrieved")), "sha256")


def _lines(spark, d) -> DataFrame:
    """Line items with exact types."""
    t = star.read(spark, d, "lineitem")
    return t.select(*[F.col(c).cast("decimal(18,4)").alias(c) if k in ("double", "float") else F.col(c) for c, k in t.dtypes])


LINE = ["l_orderkey", "l_linenumber"]


def line_versions(spark, d) -> tuple[DataFrame, DataFrame]:
    """Line items before and after changes: some rows altered, some gone, some new, one row in 89 twice, elsewhere in other
    order."""
    a = _lines(spark, d)
    k = F.col("l_orderkey")
    kept = a.filter(k % 101 != 0).withColumn("l_quantity", F.when((k % 97 == 0) & (F.col("l_linenumber") == 1), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).cast("decimal(18,4)"))
    new = a.filter(k % 103 == 0).withColumn("l_orderkey", (k + 10**9).cast(dict(a.dtypes)["l_orderkey"]))
    return a, kept.unionByName(new).unionByName(kept.filter(k % 89 == 0)).repartition(7, "l_suppkey")


def merkle_changes(spark, d) -> DataFrame:
    before, after = line_versions(spark, d)
    a = merkle.tree(before, LINE, leaf=256)
    return merkle.changes(before, after, a, merkle.tree(after, like=a)).select(*LINE, "n_before", "n_after", "change")


def merkle_roots(spark, d) -> DataFrame:
    """Trees of a table, of the same rows in other order and partitions, and of the table less one row."""
    a = _lines(spark, d)
    one = merkle.tree(a, LINE)
    other, less = merkle.tree(a.orderBy("l_partkey", "l_suppkey").repartition(5), like=one), merkle.tree(a.join(a.agg(F.min("l_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti"), like=one)
    r = [t.root().select(F.lit(i).alias("i"), "digest", "n_rows") for i, t in enumerate((one, other, less))]
    base = one.root().select(F.col("digest").alias("first"))
    return r[0].union(r[1]).union(r[2]).join(F.broadcast(base)).select("i", "n_rows", (F.col("digest") == F.col("first")).alias("same"))


def views(spark, d) -> DataFrame:
    sinks.load_views(spark, {f"own_{n}": star.read(spark, d, n) for n in ("nation", "region", "supplier")}, "2024-01-15")
    return spark.sql("SELECT m.table_name, m.n_rows, (SELECT count(*) FROM own_nation JOIN own_region ON n_regionkey = r_regionkey) AS n_joined FROM meta m")


def covered(spark, d) -> DataFrame:
    """The coverage ledger of the star's cases and documents as (part, key, n)."""
    t = star.tables(spark, d)
    docs = orders(spark, d).select(F.col("o_orderstatus").alias("corpus"), F.concat(F.lit("BOE-A-"), F.date_format("o_orderdate", "yyyy"), F.lit("-"), key_text()).alias("boe_id"))
    c = sinks.coverage(t["cases"].filter("appeal_observation_status <> 'P'"), docs, t["events"].select(F.col("event_type").alias("kind")))
    row = lambda part, key, n: [F.lit(part).alias("part"), key.cast("string").alias("key"), n.cast("bigint").alias("n")]
    out = c["range"].select(*row("from", F.col("first"), F.col("n_cases"))).union(c["range"].select(*row("to", F.col("last"), F.col("n_cases"))))
    out = out.union(c["corpora"].select(*row("cases", F.col("corpus"), F.col("n_cases")))).union(c["corpora"].select(*row("non_case", F.col("corpus"), F.col("n_non_case"))))
    return out.union(c["issues"].select(*row("issue", F.col("kind"), F.col("n"))))


def linked(spark, d) -> DataFrame:
    """Line items as sanctions on successors of the customer of an order, orders' own keys as declared infringements."""
    name = F.concat(F.lit("Caja "), (F.col("o_orderkey") % 3).cast("string"))
    declared = orders(spark, d).select((key() % 50).alias("doc"), name.alias("name"), key().alias("ordinal"), key_text().alias("infringement_id"))
    lines = star.read(spark, d, "supplier").select((F.col("s_suppkey") % 60).alias("doc"), F.col("s_suppkey").alias("sanction_id"), F.concat(F.lit(" CAJA "), (F.col("s_suppkey") % 4).cast("string"), F.lit(" ")).alias("declared_subject"))
    return flow.successor_link(lines, declared).select("sanction_id", "declared_infringement")


def profile(spark, d) -> DataFrame:
    t = star.tables(spark, d)
    return flow.document_profile(t["infringements"], t["sanctions"], t["respondents"])


def releases(spark, d) -> DataFrame:
    files = star.read(spark, d, "customer").select(F.concat(F.lit("/x/"), F.when(F.col("c_custkey") % 3 == 0, "draft-").otherwise("v0."), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, "/coverage.json").otherwise("/dataset_manifest.json")).alias("path"))
    return flow.latest_release(files, "path", "coverage.json")


def bars(spark, d) -> DataFrame:
    return flow.bar_scale(ledger.laws(star.tables(spark, d)), "n_infringements").select("statute_normalized", F.round("share", 9).alias("share"))


def add(query) -> None:
    """Registers all queries of this module."""
    put = lambda name, sql, f: query(name, sql)(f)
    put("grammar_rules", GRAMMAR_SQL, grammar_rules)
    for table, (columns, sql) in ASSEMBLED.items():
        put(f"assembled_{table}", sql, lambda spark, d, t=table, c=columns: assembled(spark, d)[t].select(*c))
    put("incremental_build", """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders WHERE o_orderkey % 7 <> 0)
      SELECT t AS table_name, n AS n_rows, CAST(0 AS BIGINT) AS n_differing FROM (
        SELECT 'parsed' AS t, count(*) FILTER (k % 13 = 0 OR k % 11 = 0) AS n FROM o UNION ALL SELECT unnest(['cases', 'infringements', 'sanctions', 'documents', 'case_respondents']), (SELECT count(*) FROM o)
        UNION ALL SELECT 'respondents', count(DISTINCT c) FROM o UNION ALL SELECT 'evidence', 7 * count(*) FROM o
        UNION ALL SELECT 'events', 3 * count(*) + (SELECT count(*) FROM orders WHERE o_orderkey % 6 = 0) FROM o UNION ALL SELECT 'parse_issues', count(*) FILTER (k % 5 = 0) FROM o)""", rebuilt)
    put("register_rows_scan", f"SELECT page_index, CAST({PAGES} AS INTEGER) AS declared_pages, make_date(2010, CAST(1 + c_custkey % 9 AS BIGINT), CAST(1 + c_custkey % 28 AS BIGINT)) AS register_entry_date, 'Sanción a ' || c_name AS title, '/verdocumento?e=' || c_custkey AS document_url FROM {LISTED}", lambda spark, d: readers.register_rows(register_pages(spark, d), "html", "page"))
    put("register_integrity", f"SELECT CAST(3 AS INTEGER) AS page_index, count(*) AS n, 'SHORT' AS problem FROM {LISTED} WHERE page_index = 3 UNION ALL SELECT CAST(5 AS INTEGER), 0, 'MISSING'", lambda spark, d: readers.register_integrity(readers.register_rows(register_pages(spark, d), "html", "page")))
    put("register_total", f"SELECT count(*) AS n_rows, CAST(({PAGES} - 1) * 5 + count(*) FILTER (page_index = {PAGES} - 1) AS BIGINT) AS derived_total FROM {LISTED}", lambda spark, d: readers.register_total(readers.register_rows(register_pages(spark, d), "html", "page")))
    put("summary_items_of_department", "SELECT o_orderkey AS day, 'A-' || o_orderkey || '-' || n AS identificador, 'T' || o_custkey AS titulo, CASE WHEN o_orderkey % 2 = 0 THEN 'E' END AS epigrafe_nombre, CAST(7 AS INTEGER) AS pagina_inicial FROM orders, (VALUES (1), (2)) t(n)",
        lambda spark, d: readers.of_department(readers.sumario_items(summaries(spark, d), "payload")).select("day", "identificador", "titulo", "epigrafe_nombre", "pagina_inicial"))
    put("observation_snapshot", "SELECT n_name AS boe_id, md5(n_name) AS sha256, 'OK' AS retrieval, 'NOTE' AS kind, CAST(n_nationkey AS INTEGER) AS page FROM nation",
        lambda spark, d: readers.observation_snapshot(star.read(spark, d, "nation").groupBy("n_regionkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", F.struct(F.md5("n_name").alias("sha256"), F.array(F.struct(F.lit("NOTE").alias("kind"), F.col("n_nationkey").cast("int").alias("page"), F.lit("v").alias("verbatim"))).alias("notes"), F.lit("OK").alias("retrieval")))))).alias("j")), "j").select("boe_id", "sha256", "retrieval", F.col("notes")[0]["kind"].alias("kind"), F.col("notes")[0]["page"].alias("page")))
    put("sidecar_index", "SELECT n_name AS boe_id, 'T' || n_nationkey AS title, DATE '2010-05-03' AS register_entry_date, 'EXACT' AS method FROM nation",
        lambda spark, d: readers.sidecar_index(star.read(spark, d, "nation").agg(F.to_json(F.collect_list(F.struct(F.col("n_name").alias("boe_id"), F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("title"), F.lit("2010-05-03").alias("register_entry_date"), F.lit("EXACT").alias("method"), F.lit(1.0).alias("score")))).alias("j")), "j").select("boe_id", "title", "register_entry_date", "method"))
    put("page_notes", f"SELECT event_id, CAST(user_id AS INTEGER) AS page, CASE event_id % 5 {' '.join(f'WHEN {i} THEN {_sql_text(x)}' for i, x in enumerate(NOTE_KINDS))} END AS kind, CASE event_id % 5 WHEN 0 THEN 'es firme en vía administrativa' WHEN 1 THEN 'renunciado a la interposición de recursos' ELSE replace(CASE event_id % 5 {' '.join(f'WHEN {i} THEN {_sql_text(x)}' for i, x in enumerate(NOTES))} END, '{{k}}', CAST(event_id AS VARCHAR)) END AS verbatim FROM events",
        noted)
    put("pdf_page_texts", r"""SELECT doc_id, CASE WHEN doc_id % 50 <> 7 THEN (i + 1)::INTEGER END AS page, CASE WHEN doc_id % 50 <> 7 THEN trim(regexp_replace(array_to_string(ls[i * 40 + 1 : i * 40 + 40], chr(10)), '[\x20\x09-\x0D]+', ' ', 'g')) END AS text, doc_id % 50 = 7 AS failed
      FROM (SELECT doc_id, ls, unnest(range(0, CASE WHEN doc_id % 50 = 7 THEN 1 ELSE (len(ls) + 39) // 40 END)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))""", pdf_texts)
    put("pdf_status_notes", f"""SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id))::INTEGER AS page, CASE event_id % 5 {' '.join(f'WHEN {i} THEN {_sql_text(x)}' for i, x in enumerate(NOTE_KINDS))} END AS kind,
      replace(CASE event_id % 5 WHEN 0 THEN 'es firme en vía administrativa' WHEN 1 THEN 'renunciado a la interposición de recursos' {' '.join(f'WHEN {i} THEN {_sql_text(NOTES[i])}' for i in (2, 3, 4))} END, '{{k}}', event_id::VARCHAR) AS verbatim FROM events WHERE user_id % 50 <> 7""", pdf_notes)
    put("title_classes", f"SELECT o_orderkey, {choose([_sql_text(a) for a, _ in TITLE_KINDS])} AS class, {choose([str(b).lower() for _, b in TITLE_KINDS])} AS sanction_like FROM orders", lambda spark, d: orders(spark, d).select("o_orderkey", readers.classify_item(pick(key() % 7, TITLES)).alias("class"), readers.sanction_like(pick(key() % 7, TITLES)).alias("sanction_like")))
    put("charset_fallback", "SELECT c_custkey, 'Ñandú ' || c_name AS text FROM customer", lambda spark, d: star.read(spark, d, "customer").select("c_custkey", readers.text_of(F.when(F.col("c_custkey") % 2 == 0, F.encode(F.concat(F.lit("Ñandú "), "c_name"), "UTF-8")).otherwise(F.encode(F.concat(F.lit("Ñandú "), "c_name"), "ISO-8859-1"))).alias("text")))
    put("yaml_records", "SELECT 'D' || n_nationkey AS defect_id, 'class ' || n_regionkey AS defect_class, 'nation ' || n_nationkey AS description, 'BOE-A-' || n_nationkey || '|BOE-A-' || (n_nationkey + 1000) AS fixtures FROM nation", lambda spark, d: registry(spark, d).withColumn("fixtures", F.array_join("fixtures", "|")))
    put("yaml_nested_rules", """SELECT p_partkey, i::INTEGER AS at, CASE i WHEN 0 THEN 'R' ELSE 'S' END || p_partkey AS rule_id, CASE i WHEN 0 THEN n END AS name, CASE i WHEN 0 THEN '19' || lpad((p_partkey % 100)::VARCHAR, 2, '0') || '-01-01' END AS valid_from,
      CASE i WHEN 0 THEN 'B: ' || p_partkey || ' # no comment' END AS alias, CASE i WHEN 0 THEN n || chr(10) || '  indented ' || p_partkey || chr(10) || chr(10) || 'last' || chr(10) END AS description, CASE i WHEN 1 THEN p_partkey END AS amount, CASE i WHEN 1 THEN n || ' folded' END AS note
      FROM (SELECT p_partkey, replace(p_name, chr(39), '') AS n FROM part), (VALUES (0), (1)) t(i)""", nested_rules)
    put("summary_structure_drift", """WITH s AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 3 = 0) AS a FROM orders)
      SELECT 'departamento' AS level, 'LESS' AS change, round(-a / n, 9) AS moved FROM s UNION ALL SELECT 'organismo', 'NEW', round(a / n, 9) FROM s""", summary_drift)
    put("page_structure_drift", "SELECT unnest(['article', 'section']) AS element, unnest(['LOST', 'NEW']) AS change, unnest([round(s, 9), 0.0]) AS share_before, unnest([0.0, round(s, 9)]) AS share_now FROM (SELECT count(*) FILTER (html LIKE '%<article>%') / count(*) AS s FROM pages) WHERE s > 0.05", page_drift)
    put("seed_reviews", "SELECT 'RV-' || substr(sha256('defect|D' || n_nationkey || '|BOE-A-' || n_nationkey || '|' || md5(n_name) || '|2'), 1, 16) AS review_id, 'D' || n_nationkey AS subject_id, 'BOE-A-' || n_nationkey AS document_id, 'class ' || n_regionkey AS reason_code, 'CORRECTED' AS status FROM nation WHERE n_nationkey % 6 <> 5", lambda spark, d: flow.seed_reviews(registry(spark, d), nation_documents(spark, d), "2").select("review_id", "subject_id", "document_id", "reason_code", "status"))
    put("amounts_in_texts", f"SELECT o_orderkey, {choose([FLOOR, FLOOR, FLOOR + ' + 0.05', '550000', FLOOR, 'NULL', FLOOR])}::DECIMAL(18,2) AS amount, {choose([FLOOR, FLOOR, 'NULL', 'NULL', '7', 'NULL', 'NULL'])}::DECIMAL(18,2) AS plain FROM orders", amounts)
    put("legal_texts", f"""SELECT o_orderkey, {choose(["'Ley ' || (1 + o_orderkey % 40) || '/2001|Ley del Mercado de Valores|Circular 3/1997'", "'Reglamento (UE) ' || (1 + o_orderkey % 40) || '/2014|Real Decreto-ley 5/2009'", "'Ley Concursal'", "''"])} AS mentions, CASE WHEN o_orderkey % 3 <> 1 THEN (1 + o_orderkey % 300) || '.o' END AS article,
      {choose([_sql_text(v) for _, v in KINDS])} AS kind, CAST({choose(['3', '2', '10', '1', '1'])} AS INTEGER) AS n, CASE WHEN o_orderkey % 2 = 0 THEN 'OBSERVED' WHEN o_orderkey % 3 = 0 THEN 'UNAVAILABLE' WHEN o_orderkey % 5 = 0 THEN 'NOT_OBSERVED_WITHIN_VERIFIED_COVERAGE' ELSE 'INCONCLUSIVE' END AS assessed FROM orders""", legal_texts)  # fmt: skip
    put("id_forms", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN 'BOE-A-2008-' || o_orderkey END AS boe_id, 'CNMV:PDF:' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 16) AS source_id, 'C' || o_orderkey || '/EV-X-' || substr(sha256('C' || o_orderkey || '|X|' || o_custkey), 1, 12) AS event_id,
      'C' || o_orderkey || '/PDF-' || substr(sha256('NOTE|3|' || substr(o_orderkey || repeat('y', 200), 1, 120)), 1, 12) AS pdf_id, 'Año &amp; ' || o_orderkey || '€ €<b> &nada;' AS plain, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderdate AS DATE) WHEN o_orderkey % 4 = 3 THEN make_date(year(o_orderdate), 5, 3) END AS day FROM orders""", id_forms)  # fmt: skip
    put("release_gates", PLANTED_SQL, planted)
    put("exports_read_back", "SELECT fmt, n.* FROM nation n, (VALUES ('json'), ('csv'), ('parquet')) t(fmt)", exported)
    put("append_ledger", "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN 'first' ELSE 'second' END AS batch FROM customer", ledger_twice)
    put("content_store", "SELECT sha256(text) AS sha256, CAST(1 AS BIGINT) AS n_stored, 2 * count(*) AS n_retrieved FROM documents WHERE text IS NOT NULL GROUP BY 1", stored_twice)
    put("merkle_changes", """WITH k AS (SELECT l_orderkey, l_linenumber, l_orderkey % 101 = 0 AS gone, l_orderkey % 97 = 0 AND l_linenumber = 1 AS altered, l_orderkey % 89 = 0 AS twice FROM lineitem)
      SELECT l_orderkey, l_linenumber, sum(CASE WHEN gone OR altered THEN 1 ELSE 0 END)::BIGINT AS n_before, sum(CASE WHEN gone THEN 0 WHEN altered THEN 1 + twice::INTEGER WHEN twice THEN 1 ELSE 0 END)::BIGINT AS n_after,
             CASE WHEN any_value(gone) THEN 'REMOVED' WHEN any_value(altered) THEN 'CHANGED' ELSE 'ADDED' END AS change FROM k WHERE gone OR altered OR twice GROUP BY l_orderkey, l_linenumber
      UNION ALL SELECT l_orderkey + 1000000000, l_linenumber, 0, count(*), 'ADDED' FROM lineitem WHERE l_orderkey % 103 = 0 GROUP BY l_orderkey, l_linenumber""", merkle_changes)
    put("merkle_roots", "SELECT i, n - CASE WHEN i = 2 THEN first ELSE 0 END AS n_rows, i < 2 AS same FROM (SELECT count(*) AS n, count(*) FILTER (l_orderkey = (SELECT min(l_orderkey) FROM lineitem)) AS first FROM lineitem), (VALUES (0), (1), (2)) t(i)", merkle_roots)
    put("views_and_meta", "SELECT t.table_name, t.n_rows, (SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey) AS n_joined FROM (SELECT 'own_nation' AS table_name, count(*) AS n_rows FROM nation UNION ALL SELECT 'own_region', count(*) FROM region UNION ALL SELECT 'own_supplier', count(*) FROM supplier) t", views)
    put("coverage_ledger", """WITH c AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus <> 'P') SELECT 'from' AS part, CAST(min(d) AS VARCHAR) AS key, count(*) AS n FROM c UNION ALL SELECT 'to', CAST(max(d) AS VARCHAR), count(*) FROM c
      UNION ALL SELECT 'cases', o_orderstatus, count(*) FILTER (o_orderstatus <> 'P') FROM orders GROUP BY 2 UNION ALL SELECT 'non_case', o_orderstatus, count(*) FILTER (o_orderstatus = 'P') FROM orders GROUP BY 2 UNION ALL SELECT 'issue', event_type, count(*) FROM events GROUP BY 2""", covered)  # fmt: skip
    put("json_responses", """SELECT '{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}' AS json FROM region""", lambda spark, d: responses(star.read(spark, d, "region").select("r_regionkey", "r_name")))
    put("successor_link", "SELECT s_suppkey AS sanction_id, i AS declared_infringement FROM supplier LEFT JOIN (SELECT o_orderkey % 50 AS doc, o_orderkey % 3 AS who, CAST(max(o_orderkey) AS VARCHAR) AS i FROM orders GROUP BY 1, 2) ON s_suppkey % 60 = doc AND s_suppkey % 4 = who", linked)
    put("document_profile", """SELECT case_id, severities, articles, statutes, subjects, total FROM (SELECT case_id, string_agg(DISTINCT severity, ';' ORDER BY severity) AS severities, string_agg(DISTINCT article_normalized, ';' ORDER BY article_normalized) AS articles, string_agg(DISTINCT statute_normalized, ';' ORDER BY statute_normalized) AS statutes FROM infringements GROUP BY 1)
      FULL JOIN (SELECT case_id, coalesce(string_agg(DISTINCT normalized_name, ';' ORDER BY normalized_name), '') AS subjects, CAST(sum(amount) AS DECIMAL(38,2)) AS total FROM sanctions LEFT JOIN respondents USING (respondent_id) GROUP BY 1) USING (case_id)""", profile)  # fmt: skip
    put("latest_release", "SELECT max('/x/v0.' || c_custkey || '/coverage.json') AS path FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 2 = 0", releases)
    put("bar_scale", "SELECT statute_normalized, round(n / greatest(max(n) OVER (), 1), 9) AS share FROM (SELECT statute_normalized, count(*) AS n FROM infringements GROUP BY 1)", bars)
    put("top_statutes", "SELECT statute_normalized, count(*) AS n_infringements, count(DISTINCT case_id) AS n_cases FROM infringements GROUP BY 1 ORDER BY n_infringements DESC, statute_normalized LIMIT 8", lambda spark, d: ledger.laws(star.tables(spark, d)).limit(8))
    put("subset_test", "SELECT false AS is_subset UNION ALL SELECT true", lambda spark, d: flow.is_subset(orders(spark, d), orders(spark, d).filter("o_orderkey % 2 = 0"), "o_orderkey").union(flow.is_subset(orders(spark, d).filter("o_orderkey % 2 = 0"), orders(spark, d), "o_orderkey")))
    put("distinct_respondents", "SELECT DISTINCT case_id, respondent_id FROM sanctions", lambda spark, d: star.tables(spark, d)["sanctions"].select("case_id", "respondent_id").distinct())
    put("distinct_dates", "SELECT user_id, CAST(count(DISTINCT CAST(ts AS DATE)) AS INTEGER) AS n_days FROM events GROUP BY 1", lambda spark, d: star.read(spark, d, "events").groupBy("user_id").agg(F.size(F.array_distinct(F.collect_list(F.col("ts").cast("date")))).alias("n_days")))
    put("windowed_counts", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2", lambda spark, d: windowed_counts(star.read(spark, d, "events"), "ts", "1 day", "1 day", "event_type").select("event_type", F.col("window.start").cast("date").alias("day"), "n"))
    put("release_manifest", "SELECT t.table_name, t.n_rows, t.f AS schema_fingerprint FROM (SELECT 'nation' AS table_name, (SELECT count(*) FROM nation) AS n_rows, substr(sha256('n_nationkey:int;n_name:string;n_regionkey:int'), 1, 16) AS f UNION ALL SELECT 'region', (SELECT count(*) FROM region), substr(sha256('r_regionkey:int;r_name:string'), 1, 16)) t", lambda spark, d: sinks.manifest({n: star.read(spark, d, n) for n in ("nation", "region")}).select("table_name", "n_rows", "schema_fingerprint"))
