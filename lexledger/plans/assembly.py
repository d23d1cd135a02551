"""From parsed publications to the thirteen tables: explodes, content ids, rule resolution; no per-row Python."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexledger.functions import ids, text
from lexledger.functions.legal import appeal_status
from lexledger.grammar.udf import parse_publications, spread
from lexledger.operators import dataflow as flow
from lexledger.streaming.incremental import shared_dir
from lexledger.schemas import TABLES

# Instruments (family, aliases, from, to) and rules (id, family, article, conduct) of the index.
INSTRUMENTS = [
    ("LMV_1988", ["Ley 24/1988", "Ley del Mercado de Valores", "LMV"], "1988-07-29", "2015-10-23"),
    ("TRLMV", ["Real Decreto Legislativo 4/2015", "Real Decreto 4/2015", "Ley del Mercado de Valores", "LMV", "TRLMV"], "2015-10-24", "2023-03-16"),
    ("LMV_2023", ["Ley 6/2023", "Ley de los Mercados de Valores y de las Fuentes de Inversión", "Ley del Mercado de Valores", "LMV", "LMVSI"], "2023-03-17", None),
    ("LIIC_2003", ["Ley 35/2003", "Ley de Instituciones de Inversión Colectiva"], "2003-11-05", None),
    ("LESI_2014", ["Ley 22/2014"], "2014-11-13", None),
    ("LESI_2015", ["Ley 5/2015"], "2015-04-26", None),
    ("MAR_596_2014", ["Reglamento (UE) 596/2014", "Reglamento UE 596/2014", "MAR"], "2016-07-03", None),
]
RULES = [
    ("trlmv-278.2", "TRLMV", "278.2", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"), ("trlmv-282.2", "TRLMV", "282.2", "DISCLOSURE.INSIDE_INFORMATION"), ("trlmv-282.3", "TRLMV", "282.3", "DISCLOSURE.INSIDE_INFORMATION"),
    ("trlmv-282.5", "TRLMV", "282.5", "MARKET_ABUSE.MARKET_MANIPULATION"), ("trlmv-282.6", "TRLMV", "282.6", "DISCLOSURE.INSIDE_INFORMATION"), ("trlmv-282.15", "TRLMV", "282.15", "MARKET_ABUSE.INSIDER_DEALING"),
    ("trlmv-282.16", "TRLMV", "282.16", "DISCLOSURE.PERIODIC_REPORTING"), ("trlmv-282.19", "TRLMV", "282.19", "DISCLOSURE.SIGNIFICANT_HOLDINGS"), ("trlmv-283.1", "TRLMV", "283.1", "OTHER"),
    ("trlmv-283.3", "TRLMV", "283.3", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"), ("trlmv-283.8", "TRLMV", "283.8", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"), ("trlmv-283.11", "TRLMV", "283.11", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"),
    ("trlmv-283.12", "TRLMV", "283.12", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"), ("trlmv-284.1", "TRLMV", "284.1", "INVESTMENT_SERVICES.BEST_EXECUTION"), ("trlmv-284.5", "TRLMV", "284.5", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"),
    ("trlmv-292.4", "TRLMV", "292.4", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"), ("trlmv-295.4", "TRLMV", "295.4", "MARKET_ABUSE.MARKET_MANIPULATION"), ("trlmv-295.5", "TRLMV", "295.5", "MARKET_ABUSE.INSIDER_DEALING"),
    ("trlmv-295.13", "TRLMV", "295.13", "MARKET_ABUSE.MARKET_MANIPULATION"), ("trlmv-295.14", "TRLMV", "295.14", "OTHER"), ("trlmv-295.15", "TRLMV", "295.15", "MARKET_ABUSE.UNLAWFUL_DISCLOSURE"),
    ("trlmv-295.18", "TRLMV", "295.18", "MARKET_ABUSE.INSIDER_DEALING"), ("trlmv-296.5", "TRLMV", "296.5", "INVESTMENT_SERVICES.ORGANISATIONAL_REQUIREMENTS"), ("trlmv-296.12", "TRLMV", "296.12", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"),
    ("trlmv-296.14", "TRLMV", "296.14", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"), ("lmv23-282.1.b", "LMV_2023", "282.1.b", "DISCLOSURE.INSIDE_INFORMATION"), ("lmv23-290.1.n", "LMV_2023", "290.1.n", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"),
    ("lmv23-292.1.b", "LMV_2023", "292.1.b", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"), ("lmv23-292.1.f", "LMV_2023", "292.1.f", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"), ("lmv23-293.1.a", "LMV_2023", "293.1.a", "DISCLOSURE.INSIDE_INFORMATION"),
    ("lmv23-297.1.c", "LMV_2023", "297.1.c", "MARKET_ABUSE.MARKET_MANIPULATION"), ("lmv23-297.1.e", "LMV_2023", "297.1.e", "MARKET_ABUSE.MARKET_MANIPULATION"), ("liic-80", "LIIC_2003", "80", "COLLECTIVE_INVESTMENT.INVESTMENT_POLICY"),
    ("liic-80.p", "LIIC_2003", "80.p", "COLLECTIVE_INVESTMENT.INVESTMENT_POLICY"), ("liic-81.o", "LIIC_2003", "81.o", "COLLECTIVE_INVESTMENT.RISK_MANAGEMENT"), ("liic-81.z", "LIIC_2003", "81.z", "COLLECTIVE_INVESTMENT.RISK_MANAGEMENT"),
    ("lesi14-93", "LESI_2014", "93", "COLLECTIVE_INVESTMENT.RISK_MANAGEMENT"), ("lesi14-93.a", "LESI_2014", "93.a", "COLLECTIVE_INVESTMENT.RISK_MANAGEMENT"), ("lesi14-93.p", "LESI_2014", "93.p", "COLLECTIVE_INVESTMENT.DISCLOSURE"),
    ("lesi14-94.o", "LESI_2014", "94.o", "COLLECTIVE_INVESTMENT.RISK_MANAGEMENT"), ("lesi14-94.ñ", "LESI_2014", "94.ñ", "COLLECTIVE_INVESTMENT.RISK_MANAGEMENT"), ("lefe-92", "LESI_2015", "92", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"),
    ("lefe-92.1.h", "LESI_2015", "92.1.h", "INVESTMENT_SERVICES.CONDUCT_OF_BUSINESS"),
]


def dimensions(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    instruments = spark.createDataFrame(INSTRUMENTS, "family string, aliases array<string>, valid_from string, valid_to string")
    return instruments.withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")}), spark.createDataFrame(RULES, "rule_id string, family string, article string, conduct_code string")


def parsed_corpus(corpus: DataFrame) -> DataFrame:
    """Parsed publications (path, corpus, ...); of one boe_id the first file wins, told by the names alone. The files that
    lose are told apart without contents, which move once, dealt out for the parser."""
    losers = flow.later_entries(corpus.select("boe_id", "corpus", "path"), ["boe_id"], ["corpus", "path"]).select("corpus", "path")
    dealt = spread(corpus.select("corpus", "path", "content"), "corpus", "path")
    return parse_publications(dealt.join(losers, ["corpus", "path"], "left_anti"), carry=["corpus"], dealt=True).select("path", "corpus", "publication.*")


def kept(parsed: DataFrame) -> DataFrame:
    """Computed once, as columns in the shared folder: each table then reads those that it needs."""
    spark = parsed.sparkSession
    folder = f"{shared_dir(spark)}/parsed-{uuid.uuid4().hex}"
    parsed.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(parsed.schema).parquet(folder)


#: What a person's or company's mention in a sanction tells of the respondent.
PEOPLE = "respondent_id string, boe_id string, corpus string, path string, ordinal int, subject string, name string, respondent_type string, role string"


def respondents_of(people: DataFrame) -> DataFrame:
    """The respondents among mentions (PEOPLE): as the first mention has them."""
    first = flow.first_wins(people, ["respondent_id"], ["corpus", "path", "ordinal"])
    policy = F.when(F.col("respondent_type") == "NATURAL_PERSON", "NAME_AS_PUBLISHED").otherwise("PUBLIC")
    return first.select("respondent_id", F.col("subject").alias("raw_display_name"), F.col("name").alias("normalized_name"), "respondent_type", (F.col("respondent_type") == "ANONYMIZED_PERSON").alias("source_anonymized"), policy.alias("publication_policy"), F.col("role").alias("role_raw"))


SIDECAR = "boe_id string, title string, register_entry_date date, method string, score double"
OBSERVATIONS = "boe_id string, sha256 string, notes array<struct<kind: string, page: int, verbatim: string>>, status string, retrieval string, first_observed_at string, observed_at string"


def assemble(parsed: DataFrame, corpus: DataFrame, observed_at: datetime, sidecar: DataFrame | None = None, observations: DataFrame | None = None) -> dict[str, DataFrame]:
    """The ledger's tables."""
    return assemble_with_people(kept(parsed), corpus, observed_at, sidecar, observations)[0]


def assemble_with_people(parsed: DataFrame, corpus: DataFrame, observed_at: datetime, sidecar: DataFrame | None = None, observations: DataFrame | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The ledger's tables, and the mentions (PEOPLE) that its respondents come from. ``parsed`` is read by each table, so
    it should be stored; ``observed_at``: when this build saw
    its sources (naive UTC); ``observations``: (boe_id, sha256, notes, status, retrieval, first_observed_at, observed_at) of
    later notices."""
    spark = parsed.sparkSession
    at = F.lit(observed_at).cast("timestamp")
    case = F.concat(F.lit("CNMV-"), F.col("boe_id"))
    pubs = parsed.filter((F.col("document_kind") == "SANCTION_PUBLICATION") & F.col("boe_id").isNotNull())
    blocks = pubs.select(case.alias("case_id"), "boe_id", "raw_sha256", "corpus", "path", "paragraphs", F.inline("blocks")).withColumn("infringement_id", F.concat("case_id", F.lit("/I"), "ordinal"))
    # A block that only carries a successor's sanctions is no infringement of its own.
    successors = lambda b: b["declared_for"].isNotNull() & b["article"].isNull()
    own = blocks.filter(~successors({c: F.col(c) for c in ("declared_for", "article")}))
    lines = blocks.select("case_id", "boe_id", "raw_sha256", "corpus", "path", "paragraphs", F.coalesce(F.concat("case_id", F.lit("/I"), "declared_for"), "infringement_id").alias("infringement_id"), "severity", F.explode("sanctions").alias("s"))
    who = lambda s: ids.respondent_id(text.normalize_key(s["name"]), s["respondent_type"])
    lines = lines.select("*", who(F.col("s")).alias("respondent_id"), F.concat("case_id", F.lit("/S"), "s.ordinal").alias("sanction_id"))
    sidecar = sidecar if sidecar is not None else spark.createDataFrame([], SIDECAR)
    seen = observations if observations is not None else spark.createDataFrame([], OBSERVATIONS)
    people = lines.filter("s.name IS NOT NULL")
    kinds = F.transform(F.coalesce("notes", F.array().cast("array<struct<kind:string,page:int,verbatim:string>>")), lambda x: x["kind"])
    appeal = seen.select("boe_id", appeal_status(F.col("retrieval"), kinds).alias("appeal"), "retrieval", F.col("sha256").alias("pdf_sha"), "observed_at")
    status = F.coalesce("appeal", F.lit("INCONCLUSIVE"))
    # Counted in the publication's own row, and over those that have the same id, if there are several.
    fines = F.flatten(F.transform("blocks", lambda b: b["sanctions"]))
    counted = pubs.select(
        case.alias("case_id"), *[c for c in pubs.columns if c not in ("blocks", "paragraphs", "issues", "underlying")], F.size(F.filter("blocks", lambda b: ~successors(b))).alias("n_own"), F.size(fines).alias("n_fines"),
        F.array_distinct(F.transform(F.filter(fines, lambda s: s["name"].isNotNull()), who)).alias("fined"),
    )
    same = Window.partitionBy("boe_id")
    totals = {"n_infringements": F.sum("n_own").over(same), "n_sanctions": F.sum("n_fines").over(same), "n_respondents": F.size(F.array_distinct(F.flatten(F.collect_list("fined").over(same))))}
    cases = (
        counted.withColumns(totals)
        .join(sidecar.select("boe_id", "register_entry_date"), "boe_id", "left").join(appeal, "boe_id", "left")
        .select(
            "case_id", F.lit("CNMV").alias("authority"), F.col("title").alias("title_raw"), F.col("boe_id").alias("canonical_boe_id"), F.col("sanctioning_resolution_date").cast("date").alias("sanctioning_resolution_date"),
            F.col("document_date").cast("date").alias("publication_resolution_date"), "register_entry_date", F.col("publication_date").cast("date").alias("boe_publication_date"),
            "administrative_finality_observed", "judicial_review_mentioned", "administrative_appeal_observed", *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in totals],
            status.alias("appeal_observation_status"), F.when(status != "INCONCLUSIVE", ids.coverage_basis_id(("source", F.lit("CNMV_PDF")), ("boe_id", F.col("boe_id")), ("sha256", F.col("pdf_sha")), ("observed_at", F.col("observed_at")))).alias("coverage_basis_id"),
        )
    )
    states = [("FIRM_STATED", "FIRMNESS"), ("RENUNCIATION_OBSERVED", "RENUNCIATION"), ("APPEAL_OBSERVED", "APPEAL_NOTICE"), ("APPEAL_OBSERVED", "JUDICIAL_APPEAL"), ("JUDGMENT_OBSERVED", "JUDGMENT")]
    firm = F.lit("UNKNOWN")
    for label, kind in states:
        firm = F.when(F.array_contains(kinds, kind), label).otherwise(firm)
    notes = seen.select(case.alias("case_id"), "observed_at", "sha256", F.explode("notes").alias("n")).select("case_id", "observed_at", "sha256", "n.*")

    def facts_of(df, entity, rows):
        there = F.get(F.filter("paragraphs", lambda p: p["index"] == F.col("paragraph")), F.lit(0))["text"]
        each = df.select("boe_id", "raw_sha256", "paragraph", flow.squeezed(there).alias("p"), F.array(*[F.struct(F.col(entity).alias("entity_id"), *[x[c].alias(c) for c in ("kind", "name", "value", "excerpt", "method")], flow.squeezed(x["excerpt"]).alias("e"), flow.squeezed(x["value"]).alias("v")) for x in rows]).alias("fs"))
        return each.select("boe_id", "raw_sha256", "paragraph", "p", F.explode("fs").alias("f"))

    fact = lambda kind, name, value, excerpt, method="DIRECT": F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), value.cast("string").alias("value"), excerpt.alias("excerpt"), F.lit(method).alias("method"))
    lined = lines.select("*", F.col("s.paragraph").alias("paragraph"), F.col("s.text").alias("header"))
    rows = facts_of(own, "infringement_id", [fact("infringement", "severity", F.col("severity"), F.col("header"), "NORMALIZED"), fact("infringement", "article", F.col("article_raw"), F.col("header")), fact("infringement", "conduct", F.col("conduct"), F.col("header"))])
    rows = rows.unionByName(facts_of(lined, "sanction_id", [fact("sanction", "subject", F.col("s.subject"), F.col("header")), fact("sanction", "sanction_text", F.col("s.text"), F.col("header")), fact("sanction", "amount", F.col("s.amount_raw"), F.col("header"), "NORMALIZED")]))
    rows = rows.unionByName(facts_of(lined.filter("s.name IS NOT NULL").withColumn("paragraph", F.lit(None).cast("int")), "respondent_id", [fact("respondent", "name", F.col("s.name"), F.col("s.subject"))]))
    rows = rows.filter(~((F.col("f.name") == "amount") & F.col("f.value").isNull()))
    event = lambda kind, day, flag=None: F.when(F.lit(True) if flag is None else F.col(flag), F.struct(F.lit(kind).alias("event_type"), day.cast("date").alias("event_date")))
    happened = F.filter(
        F.array(event("RESOLUTION", F.col("sanctioning_resolution_date")), event("ADMINISTRATIVE_FINALITY", F.lit(None), "administrative_finality_observed"), event("ADMINISTRATIVE_APPEAL", F.lit(None), "administrative_appeal_observed"), event("BOE_PUBLICATION", F.col("publication_date"))),
        lambda x: x.isNotNull(),
    )
    # A publication without a block, or without a sanction, is a case all the same, and an issue.
    sanctioned = F.exists("blocks", lambda b: F.size(b["sanctions"]) > 0)
    empty_handed = pubs.filter(~sanctioned).select("boe_id", F.when(F.size("blocks") == 0, "NO_BLOCK").otherwise("NO_SANCTION").alias("kind"), F.col("path").alias("detail"))
    none = F.lit(None).cast("string")
    own_events = pubs.select(case.alias("case_id"), "boe_id", F.posexplode(happened).alias("pos", "e")).select(
        ids.event_id(F.col("case_id"), F.col("e.event_type"), F.col("pos")).alias("event_id"), "case_id", "e.event_type", "e.event_date", at.alias("observed_at"), F.col("boe_id").alias("source_document_id"), none.alias("event_payload"))
    noted = notes.filter(F.col("kind").isin("APPEAL_NOTICE", "JUDICIAL_APPEAL", "JUDGMENT")).select(
        ids.pdf_event_id(F.col("case_id"), F.col("kind"), F.col("page"), F.col("verbatim")).alias("event_id"), "case_id", F.when(F.col("kind") == "APPEAL_NOTICE", "ADMINISTRATIVE_APPEAL").when(F.col("kind") == "JUDGMENT", "JUDGMENT").otherwise("JUDICIAL_APPEAL_FILED").alias("event_type"),
        F.lit(None).cast("date").alias("event_date"), F.col("observed_at").cast("timestamp").alias("observed_at"), F.col("sha256").alias("source_document_id"), F.to_json(F.struct("kind", "page", "verbatim")).alias("event_payload"))
    mentions = people.select("respondent_id", "boe_id", "corpus", "path", "s.ordinal", "s.subject", "s.name", "s.respondent_type", "s.role")
    out = {
        "cases": cases,
        "case_status": seen.select(case.alias("case_id"), firm.alias("firmness_status"), F.size("notes").alias("n_cnmv_notes"), F.col("sha256").alias("pdf_sha256"), F.col("first_observed_at").cast("timestamp").alias("first_observed_at"), F.col("observed_at").cast("timestamp").alias("observed_at")),
        "status_notes": notes.select("case_id", "kind", "page", "verbatim"),
        "events": own_events.unionByName(noted),
        "documents": parsed.select(F.coalesce("boe_id", F.sha2("path", 256)).alias("document_id"), "boe_id", F.lit("AEBOE").alias("source"), "corpus", F.lit("XML").alias("format"), "title", F.col("publication_date").cast("date").alias("publication_date"), F.col("document_date").cast("date").alias("document_date")),
        "respondents": respondents_of(mentions),
        "case_respondents": people.groupBy("case_id", "respondent_id").agg(F.first("s.role", ignorenulls=True).alias("role")),
        "infringements": flow.resolve_rules(own.withColumns({"start": F.col("conduct_start").cast("date"), "end": F.col("conduct_end").cast("date")}), *dimensions(spark)).select("infringement_id", "case_id", "ordinal", "severity", "statute_raw", "article_raw", F.col("statute").alias("statute_normalized"), F.col("article").alias("article_normalized"), F.col("conduct").alias("conduct_raw"), F.col("conduct_start").cast("date").alias("conduct_start_date"), F.col("conduct_end").cast("date").alias("conduct_end_date"), F.coalesce("conduct_code", F.lit("UNKNOWN")).alias("conduct_code"), "rule_version_id", "rule_resolution_status", F.size("related").alias("n_related_provisions")),
        "related_provisions": own.select("infringement_id", "case_id", F.explode("related").alias("r")).select("infringement_id", "case_id", "r.statute_raw", "r.article_raw", F.col("r.statute").alias("statute_normalized"), F.col("r.article").alias("article_normalized"), F.lit("RELATED").alias("relation")),
        "sanctions": lines.select("sanction_id", "case_id", F.when(F.col("s.name").isNotNull(), F.col("respondent_id")).alias("respondent_id"), "infringement_id", "s.ordinal", F.col("s.type").alias("sanction_type"), "severity", "s.amount", "s.currency", "s.amount_raw", "s.duration_raw"),
        "evidence": rows.select(F.col("f.kind").alias("fact_type"), F.col("f.entity_id").alias("entity_id"), F.col("f.name").alias("field_name"), F.col("boe_id").alias("document_id"), F.when(F.col("paragraph").isNotNull(), F.concat(F.lit("texto/p["), "paragraph", F.lit("]"))).alias("locator"), F.substr("f.excerpt", F.lit(1), F.lit(500)).alias("excerpt"), F.col("f.method").alias("extraction_method"), F.col("f.method").alias("confidence_type"), at.alias("observed_at"), F.lit("XML").alias("representation"), F.lit("PARAGRAPH").alias("locator_type"), F.col("raw_sha256").alias("artifact_sha256"), flow.proof_of(F.col("f.e"), F.col("f.value"), F.col("f.v"), F.col("p"), F.col("raw_sha256"), F.col("raw_sha256")).alias("proof_level"), F.col("f.value").alias("raw_value")),
        "parse_issues": parsed.select("boe_id", F.inline("issues")).unionByName(empty_handed).unionByName(flow.later_entries(corpus, ["boe_id"], ["corpus", "path"]).select("boe_id", F.lit("DUPLICATE_DOCUMENT").alias("kind"), F.col("path").alias("detail"))),
        "review_items": spark.createDataFrame([], TABLES["review_items"]),
    }
    return {k: v.to(spark.createDataFrame([], TABLES[k]).schema) for k, v in out.items()}, mentions.to(spark.createDataFrame([], PEOPLE).schema)
