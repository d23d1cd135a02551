"""The query surface: every endpoint as a function from ledger tables to a DataFrame.

``t`` maps table names to DataFrames. Filters stay declarative, so they reach the Parquet scans; EXISTS is a left semi
join; orders are total (the key breaks ties) and put nulls last.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexledger.functions.dates import known_at as instant

Tables = Mapping[str, DataFrame]
MOST_CASES, MOST_RESPONDENTS = 500, 1000


def contains_ci(c: Column, part: str) -> Column:
    """ILIKE '%part%', with the wildcards % and _ of the user's text live and no escape character."""
    return c.ilike("%" + part.replace("\\", "\\\\") + "%")


def money_text(c: Column) -> Column:
    """Sums leave as decimal strings."""
    return c.cast("decimal(38,2)").cast("string")


# ---- totals ---------------------------------------------------------------------------------------------------------


def stats_totals(t: Tables) -> DataFrame:
    """Four counts and the sum of fines, as one row. Each part is its own aggregate; one-row parts are unioned and
    pivoted by aggregation, so that no join is needed."""
    none = F.lit(None)
    part = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n", none.cast("decimal(38,2)").alias("total"))
    fines = t["sanctions"].filter(F.col("sanction_type") == "MONETARY_FINE").agg(F.sum("amount").cast("decimal(38,2)").alias("total"))
    rows = part(t["cases"], "cases").union(part(t["sanctions"], "sanctions")).union(part(t["infringements"], "infringements")).union(part(t["respondents"], "respondents"))
    rows = rows.union(fines.select(F.lit("fines").alias("what"), none.cast("bigint").alias("n"), "total"))
    pick = lambda name: F.max(F.when(F.col("what") == name, F.col("n"))).alias(f"n_{name}")
    return rows.agg(pick("cases"), pick("sanctions"), pick("infringements"), pick("respondents"), money_text(F.max("total")).alias("total_fines"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def stats_by_severity(t: Tables) -> DataFrame:
    return count_by(t["infringements"], "severity")


def stats_by_type(t: Tables) -> DataFrame:
    return t["sanctions"].groupBy("sanction_type").agg(F.count(F.lit(1)).alias("n"), money_text(F.sum("amount")).alias("total"))


def stats_by_statute(t: Tables) -> DataFrame:
    return count_by(t["infringements"], "statute_normalized").orderBy(F.desc("n"), F.asc_nulls_last("statute_normalized"))


def sanctioned_parties(t: Tables) -> DataFrame:
    s = t["sanctions"]
    return s.agg(F.countDistinct("respondent_id").alias("n_parties"), F.count("amount").alias("n_amounts"), F.count(F.lit(1)).alias("n_sanctions"))


# ---- cases ----------------------------------------------------------------------------------------------------------


def list_cases(t: Tables, severity: str | None = None, statute: str | None = None, respondent: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    out = t["cases"]
    if severity is not None:
        out = out.join(t["infringements"].filter(F.col("severity") == severity), "case_id", "left_semi")
    if statute is not None:
        out = out.join(t["infringements"].filter(contains_ci(F.col("statute_normalized"), statute)), "case_id", "left_semi")
    if respondent is not None:
        named = t["respondents"].filter(contains_ci(F.col("normalized_name"), respondent)).select("respondent_id")
        out = out.join(t["case_respondents"].join(named, "respondent_id", "left_semi"), "case_id", "left_semi")
    out = out.join(t["case_status"].select("case_id", "firmness_status"), "case_id", "left")
    return out.orderBy(F.desc_nulls_last("boe_publication_date"), "case_id").offset(max(0, offset)).limit(min(limit, MOST_CASES))


def case_by_key(t: Tables, key: str) -> DataFrame:
    return t["cases"].filter((F.col("case_id") == key) | (F.col("canonical_boe_id") == key))


def case_sanctions(t: Tables, case_id: str) -> DataFrame:
    names = t["respondents"].select("respondent_id", F.col("normalized_name").alias("respondent_name"))
    return t["sanctions"].filter(F.col("case_id") == case_id).join(names, "respondent_id", "left").orderBy("ordinal", "sanction_id")


def case_people(t: Tables, case_id: str) -> DataFrame:
    return t["case_respondents"].filter(F.col("case_id") == case_id).join(t["respondents"], "respondent_id").orderBy("respondent_id")


def case_evidence(t: Tables, case_id: str, until: datetime | None = None) -> DataFrame:
    """Evidence of the case's own entities (by prefix) and of its respondents (by semi join)."""
    e = t["evidence"] if until is None else t["evidence"].filter(F.col("observed_at") <= F.lit(until))
    mine = e.filter(F.col("entity_id").startswith(f"{case_id}/"))
    people = t["case_respondents"].filter(F.col("case_id") == case_id).select(F.col("respondent_id").alias("entity_id"))
    return mine.unionByName(e.join(people, "entity_id", "left_semi")).orderBy(F.asc_nulls_last("entity_id"))


def case_detail(t: Tables, case_id: str, known_at: str | None = None) -> dict[str, DataFrame]:
    """The case and its children, as of now or as known at an instant."""
    v = t if known_at is None else as_known_at(t, instant(known_at))
    of = lambda name: v[name].filter(F.col("case_id") == case_id)
    return {
        "case": of("cases"), "sanctions": case_sanctions(v, case_id), "infringements": of("infringements").orderBy("ordinal", "infringement_id"),
        "respondents": case_people(v, case_id), "events": of("events").orderBy(F.asc_nulls_last("event_date"), "event_id"),
        "evidence": case_evidence(v, case_id), "status_notes": of("status_notes"),
    }


def as_known_at(t: Tables, at: datetime) -> dict[str, DataFrame]:
    """The ledger as it was known at ``at`` (naive UTC): only ``observed_at`` decides, never an effective date.

    Sanctions and infringements need visible evidence; respondents show once their case is known; counts are those of
    what is visible; what a case says of itself is null while nothing of it is known."""
    until = F.col("observed_at") <= F.lit(at)
    evidence, events = t["evidence"].filter(until), t["events"].filter(until)
    seen = evidence.select(F.col("entity_id").alias("id")).distinct()
    sanctions = t["sanctions"].join(seen, F.col("sanction_id") == F.col("id"), "left_semi")
    infringements = t["infringements"].join(seen, F.col("infringement_id") == F.col("id"), "left_semi")
    known = sanctions.select("case_id").union(infringements.select("case_id")).distinct()
    people = t["case_respondents"].join(known, "case_id", "left_semi")
    status = t["case_status"].filter(until)
    n = lambda df, name: df.groupBy("case_id").agg(F.count(F.lit(1)).cast("int").alias(name))
    base = t["cases"].drop("n_infringements", "n_sanctions", "n_respondents")
    counted = base.join(n(infringements, "n_infringements"), "case_id", "left").join(n(sanctions, "n_sanctions"), "case_id", "left").join(n(people, "n_respondents"), "case_id", "left")
    counted = counted.join(known.withColumn("known", F.lit(True)), "case_id", "left").join(status.select("case_id", F.lit(True).alias("status_known")), "case_id", "left")
    said = ["administrative_finality_observed", "judicial_review_mentioned", "administrative_appeal_observed"]
    cases = counted.select(
        *[
            F.when(F.col("known"), F.col(c)).alias(c) if c in said
            else F.when(F.col("status_known"), F.col(c)).alias(c) if c in ("appeal_observation_status", "coverage_basis_id")
            else F.coalesce(F.col(c), F.lit(0)).alias(c) if c in ("n_infringements", "n_sanctions", "n_respondents")
            else F.col(c)
            for c in t["cases"].columns
        ],
        F.when(F.col("known"), "AS_KNOWN_AT").otherwise("NO_OBSERVATION_HISTORY").alias("history_mode"),
    )
    return dict(t) | {
        "evidence": evidence, "events": events, "sanctions": sanctions, "infringements": infringements, "case_respondents": people, "case_status": status, "cases": cases,
        "respondents": t["respondents"].join(people.select("respondent_id").distinct(), "respondent_id", "left_semi"),
        "status_notes": t["status_notes"].join(status.select("case_id"), "case_id", "left_semi"),
    }


# ---- respondents, laws, status --------------------------------------------------------------------------------------


def respondents(t: Tables, q: str | None = None, limit: int = 200) -> DataFrame:
    """Respondents with their sanctions, the largest total first."""
    people = t["respondents"] if q is None else t["respondents"].filter(contains_ci(F.col("normalized_name"), q))
    s = t["sanctions"].select("respondent_id", "sanction_id", "case_id", "amount")
    rows = people.join(s, "respondent_id", "left").groupBy("respondent_id", "normalized_name", "respondent_type")
    out = rows.agg(F.count("sanction_id").alias("n_sanctions"), F.countDistinct("case_id").alias("n_cases"), F.sum("amount").cast("decimal(38,2)").alias("total_amount"))
    return out.orderBy(F.desc_nulls_last("total_amount"), "respondent_id").limit(min(limit, MOST_RESPONDENTS))


def respondent_search(t: Tables, name: str) -> DataFrame:
    """Names that contain the text, with count and sum: one join instead of a query for each hit."""
    return respondents(t | {"respondents": t["respondents"].filter(F.contains(F.lower("normalized_name"), F.lit(name.lower())))}, limit=MOST_RESPONDENTS)


def respondent_cases(t: Tables, respondent_id: str) -> DataFrame:
    return t["cases"].join(t["case_respondents"].filter(F.col("respondent_id") == respondent_id), "case_id").orderBy(F.desc_nulls_last("boe_publication_date"), "case_id")


def laws(t: Tables) -> DataFrame:
    out = t["infringements"].groupBy("statute_normalized").agg(F.count(F.lit(1)).alias("n_infringements"), F.countDistinct("case_id").alias("n_cases"))
    return out.orderBy(F.desc("n_infringements"), F.asc_nulls_last("statute_normalized"))


def article(t: Tables, statute: str, number: str) -> DataFrame:
    return t["infringements"].filter(contains_ci(F.col("statute_normalized"), statute) & (F.col("article_normalized") == number))


def status(t: Tables) -> DataFrame:
    cases = t["cases"].select("case_id", "canonical_boe_id", "boe_publication_date", "appeal_observation_status")
    return cases.join(t["case_status"], "case_id", "left")
