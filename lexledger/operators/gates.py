"""Release gates: every gate is a DataFrame of violations; it holds if that is empty.

``t`` has the ledger's tables. Gates that look at more than the tables take it as an argument and are left out without it:
the parsed publications, a defect registry with names of tests, an enumeration, a holdout, fixtures, a coverage note."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexledger.operators import dataflow as flow


def gate(name: str, violations: DataFrame) -> DataFrame:
    """One row: the gate, its number of violations, and whether it holds."""
    return violations.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("gate"), "n_violations", (F.col("n_violations") == 0).alias("ok"))


def table_violations(t: Mapping[str, DataFrame], built_at) -> dict[str, DataFrame]:
    """Gates over the tables as written."""
    docs, cases, inf, san, ev = t["documents"], t["cases"], t["infringements"], t["sanctions"], t["evidence"]
    fine = F.col("sanction_type") == "MONETARY_FINE"
    negative = F.col("appeal_observation_status") == "NOT_OBSERVED_WITHIN_VERIFIED_COVERAGE"
    late = F.col("observed_at") > F.lit(built_at) + F.expr("INTERVAL 1 HOUR")
    dates = cases.select("case_id", "boe_publication_date")
    return {
        "documents_parsed": t["parse_issues"].filter(F.col("kind") == "PARSE_FAILED"),
        "case_has_infringement": cases.join(inf, "case_id", "left_anti"),
        "case_has_sanction": cases.join(san, "case_id", "left_anti"),
        "severity_present": inf.filter(F.col("severity").isNull() | (F.col("severity") == "UNKNOWN")),
        "article_present": inf.filter("article_normalized IS NULL"),
        "statute_present": inf.filter("statute_normalized IS NULL"),
        "sanction_has_respondent": san.filter("respondent_id IS NULL"),
        "fine_has_amount": san.filter(fine & F.col("amount").isNull()),
        "non_monetary_has_no_amount": san.filter(~fine & (F.col("sanction_type") != "DISGORGEMENT") & F.col("amount").isNotNull()),
        "references_resolve": san.filter("infringement_id IS NOT NULL").join(inf, "infringement_id", "left_anti").select("sanction_id").union(san.filter("respondent_id IS NOT NULL").join(t["respondents"], "respondent_id", "left_anti").select("sanction_id")),
        "sanction_id_unique": san.groupBy("sanction_id").count().filter("count > 1"),
        "sanction_has_evidence": san.join(ev.select(F.col("entity_id").alias("sanction_id")), "sanction_id", "left_anti"),
        "resolution_before_publication": cases.filter("sanctioning_resolution_date > boe_publication_date"),
        "conduct_before_publication": inf.join(dates, "case_id").filter("conduct_end_date > boe_publication_date"),
        "evidence_has_document": ev.join(docs, "document_id", "left_anti"),
        "proven_value_has_locator_and_sha": ev.filter((F.col("proof_level") == "VALUE_BINDING_PROVEN") & (F.col("locator").isNull() | F.col("artifact_sha256").isNull())),
        "verified_negative_has_basis": cases.filter(negative & F.col("coverage_basis_id").isNull()),
        "no_future_observation": ev.filter(late).select("entity_id").union(t["events"].filter(late).select("event_id")),
        "sanction_respondent_not_empty": san.filter(F.trim("respondent_id") == ""),
        "evidence_bound_to_artifact": ev.filter(F.coalesce("artifact_sha256", F.lit("")) == ""),
        "fine_amount_is_decimal": san.filter(fine & (F.typeof("amount") != "decimal(18,2)")),
    }


def publication_violations(publications: DataFrame, cases: DataFrame) -> dict[str, DataFrame]:
    """Publications as parsed, those that became no case too: blocks, sanctions, and an account of each corpus."""
    own = publications.filter("document_kind = 'SANCTION_PUBLICATION' AND error IS NULL")
    n = publications.groupBy("corpus").agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("document_kind") != "SANCTION_PUBLICATION").alias("n_other"))
    made = publications.select("corpus", F.col("boe_id").alias("canonical_boe_id")).join(cases.select("canonical_boe_id"), "canonical_boe_id").groupBy("corpus").agg(F.count(F.lit(1)).alias("n_cases"))
    return {
        "publication_has_block": own.filter(F.size("blocks") == 0),
        "publication_has_sanction": own.filter(~F.exists("blocks", lambda b: F.size(b["sanctions"]) > 0)),
        "documents_reconcile_with_cases": n.join(made, "corpus", "left").filter(F.col("n_documents") - F.coalesce("n_cases", F.lit(0)) != F.col("n_other")),
    }


def review_violations(defects: DataFrame, tests: DataFrame, reviews: DataFrame, documents: DataFrame, compat: str, released: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every defect (defect_id, fixtures) has a test (name: test_<defect>_...), reviews name known pairs of defect and
    fixture, and staleness is what a look at versions and bytes says, computed without apply_staleness. ``released``:
    (review_id, status) as a release has them; without it what apply_staleness says is looked at."""
    covered = tests.select(F.regexp_extract("name", "^test_(.+?)_", 1).alias("defect_id"))
    pairs = defects.select(F.col("defect_id").alias("subject_id"), F.explode("fixtures").alias("document_id"))
    orphans = reviews.filter("subject_type = 'defect'").join(pairs, ["subject_id", "document_id"], "left_anti")
    shas = documents.select("document_id", F.col("sha256").alias("sha"))
    other = (F.col("review_compat_version") != compat) | ~F.coalesce("raw_sha256", F.lit("")).eqNullSafe(F.coalesce("sha", F.lit("")))
    expected = reviews.join(shas, "document_id", "left").filter(other | F.col("sha").isNull()).select("review_id")
    said = flow.apply_staleness(reviews, documents, compat) if released is None else released
    stale = said.filter("status = 'STALE'").select("review_id")
    return {
        "defects_have_tests": defects.join(covered, "defect_id", "left_anti").select("defect_id").union(orphans.select("review_id")),
        "staleness_as_expected": expected.join(stale, "review_id", "left_anti").union(stale.join(expected, "review_id", "left_anti")),
    }


def history_violations(publications: DataFrame, enumerated: DataFrame, register: str) -> dict[str, DataFrame]:
    """Publications outside the register's corpus were all enumerated (boe_id)."""
    return {"history_is_enumerated": publications.filter(F.col("corpus") != register).join(enumerated.select("boe_id"), "boe_id", "left_anti")}


def holdout_violations(holdout: DataFrame) -> dict[str, DataFrame]:
    """Publications never developed on parse and carry sanctions."""
    return {"holdout_has_sanctions": holdout.filter(F.col("error").isNotNull() | ~F.exists("blocks", lambda b: F.size(b["sanctions"]) > 0))}


def fixture_violations(files: DataFrame, sums: DataFrame) -> dict[str, DataFrame]:
    """Fixtures (name, content) have the SHA-256 that was noted (name, expected)."""
    own = files.select("name", F.sha2("content", 256).alias("sha256"))
    return {"fixtures_match_sums": sums.join(own, "name", "left").filter(~F.col("sha256").eqNullSafe(F.col("expected")))}


def summary_violations(summaries: DataFrame, items: DataFrame, key: str) -> dict[str, DataFrame]:
    """Every daily summary, whatever its shape, gives items."""
    return {"summaries_give_items": summaries.select(key).distinct().join(items.select(key), key, "left_anti")}


def note_violations(notes: DataFrame, note: str) -> dict[str, DataFrame]:
    """A coverage note says that the history is not exhaustive."""
    return {"coverage_note_is_honest": notes.filter(~F.contains(F.lower(F.coalesce(note, F.lit(""))), F.lit("not exhaustive")))}


def release_gates(*violations: Mapping[str, DataFrame]) -> DataFrame:
    """One row for each gate of all groups of violations."""
    rows = [gate(k, v) for group in violations for k, v in group.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out
