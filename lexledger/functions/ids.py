"""Identifiers derived from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(*parts: Column, digits: int = 64) -> Column:
    """SHA-256 of the parts joined by "|"; null counts as empty and keeps its place."""
    return F.substr(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), F.lit(1), F.lit(digits))


def case_id(boe_id: Column, *register: Column) -> Column:
    return F.when(boe_id.isNotNull(), F.concat(F.lit("CNMV-"), boe_id)).otherwise(F.concat(F.lit("CNMV-REG-"), content_hash(*register, digits=16)))


def respondent_id(name_key: Column, kind: Column) -> Column:
    return F.concat(F.lit("RESP-"), content_hash(name_key, kind, digits=16))


def event_id(case: Column, kind: Column, *parts: Column) -> Column:
    return F.concat(case, F.lit("/EV-"), kind, F.lit("-"), content_hash(case, kind, *parts, digits=12))


def pdf_event_id(case: Column, kind: Column, page: Column, verbatim: Column) -> Column:
    return F.concat(case, F.lit("/PDF-"), content_hash(kind, page, F.substr(verbatim, F.lit(1), F.lit(120)), digits=12))


def review_id(*parts: Column) -> Column:
    return F.concat(F.lit("RV-"), content_hash(*parts, digits=16))


def source_id(authority: Column, kind: Column, sha: Column) -> Column:
    return F.concat_ws(":", authority, kind, F.substr(sha, F.lit(1), F.lit(16)))


def coverage_basis_id(*named: tuple[str, Column]) -> Column:
    """Hash of the basis as JSON with sorted keys."""
    row = F.to_json(F.struct(*[c.alias(n) for n, c in sorted(named, key=lambda x: x[0])]), {"ignoreNullFields": "false"})
    return F.concat(F.lit("cb-"), F.substr(F.sha2(row, 256), F.lit(1), F.lit(16)))


def extract_boe_id(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"BOE-[A-Z]-\d{4}-\d+", 0), F.lit(""))
