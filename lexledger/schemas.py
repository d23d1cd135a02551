"""Schemas of the ledger's tables, declared so that empty tables keep their columns."""

TABLES = {
    "cases": "case_id string, authority string, title_raw string, canonical_boe_id string, sanctioning_resolution_date date, publication_resolution_date date, register_entry_date date, boe_publication_date date, administrative_finality_observed boolean, judicial_review_mentioned boolean, administrative_appeal_observed boolean, n_infringements int, n_sanctions int, n_respondents int, appeal_observation_status string, coverage_basis_id string",
    "case_status": "case_id string, firmness_status string, n_cnmv_notes int, pdf_sha256 string, first_observed_at timestamp, observed_at timestamp",
    "status_notes": "case_id string, kind string, page int, verbatim string",
    "events": "event_id string, case_id string, event_type string, event_date date, observed_at timestamp, source_document_id string, event_payload string",
    "documents": "document_id string, boe_id string, source string, corpus string, format string, title string, publication_date date, document_date date",
    "respondents": "respondent_id string, raw_display_name string, normalized_name string, respondent_type string, source_anonymized boolean, publication_policy string, role_raw string",
    "case_respondents": "case_id string, respondent_id string, role string",
    "infringements": "infringement_id string, case_id string, ordinal int, severity string, statute_raw string, article_raw string, statute_normalized string, article_normalized string, conduct_raw string, conduct_start_date date, conduct_end_date date, conduct_code string, rule_version_id string, rule_resolution_status string, n_related_provisions int",
    "related_provisions": "infringement_id string, case_id string, statute_raw string, article_raw string, statute_normalized string, article_normalized string, relation string",
    "sanctions": "sanction_id string, case_id string, respondent_id string, infringement_id string, ordinal int, sanction_type string, severity string, amount decimal(18,2), currency string, amount_raw string, duration_raw string",
    "evidence": "fact_type string, entity_id string, field_name string, document_id string, locator string, excerpt string, extraction_method string, confidence_type string, observed_at timestamp, representation string, locator_type string, artifact_sha256 string, proof_level string, raw_value string",
    "parse_issues": "boe_id string, kind string, detail string",
    "review_items": "review_id string, subject_type string, subject_id string, document_id string, raw_sha256 string, review_compat_version string, parser_version string, dataset_schema_version string, reason_code string, status string, expected_interpretation string, reviewed_value_json string, reviewed_at string, reviewer string, notes string, supersedes_review_id string",
}

# The closed vocabularies.
VOCABULARIES = {
    "severity": ["VERY_SERIOUS", "SERIOUS", "MINOR", "UNKNOWN"],
    "sanction_type": ["MONETARY_FINE", "DISGORGEMENT", "PUBLIC_REPRIMAND", "SUSPENSION", "DISQUALIFICATION", "OTHER", "UNKNOWN"],
    "respondent_type": ["LEGAL_PERSON", "NATURAL_PERSON", "ANONYMIZED_PERSON", "OTHER", "UNKNOWN"],
    "rule_resolution_status": ["VALID_FOR_CONDUCT", "UNRESOLVED_RULE_VERSION", "AMBIGUOUS_VERSION", "NO_RULE_DEFINED", "NOT_APPLICABLE"],
    "proof_level": ["DOCUMENT_BINDING_PROVEN", "LOCATION_PROVEN", "VALUE_BINDING_PROVEN"],
}
