"""Registered queries over whole tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lexledger.functions import dates, ids, legal, numbers, text
from lexledger.operators import dataflow as flow
from lexledger.operators import gates, ledger
from lexledger.plans import star

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}
T = "2024-01-15"
UNTIL = datetime(2024, 1, 15, 23, 59, 59, 999999)


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = star.sql(sql)
        return f

    return add


def on_ledger(name: str, sql: str, f) -> None:
    query(name, sql)(lambda spark, sf_dir: f(star.tables(spark, sf_dir)))


# ---- totals and groups ----------------------------------------------------------------------------------------------

on_ledger("stats_totals", """SELECT (SELECT count(*) FROM cases) AS n_cases, (SELECT count(*) FROM sanctions) AS n_sanctions, (SELECT count(*) FROM infringements) AS n_infringements,
  (SELECT count(*) FROM respondents) AS n_respondents, (SELECT CAST(sum(amount) AS VARCHAR) FROM sanctions WHERE sanction_type = 'MONETARY_FINE') AS total_fines""", ledger.stats_totals)  # fmt: skip
on_ledger("stats_by_severity", "SELECT severity, count(*) AS n FROM infringements GROUP BY severity", ledger.stats_by_severity)
on_ledger("stats_by_type", "SELECT sanction_type, count(*) AS n, CAST(sum(amount) AS VARCHAR) AS total FROM sanctions GROUP BY sanction_type", ledger.stats_by_type)
on_ledger("stats_by_statute", "SELECT statute_normalized, count(*) AS n FROM infringements GROUP BY statute_normalized", ledger.stats_by_statute)
on_ledger("sanctioned_parties_distinct", "SELECT count(DISTINCT respondent_id) AS n_parties, count(amount) AS n_amounts, count(*) AS n_sanctions FROM sanctions", ledger.sanctioned_parties)

# ---- listings, details ----------------------------------------------------------------------------------------------

on_ledger("list_cases_filtered", """SELECT c.*, s.firmness_status FROM cases c LEFT JOIN case_status s USING (case_id)
  WHERE EXISTS (SELECT 1 FROM infringements i WHERE i.case_id = c.case_id AND i.severity = 'SERIOUS')
    AND EXISTS (SELECT 1 FROM infringements i WHERE i.case_id = c.case_id AND i.statute_normalized ILIKE '%brand#1%')
    AND EXISTS (SELECT 1 FROM case_respondents cr JOIN respondents r USING (respondent_id) WHERE cr.case_id = c.case_id AND r.normalized_name ILIKE '%customer#0000000%')
  ORDER BY boe_publication_date DESC NULLS LAST, c.case_id LIMIT 100 OFFSET 5""", lambda t: ledger.list_cases(t, "SERIOUS", "brand#1", "customer#0000000", 100, 5))  # fmt: skip
on_ledger("list_cases_plain", "SELECT c.*, s.firmness_status FROM cases c LEFT JOIN case_status s USING (case_id) ORDER BY boe_publication_date DESC NULLS LAST, c.case_id LIMIT 100", ledger.list_cases)
on_ledger("case_by_alt_key", "SELECT * FROM cases WHERE case_id = 'CNMV-17' OR canonical_boe_id = 'CNMV-17'", lambda t: ledger.case_by_key(t, "CNMV-17"))
on_ledger("case_sanctions", "SELECT s.*, r.normalized_name AS respondent_name FROM sanctions s LEFT JOIN respondents r USING (respondent_id) WHERE case_id = 'CNMV-17'", lambda t: ledger.case_sanctions(t, "CNMV-17"))
on_ledger("case_detail_children", "SELECT cr.case_id, r.* FROM case_respondents cr JOIN respondents r USING (respondent_id) WHERE case_id = 'CNMV-17'", lambda t: ledger.case_people(t, "CNMV-17"))
on_ledger("case_evidence_prefix_or_in", """SELECT * FROM evidence WHERE entity_id LIKE 'CNMV-17/%' OR entity_id IN (SELECT respondent_id FROM case_respondents WHERE case_id = 'CNMV-17')""", lambda t: ledger.case_evidence(t, "CNMV-17"))
on_ledger("respondents_topk", """SELECT r.respondent_id, r.normalized_name, r.respondent_type, count(s.sanction_id) AS n_sanctions, count(DISTINCT s.case_id) AS n_cases, CAST(sum(s.amount) AS DECIMAL(38,2)) AS total_amount
  FROM respondents r LEFT JOIN sanctions s USING (respondent_id) GROUP BY 1, 2, 3 ORDER BY total_amount DESC NULLS LAST, respondent_id LIMIT 200""", ledger.respondents)  # fmt: skip
on_ledger("respondent_search_ilike", """SELECT r.respondent_id, r.normalized_name, r.respondent_type, count(s.sanction_id) AS n_sanctions, count(DISTINCT s.case_id) AS n_cases, CAST(sum(s.amount) AS DECIMAL(38,2)) AS total_amount
  FROM respondents r LEFT JOIN sanctions s USING (respondent_id) WHERE r.normalized_name ILIKE '%CUSTOMER#00000001%' GROUP BY 1, 2, 3 ORDER BY total_amount DESC NULLS LAST, respondent_id LIMIT 200""", lambda t: ledger.respondents(t, "CUSTOMER#00000001"))  # fmt: skip
on_ledger("respondent_search_lowered", """SELECT r.respondent_id, r.normalized_name, r.respondent_type, count(s.sanction_id) AS n_sanctions, count(DISTINCT s.case_id) AS n_cases, CAST(sum(s.amount) AS DECIMAL(38,2)) AS total_amount
  FROM respondents r LEFT JOIN sanctions s USING (respondent_id) WHERE contains(lower(r.normalized_name), 'r#00000002') GROUP BY 1, 2, 3 ORDER BY total_amount DESC NULLS LAST, respondent_id LIMIT 1000""", lambda t: ledger.respondent_search(t, "R#00000002"))  # fmt: skip
on_ledger("respondent_detail", "SELECT c.*, cr.respondent_id FROM cases c JOIN case_respondents cr USING (case_id) WHERE cr.respondent_id = 'RESP-7'", lambda t: ledger.respondent_cases(t, "RESP-7"))
on_ledger("laws_rollup", "SELECT statute_normalized, count(*) AS n_infringements, count(DISTINCT case_id) AS n_cases FROM infringements GROUP BY 1", ledger.laws)
on_ledger("article_lookup", "SELECT * FROM infringements WHERE statute_normalized ILIKE '%brand#2%' AND article_normalized = '11'", lambda t: ledger.article(t, "brand#2", "11"))
on_ledger("status_left_join", "SELECT c.case_id, canonical_boe_id, boe_publication_date, appeal_observation_status, firmness_status, first_observed_at, observed_at FROM cases c LEFT JOIN case_status s USING (case_id)", ledger.status)

# ---- as known at ----------------------------------------------------------------------------------------------------

LIMIT_SQL = "TIMESTAMP '2024-01-15 23:59:59.999999'"


def _observed(t):
    """The star tables with evidence for sanctions, so that visibility has something to decide."""
    s = t["sanctions"]
    shown = s.select(F.col("sanction_id").alias("entity_id"), F.lit("sanction").alias("fact_type"), F.lit("D0").alias("document_id"), (F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(F.col("ordinal") * 5)).alias("observed_at"), F.lit("x").alias("raw_value"))
    blank = lambda df, **types: df.withColumns({k: F.lit(None).cast(v) for k, v in types.items()})
    return dict(t) | {
        "evidence": t["evidence"].unionByName(shown),
        "cases": blank(t["cases"], administrative_finality_observed="boolean", coverage_basis_id="string", n_infringements="int", n_sanctions="int", n_respondents="int"),
        "status_notes": t["case_status"].select("case_id", F.lit("NOTE").alias("kind")),
    }


SHOWN = "shown AS (SELECT sanction_id AS id, TIMESTAMP '2024-01-01' + to_days(CAST(ordinal * 5 AS INTEGER)) AS at FROM sanctions)"
on_ledger("known_at_evidence", f"SELECT entity_id, count(*) AS n, max(observed_at) AS latest FROM evidence WHERE observed_at <= {LIMIT_SQL} GROUP BY 1", lambda t: ledger.as_known_at(_observed(t), dates.known_at(T))["evidence"].filter("fact_type <> 'sanction'").groupBy("entity_id").agg(F.count("*").alias("n"), F.max("observed_at").alias("latest")))
on_ledger("known_at_children_semi", f"SELECT * FROM sanctions WHERE TIMESTAMP '2024-01-01' + to_days(CAST(ordinal * 5 AS INTEGER)) <= {LIMIT_SQL}", lambda t: ledger.as_known_at(_observed(t), UNTIL)["sanctions"])
on_ledger("known_at_counts", f"""SELECT c.case_id, CAST(coalesce(n, 0) AS INTEGER) AS n_sanctions, CAST(CASE WHEN n IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n_respondents,
  CASE WHEN n IS NULL THEN 'NO_OBSERVATION_HISTORY' ELSE 'AS_KNOWN_AT' END AS history_mode
  FROM cases c LEFT JOIN (SELECT case_id, count(*) AS n FROM sanctions WHERE TIMESTAMP '2024-01-01' + to_days(CAST(ordinal * 5 AS INTEGER)) <= {LIMIT_SQL} GROUP BY 1) s USING (case_id)""",
  lambda t: ledger.as_known_at(_observed(t), UNTIL)["cases"].select("case_id", "n_sanctions", "n_respondents", "history_mode"))
on_ledger("known_at_status_scrub", "SELECT c.case_id, CASE WHEN s.observed_at <= TIMESTAMP '2024-01-29 12:00:00' THEN appeal_observation_status END AS appeal_observation_status FROM cases c LEFT JOIN case_status s USING (case_id)", lambda t: ledger.as_known_at(_observed(t), dates.known_at("2024-01-29T14:00:00+02:00"))["cases"].select("case_id", "appeal_observation_status"))

# ---- dedup, order, argmax -------------------------------------------------------------------------------------------


@query("first_wins_dedup", "SELECT doc_id, k FROM (SELECT doc_id, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS k, row_number() OVER (PARTITION BY lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def _first_wins(spark, d):
    docs = star.read(spark, d, "documents").select("doc_id", F.lower(F.trim(F.regexp_replace("text", r"\s+", " "))).alias("k"))
    return flow.first_wins(docs, ["k"], ["doc_id"])


@query("duplicate_entry_issues", "SELECT user_id, event_type, event_id, n FROM (SELECT user_id, event_type, event_id, CAST(row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS INTEGER) AS n FROM events) WHERE n > 1")
def _duplicates(spark, d):
    return flow.later_entries(star.read(spark, d, "events").withColumn("day", F.col("ts").cast("date")), ["user_id", "event_type", "day"], ["event_id"]).select("user_id", "event_type", "event_id", "n")


@query("latest_by_locator", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def _latest(spark, d):
    return flow.latest_by(star.read(spark, d, "events"), "user_id", F.col("ts"), F.col("event_id"), ["event_type", "value"])


@query("changed_locators", "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ';') AS \"values\" FROM events GROUP BY 1 HAVING count(DISTINCT event_type) > 1")
def _changed(spark, d):
    return flow.changed_locators(star.read(spark, d, "events"), "user_id", "event_type")


@query("forward_fill_statute", "SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_type || event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM events")
def _fill(spark, d):
    e = star.read(spark, d, "events").withColumn("s", F.when(F.col("event_type") == "signup", F.concat("event_type", F.col("event_id").cast("string"))))
    return flow.forward_fill(e, "user_id", ["ts", "event_id"], "s", "filled").select("event_id", "filled")


@query("running_ordinals", "SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS ordinal FROM events")
def _ordinals(spark, d):
    return flow.running_ordinal(star.read(spark, d, "events"), "user_id", ["ts", "event_id"]).select("event_id", "ordinal")


@query("context_carry", "SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, md5(text) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS context FROM conversations")
def _carry(spark, d):
    c = star.read(spark, d, "conversations").withColumn("h", F.md5("text")).withColumn("asked", F.when(F.col("role") == "user", F.col("h")))
    return flow.forward_fill(c, "conv_id", ["turn", "h"], "asked", "context").select("conv_id", "turn", "role", "context")


@query("stratified_holdout", "SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY sha256(CAST(doc_id AS VARCHAR))) <= greatest(1, ceil(0.2 * count(*) OVER (PARTITION BY lang))) AS holdout FROM documents")
def _holdout(spark, d):
    return flow.stratified_holdout(star.read(spark, d, "documents"), "lang", "doc_id").select("doc_id", "holdout")


@query("hash_mod_split", "SELECT o_orderkey, CAST('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0 AS holdout FROM orders")
def _hash_mod(spark, d):
    return star.read(spark, d, "orders").select("o_orderkey", flow.hash_mod_split(F.col("o_orderkey")).alias("holdout"))


@query("conduct_window_minmax", "SELECT user_id, min(CAST(ts AS DATE)) AS conduct_start_date, max(CAST(ts AS DATE)) AS conduct_end_date FROM events GROUP BY 1")
def _window(spark, d):
    e = star.read(spark, d, "events").groupBy("user_id").agg(F.collect_set(F.col("ts").cast("date")).alias("days"))
    return e.select("user_id", F.array_min("days").alias("conduct_start_date"), F.array_max("days").alias("conduct_end_date"))


# ---- resolution joins -----------------------------------------------------------------------------------------------

INSTRUMENTS = [
    ("A", ["LAW", "Brand#1"], "1992-01-01", "1995-06-30"), ("B", ["LAW", "Brand#2"], "1995-07-01", "1998-12-31"),
    ("C", ["LAW", "Brand#3"], "1997-01-01", None), ("D", ["CODE"], "1990-01-01", None),
]
RULES = [("a-1", "A", "1", "X"), ("a-11", "A", "1.1", "Y"), ("b-2", "B", "2", "X"), ("c-3", "C", "3.3", "Z"), ("d-4", "D", "4", "W")]
RULES_SQL = """
  instruments(family, statute, valid_from, valid_to) AS (VALUES ('A', 'LAW', DATE '1992-01-01', DATE '1995-06-30'), ('A', 'Brand#1', DATE '1992-01-01', DATE '1995-06-30'), ('B', 'LAW', DATE '1995-07-01', DATE '1998-12-31'),
    ('B', 'Brand#2', DATE '1995-07-01', DATE '1998-12-31'), ('C', 'LAW', DATE '1997-01-01', NULL), ('C', 'Brand#3', DATE '1997-01-01', NULL), ('D', 'CODE', DATE '1990-01-01', NULL)),
  rules(rule_id, family, article, conduct_code) AS (VALUES ('a-1', 'A', '1', 'X'), ('a-11', 'A', '1.1', 'Y'), ('b-2', 'B', '2', 'X'), ('c-3', 'C', '3.3', 'Z'), ('d-4', 'D', '4', 'W')),
  facts AS (SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'CODE' WHEN 1 THEN 'NONE' ELSE 'LAW' END AS statute, (1 + o_custkey % 4) || '.' || (1 + o_orderkey % 4) || '.1' AS article, CAST(o_orderdate AS DATE) AS start FROM orders),
  found AS (SELECT id, any_value(f.statute) AS statute, any_value(article) AS article, any_value(start) AS start, count(family) AS n_families, count(*) FILTER (valid_from <= start AND (valid_to IS NULL OR start <= valid_to)) AS n_cover,
    max(family) FILTER (valid_from <= start AND (valid_to IS NULL OR start <= valid_to)) AS covering FROM facts f LEFT JOIN instruments i ON f.statute = i.statute GROUP BY id),
  best AS (SELECT id, arg_max(rule_id, length(r.article)) AS rule_id FROM found JOIN rules r ON r.family = found.covering AND (found.article = r.article OR starts_with(found.article, r.article || '.')) WHERE n_cover = 1 GROUP BY id)"""


def _rules(spark, d):
    instruments = spark.createDataFrame(INSTRUMENTS, "family string, aliases array<string>, valid_from string, valid_to string").withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})
    rules = spark.createDataFrame(RULES, "rule_id string, family string, article string, conduct_code string")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    facts = star.read(spark, d, "orders").select(
        key.alias("id"), F.when(key % 4 == 0, "CODE").when(key % 4 == 1, "NONE").otherwise("LAW").alias("statute"),
        F.concat_ws(".", (1 + cust % 4).cast("string"), (1 + key % 4).cast("string"), F.lit("1")).alias("article"), F.col("o_orderdate").cast("date").alias("start"), F.col("o_orderdate").cast("date").alias("end"),
    )
    return flow.resolve_rules(facts, instruments, rules)


query("rule_interval_join", f"WITH {RULES_SQL} SELECT id, CASE WHEN n_cover = 1 THEN covering END AS family, n_families FROM found")(
    lambda spark, d: _rules(spark, d).select("id", "family", F.when(F.col("statute") == "CODE", 1).when(F.col("statute") == "LAW", 3).otherwise(0).cast("bigint").alias("n_families"))
)
query("rule_ambiguity_status", f"""WITH {RULES_SQL} SELECT CASE WHEN n_families = 0 THEN 'NO_RULE_DEFINED' WHEN n_cover > 1 THEN 'AMBIGUOUS_VERSION' WHEN n_cover = 0 THEN 'UNRESOLVED_RULE_VERSION' WHEN rule_id IS NULL THEN 'NO_RULE_DEFINED' ELSE 'VALID_FOR_CONDUCT' END AS rule_resolution_status, count(*) AS n
  FROM found LEFT JOIN best USING (id) GROUP BY 1""")(lambda spark, d: _rules(spark, d).groupBy("rule_resolution_status").agg(F.count("*").alias("n")))  # fmt: skip
query("rule_longest_prefix", f"WITH {RULES_SQL} SELECT id, rule_id AS rule_version_id FROM found LEFT JOIN best USING (id)")(lambda spark, d: _rules(spark, d).select("id", "rule_version_id"))


@query("fuzzy_title_resolve", """
WITH r AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS row_id, p_brand AS block, lower(p_name || ' ' || p_type) AS k FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT p_partkey AS cand_id, p_brand AS block, lower(p_name || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' ' || p_type END || CASE WHEN p_partkey % 2 = 0 THEN ' extra' ELSE '' END) AS k FROM part),
t AS (SELECT u.block, u.k AS rk, cand_id, c.k AS ck, len(list_intersect(list_distinct(string_split(u.k, ' ')), list_distinct(string_split(c.k, ' ')))) / len(list_distinct(list_concat(string_split(u.k, ' '), string_split(c.k, ' ')))) AS score FROM (SELECT DISTINCT block, k FROM r) u LEFT JOIN c USING (block)),
g AS (SELECT *, count(*) FILTER (rk = ck) OVER w AS n_exact, row_number() OVER (w ORDER BY score DESC NULLS LAST, cand_id) AS place, lead(score) OVER (w ORDER BY score DESC NULLS LAST, cand_id) AS second FROM t WINDOW w AS (PARTITION BY block, rk)),
s AS (SELECT block, rk, CASE WHEN n_exact = 1 OR (score >= 0.85 AND (second IS NULL OR score > second)) THEN cand_id END AS cand_id,
  CASE WHEN cand_id IS NULL THEN 'NO_DATE' WHEN n_exact = 1 THEN 'EXACT' WHEN score >= 0.85 AND (second IS NULL OR score > second) THEN 'JACCARD' ELSE 'UNRESOLVED' END AS method, round(CASE WHEN n_exact = 1 THEN 1.0 WHEN score >= 0.85 THEN score END, 6) AS score
  FROM g WHERE CASE WHEN n_exact = 1 THEN rk = ck ELSE place = 1 END)
SELECT row_id, s.cand_id, s.method, s.score FROM r JOIN s ON r.block = s.block AND r.k = s.rk""")
def _fuzzy(spark, d):
    parts = star.read(spark, d, "part")
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    rows = star.read(spark, d, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select(key.alias("row_id"), F.col("p_brand").alias("block"), F.concat_ws(" ", "p_name", "p_type").alias("title"))
    title = F.concat(F.col("p_name"), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat(F.lit(" "), F.col("p_type"))), F.when(F.col("p_partkey") % 2 == 0, " extra").otherwise(""))
    return flow.fuzzy_resolve(rows, parts.select(F.col("p_partkey").alias("cand_id"), F.col("p_brand").alias("block"), title.alias("title")), "block")


@query("positional_zip", "SELECT o_orderkey, unnest(range(3)) AS pos, unnest(['a', 'b', 'c']) AS left_item, unnest(CASE WHEN o_orderkey % 2 = 0 THEN [o_orderstatus, o_orderpriority, o_orderpriority] ELSE [o_orderstatus, o_orderstatus, o_orderstatus] END) AS right_item FROM orders")
def _zip(spark, d):
    o = star.read(spark, d, "orders").select("o_orderkey", F.array(F.lit("a"), F.lit("b"), F.lit("c")).alias("l"), F.when(F.col("o_orderkey") % 2 == 0, F.array("o_orderstatus", "o_orderpriority")).otherwise(F.array("o_orderstatus")).alias("r"))
    return flow.positional_zip(o, "l", "r").select("o_orderkey", F.col("pos").cast("bigint").alias("pos"), "left_item", "right_item")


@query("cross_expand", "SELECT o_orderkey, l AS left_item, r AS right_item FROM orders, (SELECT unnest(['x', 'y']) AS l), (SELECT unnest([1, 2, 3]) AS r)")
def _cross(spark, d):
    o = star.read(spark, d, "orders").select("o_orderkey", F.array(F.lit("x"), F.lit("y")).alias("l"), F.array(F.lit(1), F.lit(2), F.lit(3)).alias("r"))
    return flow.cross_expand(o, "l", "r").select("o_orderkey", "left_item", "right_item")


@query("count_expand", "SELECT o_orderkey, unnest(range(1, CAST(1 + o_custkey % 3 AS BIGINT) + 1)) AS copy FROM orders")
def _count(spark, d):
    return flow.count_expand(star.read(spark, d, "orders").withColumn("n", 1 + F.col("o_custkey") % 3), "n").select("o_orderkey", F.col("copy").cast("bigint").alias("copy"))


# ---- coverage, snapshots --------------------------------------------------------------------------------------------


@query("corpus_reconciliation_pivot", "SELECT lang, count(*) AS n_documents, count(*) FILTER (kind = 'GOOD') AS n_good, count(*) FILTER (kind = 'BAD') AS n_bad, count(*) FILTER (kind = 'OTHER') AS n_other FROM (SELECT lang, CASE quality WHEN 1 THEN 'GOOD' WHEN 0 THEN 'BAD' ELSE 'OTHER' END AS kind FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1")
def _reconcile(spark, d):
    docs = star.read(spark, d, "documents").select("doc_id", "lang").join(star.read(spark, d, "labels"), "doc_id", "left")
    return flow.reconciliation(docs.withColumn("kind", F.when(F.col("quality") == 1, "GOOD").when(F.col("quality") == 0, "BAD").otherwise("OTHER")), "lang", "kind", ["GOOD", "BAD", "OTHER"])


@query("history_matrix", """WITH days AS (SELECT CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m') || '-' || (user_id % 7) AS period, event_id, event_type FROM events),
  items AS (SELECT period, 'B' || event_id AS boe_id, event_type IN ('purchase', 'click') AS sanction_like, CASE event_type WHEN 'purchase' THEN 'SANCTION_PUBLICATION' WHEN 'signup' THEN 'CORRECTION' ELSE 'OTHER' END AS kind, event_id % 50 <> 7 AS here FROM days WHERE event_type <> 'error')
  SELECT period, n_days, n_errors, count(boe_id) AS n_enumerated, count(*) FILTER (kind = 'SANCTION_PUBLICATION') AS n_sanctions, count(*) FILTER (kind = 'CORRECTION') AS n_corrections, count(*) FILTER (kind = 'OTHER') AS n_other, count(*) FILTER (here) AS n_downloaded,
  count(*) FILTER (sanction_like AND NOT here) AS n_failed, sha256(coalesce(string_agg(boe_id, chr(10) ORDER BY boe_id), '')) AS identifiers_sha256,
  CASE WHEN count(*) FILTER (kind = 'SANCTION_PUBLICATION') = 0 OR count(*) FILTER (sanction_like AND NOT here) = 0 THEN 'REPRODUCIBLY_ENUMERATED' ELSE 'PARTIAL' END AS status
  FROM (SELECT period, count(DISTINCT day) AS n_days, count(DISTINCT CASE WHEN event_type = 'error' THEN day END) AS n_errors FROM days GROUP BY 1) LEFT JOIN items USING (period) GROUP BY 1, 2, 3""")
def _matrix(spark, d):
    kind, error = F.col("event_type"), F.col("event_type") == "error"
    e = star.read(spark, d, "events").select(F.concat_ws("-", F.date_format("ts", "yyyy-MM"), (F.col("user_id") % 7).cast("string")).alias("period"), F.col("ts").cast("date").alias("day"), F.concat(F.lit("B"), F.col("event_id").cast("string")).alias("boe_id"), "event_id", "event_type")
    item = F.when(~error, F.struct("boe_id", F.when(kind == "purchase", "SANCTION_PUBLICATION").when(kind == "signup", "CORRECTION").otherwise("OTHER").alias("kind"), kind.isin("purchase", "click").alias("sanction_like")))
    days = e.groupBy("period", "day").agg(F.collect_list(item).alias("items"), F.max(F.when(error, "failed")).alias("error"))
    return flow.history_matrix(days, e.filter("event_id % 50 <> 7").select("period", "boe_id"))


@query("appeal_status_from_notes", """SELECT user_id, CASE WHEN retrieval <> 'OK' THEN 'INCONCLUSIVE' WHEN list_has_any(kinds, ['APPEAL_NOTICE', 'JUDGMENT']) THEN 'OBSERVED' ELSE 'NOT_OBSERVED_WITHIN_VERIFIED_COVERAGE' END AS status FROM
  (SELECT user_id, list(DISTINCT CASE event_type WHEN 'purchase' THEN CASE WHEN value > 30 THEN 'JUDGMENT' ELSE 'OTHER' END ELSE 'OTHER' END) AS kinds, CASE WHEN count(*) FILTER (event_type = 'error') > 16 THEN 'FETCH_FAILED' ELSE 'OK' END AS retrieval FROM events GROUP BY 1)""")  # fmt: skip
def _appeal(spark, d):
    kind = F.when((F.col("event_type") == "purchase") & (F.col("value") > 30), "JUDGMENT").otherwise("OTHER")
    e = star.read(spark, d, "events").groupBy("user_id").agg(F.collect_set(kind).alias("kinds"), F.when(F.count_if(F.col("event_type") == "error") > 16, "FETCH_FAILED").otherwise("OK").alias("retrieval"))
    return e.select("user_id", legal.appeal_status(F.col("retrieval"), F.col("kinds")).alias("status"))


STATES = {"signup": "UNKNOWN", "view": "FIRM_STATED", "click": "RENUNCIATION_OBSERVED", "purchase": "APPEAL_OBSERVED", "error": "ANNULMENT_OBSERVED"}


@query("firmness_rank_max", """SELECT user_id, arg_max(s, r) AS firmness_status, array_to_string(list_sort(list(CAST(event_id AS VARCHAR))), ';') AS basis FROM (SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN 'UNKNOWN' WHEN 'view' THEN 'FIRM_STATED' WHEN 'click' THEN 'RENUNCIATION_OBSERVED' WHEN 'purchase' THEN 'APPEAL_OBSERVED' ELSE 'ANNULMENT_OBSERVED' END AS s,
  CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 5 END AS r FROM events) GROUP BY 1""")  # fmt: skip
def _firmness(spark, d):
    return flow.project_status(star.read(spark, d, "events").withColumn("s", star._pick("event_type", STATES)), "user_id", "s", "event_id")


def _snapshot(spark, d, days: str):
    e = star.read(spark, d, "events").filter(days)
    return e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("sha256"), F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("notes"), F.min("ts").alias("first_observed_at"), F.max("ts").alias("observed_at"))


SNAP = "(SELECT user_id, arg_max(event_type, (ts, event_id)) AS sha256, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS notes, min(ts) AS f, max(ts) AS o FROM events WHERE {} GROUP BY 1)"
DIFF = f"""SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN a.o IS NULL THEN 'NEW' WHEN b.o IS NULL THEN 'GONE' WHEN a.notes IS DISTINCT FROM b.notes THEN 'CHANGED-NOTES' WHEN a.sha256 IS DISTINCT FROM b.sha256 THEN 'CHANGED-BYTES' ELSE 'SAME' END AS change, {{}}
  FROM {SNAP.format("ts < TIMESTAMP '2024-01-15'")} a FULL OUTER JOIN {SNAP.format("ts >= TIMESTAMP '2024-01-15'")} b ON a.user_id = b.user_id"""
BEFORE, AFTER = "ts < timestamp_ntz'2024-01-15 00:00:00'", "ts >= timestamp_ntz'2024-01-15 00:00:00'"
query("snapshot_diff", DIFF.format("coalesce(b.o, a.o) AS observed_at"))(lambda spark, d: flow.snapshot_diff(_snapshot(spark, d, BEFORE), _snapshot(spark, d, AFTER), "user_id").select("user_id", "change", "observed_at"))
query("first_observed_carry", DIFF.format("coalesce(a.f, b.o) AS first_observed_at"))(lambda spark, d: flow.snapshot_diff(_snapshot(spark, d, BEFORE), _snapshot(spark, d, AFTER), "user_id").select("user_id", "change", "first_observed_at"))


@query("resume_missing_dates", "SELECT CAST(g AS DATE) AS day FROM generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-05', INTERVAL 1 DAY) t(g) WHERE CAST(g AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE event_type <> 'error')")
def _resume(spark, d):
    done = star.read(spark, d, "events").filter("event_type <> 'error'").select(F.col("ts").cast("date").alias("day")).distinct()
    return flow.missing_days(done, "day", "2023-12-25", "2024-02-05")


@query("append_only_new", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 13 = 0)")
def _append(spark, d):
    return flow.append_new(star.read(spark, d, "orders").filter("o_orderkey % 13 = 0").withColumnRenamed("o_custkey", "c_custkey"), star.read(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("staleness_apply", "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL OR d.doc_id % 7 = 0 OR d.doc_id % 5 <> l.quality + 1 THEN 'STALE' ELSE 'OPEN' END AS status FROM documents d LEFT JOIN labels l USING (doc_id)")
def _stale(spark, d):
    items = star.read(spark, d, "documents").select("doc_id", F.col("doc_id").alias("document_id"), (F.col("doc_id") % 5).cast("string").alias("raw_sha256"), F.when(F.col("doc_id") % 7 == 0, "1").otherwise("2").alias("review_compat_version"), F.lit("OPEN").alias("status"), F.lit(None).cast("string").alias("notes"))
    now = star.read(spark, d, "labels").select(F.col("doc_id").alias("document_id"), (F.col("quality") + 1).cast("string").alias("sha256"))
    return flow.apply_staleness(items, now, "2").select("doc_id", "status")


@query("ledger_orphans", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _orphans(spark, d):
    return star.read(spark, d, "documents").select("doc_id").join(star.read(spark, d, "labels"), "doc_id", "left_anti")


# ---- scalar functions -----------------------------------------------------------------------------------------------


@query("parse_es_number", """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS a, CAST(o_totalprice AS DECIMAL(18,2)) AS b, CAST(floor(o_totalprice) AS DECIMAL(18,2)) AS c FROM orders""")
def _numbers(spark, d):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    dotted = F.translate(F.format_number(price, 2), ",.", ".,")
    return star.read(spark, d, "orders").select("o_orderkey", numbers.es_number(dotted).alias("a"), numbers.es_number(F.when(price >= 1000, F.translate(dotted, ",", ".")).otherwise(dotted)).alias("b"), numbers.es_number(F.split(dotted, ",")[0]).alias("c"))


# Number words and what they count.
UNITS = [("dos", 2), ("tres", 3), ("siete", 7), ("diez", 10), ("quince", 15), ("veintitrés", 23), ("treinta y cinco", 35), ("cien", 100), ("quinientos", 500), ("quinientos cincuenta", 550)]
SCALES = [("", 1), (" mil", 10**3), (" millones", 10**6), (" mil millones", 10**9)]


def _case(by: str, values: list) -> str:
    return f"CASE {by} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _pick(by, values: list):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (by + 1).cast("int"))


@query("spanish_words_to_int", f"SELECT o_orderkey, CAST({_case('o_orderkey % 10', [n for _, n in UNITS])} * CAST({_case('o_orderkey // 10 % 4', [n for _, n in SCALES])} AS BIGINT) AS BIGINT) AS n FROM orders")
def _words(spark, d):
    k = F.col("o_orderkey")
    words = F.concat(_pick(k % 10, [w for w, _ in UNITS]), _pick(F.floor(k / 10) % 4, [w for w, _ in SCALES]))
    return star.read(spark, d, "orders").select("o_orderkey", numbers.words_to_int(words).cast("bigint").alias("n"))


@query("parse_dates_multi", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) AS b, CAST(o_orderdate AS DATE) AS c, CAST(NULL AS DATE) AS bad FROM orders")
def _dates(spark, d):
    names = F.array(*[F.lit(m) for m in ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")])
    day = F.col("o_orderdate").cast("date")
    long = F.concat(F.lit("Resolución de "), F.dayofmonth(day).cast("string"), F.lit(" de "), F.element_at(names, F.month(day)), F.lit(" de "), F.year(day).cast("string"), F.lit(", firme"))
    return star.read(spark, d, "orders").select("o_orderkey", dates.long_es(long).alias("a"), dates.slash_es(F.date_format(day, "dd/MM/yyyy")).alias("b"), dates.compact(F.date_format(day, "yyyyMMdd")).alias("c"), dates.any_es(F.lit("31/02/2020")).alias("bad"))


query("collapse_ws", "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS h FROM documents")(lambda spark, d: star.read(spark, d, "documents").select("doc_id", F.md5(F.trim(F.regexp_replace("text", r"\s+", " "))).alias("h")))
query("strip_accents_key", "SELECT doc_id, md5(lower(trim(regexp_replace(strip_accents(text), '\\s+', ' ', 'g')))) AS h FROM documents")(lambda spark, d: star.read(spark, d, "documents").select("doc_id", F.md5(text.normalize_key(F.col("text"))).alias("h")))
query("title_key", "SELECT item_id, md5(rtrim(lower(trim(regexp_replace(strip_accents(text), '\\s+', ' ', 'g'))), '.')) AS h FROM benchmark")(lambda spark, d: star.read(spark, d, "benchmark").select("item_id", F.md5(text.title_key(F.concat(F.col("text"), F.lit(" (BOE de 3 de mayo de 2020)")))).alias("h")))

ARTICLES = [("93.a)", "93.a"), ("94 bis", "94.bis"), ("13.2", "13.2"), ("94.o)", "94.o"), ("99, letra o)", "99.o"), ("83 ter 1", "83.ter.1"), ("107 quáter 3.c", "107.quater.3.c"), ("99 z ter", "99.z.ter"), ("99, letra z) bis", "99.z.bis"), ("sin artículo", None)]
STATUTES = [("Ley 22/2014, de 12 de noviembre, por la que se regulan", "Ley 22/2014"), ("el Real Decreto Legislativo 4/2015, de 23 de octubre", "Real Decreto Legislativo 4/2015"), ("Reglamento (UE) nº 596/2014", "Reglamento (UE) 596/2014"), ("la Ley del Mercado de Valores", "Ley del Mercado de Valores"), ("la LMV", "Ley del Mercado de Valores"), ("Circular 3/1997", "Circular 3/1997"), ("Ley 24/1988 y el Reglamento (UE) 596/2014", "Reglamento (UE) 596/2014"), ("otra cosa", None)]
SEVERITIES = [("una infracción muy grave tipificada en el artículo 99", "VERY_SERIOUS"), ("de una infracción grave", "SERIOUS"), ("infracción leve", "MINOR"), ("infracción continuada, tipificada como grave en", "SERIOUS"), ("nada", "UNKNOWN")]
SUBJECTS = [("Gestora Ejemplo, SGIIC, S.A.", "LEGAL_PERSON"), ("don Nombre Apellido", "NATURAL_PERSON"), ("persona anónima", "ANONYMIZED_PERSON"), ("alguien", "UNKNOWN")]


def _scalar(name: str, rows, out: str, f) -> None:
    """A scalar over a text for each order, by its key."""
    q = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
    query(name, f"SELECT o_orderkey, {_case(f'o_orderkey % {len(rows)}', [q(b) for _, b in rows])} AS {out} FROM orders")(
        lambda spark, d: star.read(spark, d, "orders").select("o_orderkey", f(F.concat(_pick(F.col("o_orderkey") % len(rows), [a for a, _ in rows]), F.lit(""))).alias(out))
    )


_scalar("normalize_article", ARTICLES, "article", legal.normalize_article)
_scalar("normalize_statute", STATUTES, "statute", legal.normalize_statute)
_scalar("severity_case", SEVERITIES, "severity", legal.severity)
_scalar("subject_class", SUBJECTS, "kind", legal.respondent_type)

query("content_hash_ids", "SELECT o_orderkey, 'RESP-' || substr(sha256(o_custkey || '|' || o_orderstatus), 1, 16) AS respondent_id, 'CNMV-REG-' || substr(sha256(o_orderpriority || '||' || o_orderkey), 1, 16) AS case_id FROM orders")(
    lambda spark, d: star.read(spark, d, "orders").select("o_orderkey", ids.respondent_id(F.col("o_custkey"), F.col("o_orderstatus")).alias("respondent_id"), ids.case_id(F.lit(None), F.col("o_orderpriority"), F.lit(None), F.col("o_orderkey")).alias("case_id"))
)
query("review_ids", "SELECT c_custkey, 'RV-' || substr(sha256(c_custkey || '|' || c_name || '|' || c_mktsegment || '|' || c_nationkey || '|'), 1, 16) AS review_id FROM customer")(
    lambda spark, d: star.read(spark, d, "customer").select("c_custkey", ids.review_id(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey"), F.lit(None)).alias("review_id"))
)
query("coverage_basis_ids", """SELECT c_custkey, 'cb-' || substr(sha256('{"nation":' || c_nationkey || ',"segment":"' || c_mktsegment || '"}'), 1, 16) AS basis FROM customer""")(
    lambda spark, d: star.read(spark, d, "customer").select("c_custkey", ids.coverage_basis_id(("segment", F.col("c_mktsegment")), ("nation", F.col("c_nationkey"))).alias("basis"))
)


@query("evidence_proof_level", """SELECT doc_id, CASE WHEN p IS NOT NULL AND (contains(p, substr(e, 1, 200)) OR contains(e, p)) THEN CASE WHEN contains(e, v) AND contains(p, v) THEN 'VALUE_BINDING_PROVEN' ELSE 'LOCATION_PROVEN' END ELSE 'DOCUMENT_BINDING_PROVEN' END AS level FROM
  (SELECT doc_id, trim(regexp_replace(substr(text, 20, 60), '\\s+', ' ', 'g')) AS e, trim(regexp_replace(CASE WHEN doc_id % 3 = 0 THEN upper(text) ELSE text END, '\\s+', ' ', 'g')) AS p, lang AS v FROM documents)""")  # fmt: skip
def _proof(spark, d):
    docs = star.read(spark, d, "documents")
    para = F.when(F.col("doc_id") % 3 == 0, F.upper("text")).otherwise(F.col("text"))
    return docs.select("doc_id", flow.proof_level(F.substr("text", F.lit(20), F.lit(60)), F.col("lang"), para, F.lit("s"), F.lit("s")).alias("level"))


# ---- semi-structured ------------------------------------------------------------------------------------------------

query("html_link_count", "SELECT page_id, len(regexp_extract_all(html, '<a\\s[^>]*href=')) AS n_links, len(regexp_extract_all(html, '<p[\\s>]')) AS n_paragraphs FROM pages")(
    lambda spark, d: star.read(spark, d, "pages").select("page_id", F.size(F.regexp_extract_all("html", F.lit(r"<a\s[^>]*href="), F.lit(0))).cast("bigint").alias("n_links"), F.size(F.regexp_extract_all("html", F.lit(r"<p[\s>]"), F.lit(0))).cast("bigint").alias("n_paragraphs"))
)
query("register_rows_from_html", "SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS link FROM pages")(
    lambda spark, d: star.read(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))).alias("link"))
)
query("json_payload_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")(lambda spark, d: star.read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")))
query("notes_regex_explode", "SELECT doc_id, pos - 1 AS pos, m AS verbatim FROM (SELECT doc_id, unnest(range(1, len(ms) + 1)) AS pos, unnest(ms) AS m FROM (SELECT doc_id, regexp_extract_all(text, '[0-9]{3,}') AS ms FROM documents))")(
    lambda spark, d: star.read(spark, d, "documents").select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit("[0-9]{3,}"), F.lit(0))).alias("pos", "verbatim")).withColumn("pos", F.col("pos").cast("bigint"))
)


@query(
    "sumario_dual_shape",
    """SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'new' ELSE 'old' END AS shape, CASE WHEN n_nationkey % 2 = 0 THEN 'A-' ELSE 'B-' END || n_nationkey || '-' || i AS identificador, n_name || ' ' || i AS titulo
       FROM nation, (VALUES (1), (2)) t(i)""",
)
def _sumario(spark, d):
    """A summary for each nation, in the new and the old nesting shape by turns."""
    from lexledger.sources.readers import sumario_items

    new = '{"data":{"sumario":{"diario":{"seccion":[{"codigo":"3","departamento":{"codigo":"1040","epigrafe":[{"nombre":"E","item":[{"identificador":"A-#-1","titulo":"@ 1"},{"identificador":"A-#-2","titulo":{"texto":"@ 2"}}]}]}}]}}}}'
    old = '{"data":{"sumario":{"diario":[{"seccion":{"codigo":"3","departamento":[{"codigo":"1040","item":{"identificador":"B-#-1","titulo":"@ 1"}},{"codigo":"1040","item":[{"identificador":"B-#-2","titulo":"@ 2"}]}]}}]}}}'
    even = F.col("n_nationkey") % 2 == 0
    filled = F.replace(F.replace(F.when(even, new).otherwise(old), F.lit("#"), F.col("n_nationkey").cast("string")), F.lit("@"), F.col("n_name"))
    return sumario_items(star.read(spark, d, "nation").select(F.when(even, "new").otherwise("old").alias("shape"), filled.alias("payload")), "payload").select("shape", "identificador", "titulo")


# ---- gates and identity ---------------------------------------------------------------------------------------------


def _gates(spark, d):
    o, li, c, e = (star.read(spark, d, x) for x in ("orders", "lineitem", "customer", "events"))
    rows = [
        gates.gate("fk_case", li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")), gates.gate("fk_respondent", o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_anti")),
        gates.gate("unique_line", li.groupBy("l_orderkey", "l_linenumber").count().filter("count > 1")), gates.gate("null_date", o.filter("o_orderdate IS NULL")),
        gates.gate("temporal", li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).filter("l_shipdate < o_orderdate")), gates.gate("money", li.filter(F.col("l_extendedprice").cast("decimal(18,2)") <= 0)),
        gates.gate("evidence", c.join(e, F.col("c_custkey") == F.col("user_id"), "left_anti")), gates.gate("future_leak", e.filter("ts > timestamp_ntz'2024-01-20 00:00:00'")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out


query("gate_violations", """SELECT gate, n_violations, n_violations = 0 AS ok FROM (
  SELECT 'fk_case' AS gate, count(*) AS n_violations FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'fk_respondent', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'unique_line', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'null_date', count(*) FROM orders WHERE o_orderdate IS NULL
  UNION ALL SELECT 'temporal', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate UNION ALL SELECT 'money', count(*) FROM lineitem WHERE CAST(l_extendedprice AS DECIMAL(18,2)) <= 0
  UNION ALL SELECT 'evidence', count(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events) UNION ALL SELECT 'future_leak', count(*) FROM events WHERE ts > TIMESTAMP '2024-01-20')""")(_gates)  # fmt: skip
query("logical_row_hash", """SELECT sha256(string_agg(j, chr(10) ORDER BY j) || chr(10)) AS logical_sha256, count(*) AS n_rows FROM (SELECT '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}' AS j FROM nation)""")(
    lambda spark, d: flow.logical_hash(star.read(spark, d, "nation"))
)
query("schema_fingerprint", "SELECT substr(sha256('r_regionkey:int;r_name:string'), 1, 16) AS fingerprint")(lambda spark, d: spark.createDataFrame([(flow.schema_fingerprint(star.read(spark, d, "region")),)], "fingerprint string"))


# ---- grammar and streams --------------------------------------------------------------------------------------------


def _publications(spark, d):
    """A publication for each order, so that the grammar runs at the table's scale."""
    o = star.read(spark, d, "orders")
    kind = F.when(F.col("o_orderkey") % 3 == 0, "muy grave").otherwise("grave")
    euros = F.translate(F.format_number(F.floor("o_totalprice"), 0), ",", ".")
    act = F.format_string("Imponer a Sociedad %d, S.A., por la comisión de una infracción %s tipificada en el artículo 99, letra o), de la Ley 24/1988, de 28 de julio, por no comunicar el día 3 de marzo de 2007 sus operaciones, una multa por importe de %s euros.", F.col("o_custkey"), kind, euros)
    xml = F.format_string("<documento><metadatos><identificador>BOE-A-2008-%d</identificador><titulo>Resolución por la que se publica la sanción</titulo><fecha_publicacion>20080110</fecha_publicacion><fecha_disposicion>20080102</fecha_disposicion></metadatos><texto><p class=\"parrafo\">Resolución de fecha 12 de diciembre de 2007, firme en vía administrativa:</p><p class=\"parrafo_2\">%s</p></texto></documento>", F.col("o_orderkey"), act)
    return o.select(F.lit("star").alias("corpus"), F.concat(F.lit("/star/BOE-A-2008-"), F.col("o_orderkey").cast("string"), F.lit(".xml")).alias("path"), F.concat(F.lit("BOE-A-2008-"), F.col("o_orderkey").cast("string")).alias("boe_id"), F.encode(xml, "UTF-8").alias("content"))


@query("xml_parse_documents", "SELECT 'BOE-A-2008-' || o_orderkey AS boe_id, CASE WHEN o_orderkey % 3 = 0 THEN 'VERY_SERIOUS' ELSE 'SERIOUS' END AS severity, 'Ley 24/1988' AS statute, '99.o' AS article, DATE '2007-03-03' AS conduct_start, CAST(floor(o_totalprice) AS DECIMAL(18,2)) AS amount, 'Sociedad ' || o_custkey || ', S.A' AS subject, DATE '2007-12-12' AS resolution FROM orders")
def _parse(spark, d):
    from lexledger.grammar.udf import parse_publications

    p = parse_publications(_publications(spark, d)).select("publication.*")
    one = p.select("boe_id", F.col("sanctioning_resolution_date").cast("date").alias("resolution"), F.explode("blocks").alias("b")).select("boe_id", "resolution", "b.*")
    return one.select("boe_id", "severity", "statute", "article", F.col("conduct_start").cast("date").alias("conduct_start"), F.col("sanctions")[0]["amount"].alias("amount"), F.rtrim(F.col("sanctions")[0]["subject"], F.lit(".")).alias("subject"), "resolution")


@query("assemble_tables", "SELECT 'cases' AS t, count(*) AS n FROM orders UNION ALL SELECT 'sanctions', count(*) FROM orders UNION ALL SELECT 'infringements', count(*) FROM orders UNION ALL SELECT 'respondents', count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'evidence', 7 * count(*) FROM orders UNION ALL SELECT 'events', 3 * count(*) FROM orders UNION ALL SELECT 'parse_issues', 0")
def _assemble(spark, d):
    from lexledger.plans.assembly import assemble, parsed_corpus

    corpus = _publications(spark, d)
    t = assemble(parsed_corpus(corpus), corpus, UNTIL)
    out = None
    for name in ("cases", "sanctions", "infringements", "respondents", "evidence", "events", "parse_issues"):
        one = t[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
        out = one if out is None else out.union(one)
    return out


@query("streaming_first_seen", "SELECT DISTINCT user_id, event_type FROM events")
def _stream(spark, d):
    from lexledger.streaming.incremental import first_seen

    schema = star.read(spark, d, "events").schema
    return first_seen(spark, spark.readStream.schema(schema).parquet(f"{d}/events.parq*"), ["user_id", "event_type"])


def _looks(spark, d, folder, parts):
    """Events as looks at their user, as a stream of the parts (thirds of the time) that lie in the folder."""
    e = star.read(spark, d, "events").select("user_id", F.col("event_type").alias("sha256"), F.col("ts").cast("timestamp").alias("observed_at"))
    span = e.agg(F.min("observed_at").alias("low"), F.max("observed_at").alias("high"))
    third = F.least(F.lit(2), F.floor(3 * (F.col("observed_at").cast("double") - F.col("low").cast("double")) / (F.col("high").cast("double") - F.col("low").cast("double"))))
    each = e.join(F.broadcast(span)).withColumn("part", third).select(*e.columns, "part")
    for p in parts:
        each.filter(F.col("part") == p).drop("part").coalesce(1).write.mode("append").parquet(f"{folder}/looks")
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/looks")


@query(
    "streaming_observed_state",
    """SELECT user_id, arg_max(event_type, (ts, event_type)) AS sha256, min(ts) AS first_observed_at, max(ts) AS observed_at, count(*) FILTER (event_type <> before) AS changes
       FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS before FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL) GROUP BY 1""",
)
def _observed_state(spark, d):
    """Three batches in two runs on one folder: the second run goes on from the first one's state."""
    from lexledger.streaming.incremental import state_dir
    from lexledger.streaming.observation import observe_stream

    folder = state_dir(spark)
    for parts in ((0, 1), (2,)):
        out = observe_stream(spark, _looks(spark, d, folder, parts), "user_id", folder)
    return out.select("user_id", "sha256", F.col("first_observed_at").cast("timestamp_ntz").alias("first_observed_at"), F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "changes")


@query(
    "resumed_enumeration",
    """WITH bounds AS (SELECT min(o_orderdate)::DATE AS low, max(o_orderdate)::DATE AS high FROM orders),
            days AS (SELECT unnest(generate_series(low, high, INTERVAL 1 DAY))::DATE AS day FROM bounds),
            n AS (SELECT o_orderdate::DATE AS day, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1)
       SELECT day, coalesce(n, 0)::INTEGER AS n_items, 'A-' || first AS first_id, (CASE WHEN extract(day FROM day) = 13 AND (day - low) // 500 < (DATE '1995-01-01' - low) // 500 THEN 2 ELSE 1 END)::BIGINT AS attempts, CAST(NULL AS VARCHAR) AS error
       FROM days CROSS JOIN bounds LEFT JOIN n USING (day)""",
)
def _enumerated(spark, d):
    """Daily summaries of orders, enumerated in two runs: in the first, every 13th of a month fails and the run dies in the batch of 1995;
    the second, on the same folder, goes on there and looks at the failed days again."""
    from pyspark.errors import StreamingQueryException

    from lexledger.streaming.enumeration import enumerate_days, summaries_in
    from lexledger.streaming.incremental import state_dir

    o = star.read(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    item = F.to_json(F.struct(F.format_string("A-%d", "o_orderkey").alias("identificador"), F.lit("Resolución de sanción").alias("titulo")))
    head, tail = '{"data":{"sumario":{"diario":[{"seccion":{"codigo":"3","departamento":{"codigo":"1040","item":[', "]}}}]}}}"
    table = o.groupBy("day").agg(F.concat(F.lit(head), F.array_join(F.collect_list(item), ","), F.lit(tail)).alias("payload")).withColumn("error", F.lit(None).cast("string"))
    low, high = o.agg(F.min("day").cast("string"), F.max("day").cast("string")).first()
    folder = state_dir(spark)

    def unreliable(days):
        if days.filter("year(day) >= 1995").limit(1).count():
            raise ConnectionError("the source went away")
        bad = F.dayofmonth("day") == 13
        return days.join(table, "day", "left").select("day", F.when(~bad, F.col("payload")).alias("payload"), F.when(bad, "status 503").alias("error"))

    try:
        enumerate_days(spark, low, high, unreliable, folder, batch_days=500, split_days=100)
    except StreamingQueryException:
        pass
    out = enumerate_days(spark, low, high, summaries_in(table), folder, batch_days=500, split_days=100)
    first = F.array_min(F.transform("items", lambda i: F.substr(i["boe_id"], F.lit(3)).cast("bigint")))
    # A failed day of the first run is looked at twice; days of the batch that died, and later ones, only once.
    return out.select("day", F.size("items").alias("n_items"), F.concat(F.lit("A-"), first.cast("string")).alias("first_id"), "attempts", "error")


from lexledger.plans import corpus  # noqa: E402

corpus.add(query)
