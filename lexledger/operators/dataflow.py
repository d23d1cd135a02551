"""Dataflow operators: resolution joins, ordered operators, diffs, proofs, coverage, hashes."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexledger.functions.ids import review_id
from lexledger.functions.text import title_key, tokens

# ---- joins ----------------------------------------------------------------------------------------------------------


def resolve_rules(facts: DataFrame, instruments: DataFrame, rules: DataFrame) -> DataFrame:
    """Facts (id, statute, article, start, end) with rule_version_id, conduct_code and rule_resolution_status.

    An alias may name several instruments; the conduct window chooses. Exactly one covering instrument resolves, none
    is UNRESOLVED_RULE_VERSION, several are AMBIGUOUS_VERSION; within it the longest article prefix with a rule wins,
    and NO_RULE_DEFINED if there is none. Without a window an alias of a single instrument still resolves. The two
    dimension tables are small: each is broadcast, a row for each alias and each family, so facts stay where they are and
    keep whatever columns they have besides."""
    alias = instruments.filter("family IS NOT NULL").select(F.explode("aliases").alias("statute"), F.struct("family", "valid_from", "valid_to").alias("i")).groupBy("statute").agg(F.collect_list("i").alias("_named"))
    covers = lambda i: F.col("start").isNotNull() & (i["valid_from"] <= F.col("start")) & (i["valid_to"].isNull() | (F.coalesce("end", "start") <= i["valid_to"]))
    many = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c))
    found = facts.join(F.broadcast(alias), "statute", "left").withColumn("_covering", F.filter("_named", covers))
    found = found.withColumns({"n_families": many("_named"), "n_cover": many("_covering")})
    family = F.when(F.col("n_families") == 1, F.when(F.col("start").isNull() | (F.col("n_cover") == 1), F.get("_named", F.lit(0))["family"])).when(F.col("n_cover") == 1, F.get("_covering", F.lit(0))["family"])
    of_family = rules.groupBy("family").agg(F.collect_list(F.struct("article", "rule_id", "conduct_code")).alias("_rules"))
    out = found.withColumn("family", family).join(F.broadcast(of_family), "family", "left")
    prefixes = F.filter("_rules", lambda r: (r["article"] == F.col("article")) | F.startswith(F.col("article"), F.concat(r["article"], F.lit("."))))
    best = F.array_max(F.transform(prefixes, lambda r: F.struct(F.length(r["article"]).alias("n"), r["rule_id"].alias("rule_id"), r["conduct_code"].alias("conduct_code"))))
    out = out.withColumn("_best", best).withColumns({"rule_id": F.col("_best.rule_id"), "conduct_code": F.col("_best.conduct_code")})
    label = (
        F.when(F.col("statute").isNull(), "NOT_APPLICABLE")
        .when(F.col("n_families") == 0, "NO_RULE_DEFINED")
        .when(F.col("n_cover") > 1, "AMBIGUOUS_VERSION")
        .when(F.col("family").isNull(), F.when(F.col("start").isNull(), "AMBIGUOUS_VERSION").otherwise("UNRESOLVED_RULE_VERSION"))
        .when(F.col("rule_id").isNull(), "NO_RULE_DEFINED")
        .otherwise("VALID_FOR_CONDUCT")
    )
    return out.select(*facts.columns, "family", F.when(label == "VALID_FOR_CONDUCT", F.col("rule_id")).alias("rule_version_id"), "conduct_code", label.alias("rule_resolution_status"))


def longest_prefix(df: DataFrame, rules: DataFrame, keys: list[str], article: str) -> DataFrame:
    """Rows of df (id, keys, article) with the rule of their longest dotted prefix: prefixes explode to an equi-join."""
    parts = F.split(article, r"\.")
    prefix = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))).alias("prefix")
    each = df.filter(F.col(article).isNotNull()).select("id", *keys, prefix)
    r = rules.select(*keys, F.col("article").alias("prefix"), "rule_id", "conduct_code")
    best = each.join(r, [*keys, "prefix"]).groupBy("id").agg(F.max_by(F.struct("rule_id", "conduct_code"), F.length("prefix")).alias("best"))
    return best.select("id", "best.*")


def fuzzy_resolve(rows: DataFrame, candidates: DataFrame, block: str, least: float = 0.85) -> DataFrame:
    """Rows (row_id, block, title) matched to candidates (cand_id, block, title) of the same block.

    Exactly one equal title key is EXACT; else the best token Jaccard of at least ``least``, strictly above the second,
    is JACCARD; rows without candidates are NO_DATE, all others UNRESOLVED, with the score of JACCARD only where a
    candidate reaches ``least``.

    Titles are compared once each, however many rows have them: equal keys by an equi-join, the others by a prefix
    filter. Of two token sets of at least that similarity, each has among its 1 + floor((1 - least) * size) rarest tokens
    one that the other has among its own, so candidates meet in an equi-join on rare tokens, not all with all."""
    r = rows.select("row_id", F.col(block).alias("block"), title_key(F.col("title")).alias("row_key"))
    c = candidates.select("cand_id", F.col(block).alias("block"), title_key(F.col("title")).alias("cand_key"))
    blocks = c.select("block").distinct().withColumn("has", F.lit(True))
    keys = c.groupBy("block", F.col("cand_key").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min("cand_id").alias("cand_id"))
    titles = r.select("block", F.col("row_key").alias("key")).distinct().join(keys.select("block", "key", F.col("n").alias("n_equal"), F.col("cand_id").alias("equal_id")), ["block", "key"], "left")
    open_ = titles.filter(F.coalesce("n_equal", F.lit(0)) != 1).select("block", "key")

    def rare(df: DataFrame, frequency: DataFrame) -> DataFrame:
        """(block, key, size, toks, token): a row for each token of a title's rare prefix."""
        one = df.select("block", "key", tokens(F.col("key")).alias("toks"))
        each = one.select("block", "key", "toks", F.explode("toks").alias("token")).join(frequency, ["block", "token"], "left")
        ranked = each.groupBy("block", "key").agg(F.first("toks").alias("toks"), F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "token"))).alias("order"))
        prefix = F.slice("order", F.lit(1), (F.floor(F.size("toks") * (1 - least) + 1e-9) + 1).cast("int"))
        return ranked.select("block", "key", "toks", F.explode(prefix).alias("o")).select("block", "key", "toks", F.col("o.token").alias("token"))

    frequency = keys.select("block", F.explode(tokens(F.col("key"))).alias("token")).groupBy("block", "token").agg(F.count(F.lit(1)).alias("f"))
    left = rare(open_, frequency).select("block", "key", F.col("toks").alias("a"), "token")
    right = rare(keys.select("block", "key"), frequency).select("block", F.col("key").alias("cand_key"), F.col("toks").alias("b"), "token")
    pairs = left.join(right, ["block", "token"]).filter(F.least(F.size("a"), F.size("b")) >= least * F.greatest(F.size("a"), F.size("b")) - 1e-9).drop("token").distinct()
    both = F.size(F.array_intersect("a", "b"))
    scored = pairs.select("block", "key", "cand_key", (both / (F.size("a") + F.size("b") - both)).alias("score")).filter(F.col("score") >= least)
    scored = scored.join(keys.select("block", F.col("key").alias("cand_key"), "n", "cand_id"), ["block", "cand_key"])
    # A title that several candidates have, or another title of the same score, leaves no strict winner.
    level = scored.groupBy("block", "key", "score").agg(F.sum("n").alias("n"), F.min("cand_id").alias("cand_id"))
    best = level.groupBy("block", "key").agg(F.max("score").alias("best"), F.max_by(F.struct("n", "cand_id"), "score").alias("top"))
    unique = F.col("top.n") == 1
    solved = titles.join(best.select("block", "key", "best", F.when(unique, F.col("top.cand_id")).alias("fuzzy_id")), ["block", "key"], "left").join(blocks, "block", "left")
    exact = F.coalesce(F.col("n_equal") == 1, F.lit(False))
    method = F.when(F.col("has").isNull(), "NO_DATE").when(exact, "EXACT").when(F.col("fuzzy_id").isNotNull(), "JACCARD").otherwise("UNRESOLVED")
    out = solved.select("block", F.col("key").alias("row_key"), F.when(exact, F.col("equal_id")).otherwise(F.col("fuzzy_id")).alias("cand_id"), method.alias("method"), F.round(F.when(exact, 1.0).otherwise(F.col("best")), 6).alias("score"))
    same = r["block"].eqNullSafe(out["block"]) & r["row_key"].eqNullSafe(out["row_key"])
    return r.join(out, same).select("row_id", "cand_id", "method", "score")


def positional_zip(df: DataFrame, left: str, right: str) -> DataFrame:
    """The k-th of ``left`` with the k-th of ``right``, whose last one repeats."""
    one = F.posexplode(left).alias("pos", "left_item")
    return df.select("*", one).withColumn("right_item", F.when(F.size(right) > 0, F.element_at(right, F.least(F.col("pos") + 1, F.size(right)))))


def cross_expand(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.withColumn("left_item", F.explode(left)).withColumn("right_item", F.explode(right))


def count_expand(df: DataFrame, count: str) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(F.col(count), F.lit(1)).cast("int"))))


# ---- ordered operators ----------------------------------------------------------------------------------------------


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def later_entries(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("n > 1")


def forward_fill(df: DataFrame, key: str, order: list, column: str, name: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(column, ignorenulls=True).over(w))


def running_ordinal(df: DataFrame, key: str, order: list, name: str = "ordinal") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def latest_by(df: DataFrame, key: str, at: Column, seq: Column, values: list[str]) -> DataFrame:
    """The values of the latest row of each key; of equal times the later entry."""
    return df.groupBy(key).agg(F.max_by(F.struct(*values), F.struct(at, seq)).alias("v")).select(key, "v.*")


def changed_locators(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value, the values sorted and joined by ";"."""
    return df.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias("values")).filter(F.size("values") > 1).select(key, F.array_join("values", ";").alias("values"))


def stratified_holdout(df: DataFrame, stratum: str, id_: str, share: float = 0.2) -> DataFrame:
    """The first fifth (at least one) of each stratum by SHA-256 of the id."""
    w = Window.partitionBy(stratum)
    n = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)).over(w) * F.lit(share)))
    place = F.row_number().over(w.orderBy(F.sha2(F.col(id_).cast("string"), 256)))
    return df.withColumn("holdout", place <= n)


def hash_mod_split(id_: Column, by: int = 5) -> Column:
    """Holdout if the first 8 hex digits of the SHA-256 are divisible by ``by``."""
    return F.conv(F.substr(F.sha2(id_.cast("string"), 256), F.lit(1), F.lit(8)), 16, 10).cast("bigint") % by == 0


# ---- snapshots and coverage -----------------------------------------------------------------------------------------


def snapshot_diff(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """(key, sha256, notes, first_observed_at, observed_at) of two observations: changes, and first sightings kept."""
    a, b = (df.select(key, *[F.col(c).alias(f"{p}_{c}") for c in ("sha256", "notes", "first_observed_at", "observed_at")]) for df, p in ((before, "old"), (now, "new")))
    change = (
        F.when(F.col("old_observed_at").isNull(), "NEW").when(F.col("new_observed_at").isNull(), "GONE")
        .when(~F.col("old_notes").eqNullSafe(F.col("new_notes")), "CHANGED-NOTES").when(~F.col("old_sha256").eqNullSafe(F.col("new_sha256")), "CHANGED-BYTES").otherwise("SAME")
    )
    return a.join(b, key, "full_outer").select(key, change.alias("change"), F.coalesce("old_first_observed_at", "new_observed_at").alias("first_observed_at"), F.coalesce("new_observed_at", "old_observed_at").alias("observed_at"))


def missing_days(done: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """Days of the inclusive range that are not done."""
    every = done.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    return every.join(done.select(F.col(day).alias("day")), "day", "left_anti")


def append_new(ledger: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return rows.join(ledger.select(key), key, "left_anti")


#: Firmness by rank, the greatest wins.
FIRMNESS = {"UNKNOWN": 0, "FIRM_STATED": 1, "RENUNCIATION_OBSERVED": 2, "APPEAL_OBSERVED": 3, "JUDGMENT_OBSERVED": 4, "ANNULMENT_OBSERVED": 5}


def project_status(notes: DataFrame, key: str, firmness: str, basis: str) -> DataFrame:
    """The highest-ranked firmness of each key, with all its bases."""
    rank = F.element_at(F.create_map(*[F.lit(x) for k, v in FIRMNESS.items() for x in (k, v)]), F.col(firmness))
    return notes.groupBy(key).agg(F.max_by(firmness, F.coalesce(rank, F.lit(0))).alias("firmness_status"), F.array_join(F.sort_array(F.collect_list(F.col(basis).cast("string"))), ";").alias("basis"))


def history_matrix(days: DataFrame, downloaded: DataFrame) -> DataFrame:
    """Accounting for each period, from its enumerated days (period, items: array of (boe_id, kind, sanction_like), error)
    and the publications there are (period, boe_id): days, errors, documents enumerated, by kind, downloaded and failed,
    and the SHA-256 of the sorted identifiers. A period with a sanction publication and a failed document is PARTIAL."""
    items = days.select("period", F.inline("items")).join(downloaded.select("period", "boe_id", F.lit(True).alias("here")).distinct(), ["period", "boe_id"], "left")
    here = F.coalesce("here", F.lit(False))
    known = F.col("kind").isin("SANCTION_PUBLICATION", "CORRECTION")
    counted = items.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_enumerated"), F.count_if(F.col("kind") == "SANCTION_PUBLICATION").alias("n_sanctions"), F.count_if(F.col("kind") == "CORRECTION").alias("n_corrections"), F.count_if(~known).alias("n_other"),
        F.count_if(here).alias("n_downloaded"), F.count_if(F.col("sanction_like") & ~here).alias("n_failed"), F.sha2(F.array_join(F.sort_array(F.collect_list("boe_id")), "\n"), 256).alias("identifiers_sha256"),
    )
    out = days.groupBy("period").agg(F.count(F.lit(1)).alias("n_days"), F.count("error").alias("n_errors")).join(counted, "period", "left")
    out = out.select("period", "n_days", "n_errors", *[F.coalesce(c, F.lit(0)).alias(c) for c in counted.columns if c.startswith("n_")], F.coalesce("identifiers_sha256", F.sha2(F.lit(""), 256)).alias("identifiers_sha256"))
    return out.withColumn("status", F.when((F.col("n_sanctions") == 0) | (F.col("n_failed") == 0), "REPRODUCIBLY_ENUMERATED").otherwise("PARTIAL"))


def seed_reviews(defects: DataFrame, documents: DataFrame, compat: str) -> DataFrame:
    """Review items of known defects (defect_id, defect_class, description, fixtures) for fixtures among the documents
    (document_id, sha256): reviews of unknown bytes mean nothing."""
    each = defects.select("defect_id", "defect_class", "description", F.explode("fixtures").alias("document_id"))
    out = each.join(documents.select("document_id", "sha256").filter("sha256 <> ''"), "document_id")
    parts = [F.lit("defect"), F.col("defect_id"), F.col("document_id"), F.col("sha256"), F.lit(compat)]
    return out.select(
        review_id(*parts).alias("review_id"), F.lit("defect").alias("subject_type"), F.col("defect_id").alias("subject_id"), "document_id", F.col("sha256").alias("raw_sha256"),
        F.lit(compat).alias("review_compat_version"), F.col("defect_class").alias("reason_code"), F.lit("CORRECTED").alias("status"), F.col("description").alias("expected_interpretation"),
    )


def document_profile(infringements: DataFrame, sanctions: DataFrame, respondents: DataFrame) -> DataFrame:
    """Each case's sorted sets of severities, articles, statutes and subjects, and the sum of its fines."""
    of = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ";")
    facts = infringements.groupBy("case_id").agg(of("severity").alias("severities"), of("article_normalized").alias("articles"), of("statute_normalized").alias("statutes"))
    named = sanctions.join(respondents.select("respondent_id", "normalized_name"), "respondent_id", "left")
    fines = named.groupBy("case_id").agg(of("normalized_name").alias("subjects"), F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(38,2)").alias("total"))
    return facts.join(fines, "case_id", "full_outer")


def bar_scale(df: DataFrame, value: str) -> DataFrame:
    """``share``: the value by the greatest value, or by one if that is less. The maximum is one row, joined to all."""
    most = df.agg(F.greatest(F.max(value), F.lit(1)).alias("most"))
    return df.join(F.broadcast(most)).withColumn("share", F.col(value) / F.col("most")).drop("most")


def is_subset(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: whether every key of a is among those of b."""
    return a.select(key).join(b.select(key), key, "left_anti").agg((F.count(F.lit(1)) == 0).alias("is_subset"))


def successor_link(sanctions: DataFrame, declared: DataFrame) -> DataFrame:
    """Sanctions (doc, sanction_id, declared_subject) with the last infringement declared for that name in the same
    document (doc, name, ordinal, infringement_id); names are compared in lower case, without outer blanks."""
    name = lambda c: F.lower(F.trim(c))
    last = declared.groupBy("doc", name("name").alias("who")).agg(F.max_by("infringement_id", "ordinal").alias("declared_infringement"))
    return sanctions.withColumn("who", name("declared_subject")).join(last, ["doc", "who"], "left").drop("who")


def latest_release(df: DataFrame, path: str, file: str) -> DataFrame:
    """The greatest path of a release folder ("v...") that holds the file."""
    return df.filter(F.col(path).rlike(rf"/v[^/]*/{file}$")).agg(F.max(path).alias("path"))


def reconciliation(docs: DataFrame, corpus: str, kind: str, kinds: list[str]) -> DataFrame:
    return docs.groupBy(corpus).agg(F.count(F.lit(1)).alias("n_documents"), *[F.count_if(F.col(kind) == k).alias(f"n_{k.lower()}") for k in kinds])


def apply_staleness(items: DataFrame, documents: DataFrame, compat: str) -> DataFrame:
    """Review items (review_id, document_id, raw_sha256, review_compat_version, status, notes) against documents
    (document_id, sha256): another version or other bytes make a review stale."""
    now = documents.select("document_id", F.col("sha256").alias("now_sha"))
    stale = (F.col("review_compat_version") != compat) | (F.coalesce("raw_sha256", F.lit("")) != F.coalesce("now_sha", F.lit(""))) | F.col("now_sha").isNull()
    return items.join(now, "document_id", "left").withColumn("notes", F.when(stale, F.concat_ws("; ", "notes", F.lit("stale"))).otherwise(F.col("notes"))).withColumn("status", F.when(stale, "STALE").otherwise(F.col("status"))).drop("now_sha")


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def proof_level(excerpt: Column, raw_value: Column, paragraph: Column, sha: Column, artifact: Column) -> Column:
    """How far evidence is bound: to the document, to the paragraph, or to the value in it."""
    return proof_of(squeezed(excerpt), raw_value, squeezed(raw_value), squeezed(paragraph), sha, artifact)


def proof_of(e: Column, raw_value: Column, v: Column, p: Column, sha: Column, artifact: Column) -> Column:
    """proof_level of texts that are squeezed already: each is named several times and would be squeezed as often."""
    located = p.isNotNull() & (F.contains(p, F.substr(e, F.lit(1), F.lit(200))) | F.contains(e, p))
    value = raw_value.isNotNull() & (raw_value != "") & F.contains(e, v) & F.contains(p, v)
    return F.when(sha.isNotNull() & (sha != artifact), F.lit(None)).when(located & value, "VALUE_BINDING_PROVEN").when(located, "LOCATION_PROVEN").otherwise("DOCUMENT_BINDING_PROVEN")


# ---- dataset identity -----------------------------------------------------------------------------------------------


def canonical_row(df: DataFrame) -> Column:
    """A row as JSON with sorted keys, nulls kept: whole numbers and booleans as such, decimals and times as text. Floats
    have no canonical form and are an error."""
    kinds = dict(df.dtypes)
    if floats := [c for c, k in kinds.items() if "double" in k or "float" in k]:
        raise TypeError(f"columns without a canonical form: {floats}")
    exact = lambda c: F.col(f"`{c}`") if kinds[c] in ("boolean", "tinyint", "smallint", "int", "bigint", "string") or kinds[c].startswith(("array", "struct", "map")) else F.col(f"`{c}`").cast("string")
    return F.to_json(F.struct(*[exact(c).alias(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})


def logical_hash(df: DataFrame) -> DataFrame:
    """Order-insensitive hash of a small table: SHA-256 of its sorted rows, each ended by a newline. All rows meet in one
    task; tables of a release that may be large take the root of merkle.tree."""
    return df.agg(F.sha2(F.concat(F.array_join(F.sort_array(F.collect_list(canonical_row(df))), "\n"), F.lit("\n")), 256).alias("logical_sha256"), F.count(F.lit(1)).alias("n_rows"))


def schema_fingerprint(df: DataFrame) -> str:
    return hashlib.sha256(";".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields).encode()).hexdigest()[:16]


def corpus_hash(hashes: dict[str, str]) -> str:
    return hashlib.sha256(json.dumps(dict(sorted(hashes.items())), separators=(",", ":"), sort_keys=True).encode()).hexdigest()
