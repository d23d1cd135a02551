"""Builds that follow changes: only new and changed files are parsed, only what depends on them is assembled again.

A build's folder holds its tables and its state: all files with their SHA-256, the parsed publications of the files that
win their boe_id, mentions of respondents, and the rows of sidecar and observations. The next build compares files by content:

* a file is parsed if its path had other content, or none, or was not parsed before because another file won its boe_id;
* *touched* ids are those of files that came, went, changed or became winners or losers, and those whose sidecar row or
  observation differs. Rows of all tables that belong to touched ids go, and come anew from the publications of these ids;
* a respondent is told by its first mention anywhere: respondents with mentions in touched publications, before or now, are
  told anew from all mentions, and those without mentions go.

All other rows are carried over as they are, with the time at which they were first observed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.grammar.udf import parse_publications
from lexledger.operators import dataflow as flow
from lexledger.plans.assembly import OBSERVATIONS, PEOPLE, SIDECAR, assemble_with_people, kept, respondents_of
from lexledger.schemas import TABLES
from lexledger.sources import readers
from lexledger.sources.sinks import write_tables

FILES = "corpus string, path string, boe_id string, sha256 string"
NAME = ["corpus", "path", "sha256"]
#: Whose row it is; the rest belongs to the publication of its case.
OWNER = {"cases": "canonical_boe_id", "documents": "boe_id", "parse_issues": "boe_id", "evidence": "document_id"}


def owner(table: str) -> Column:
    """The boe_id that a table's row belongs to."""
    return F.col(OWNER[table]) if table in OWNER else F.substr(F.col("case_id"), F.lit(6))


def moved(old: DataFrame, new: DataFrame, by: str = "boe_id") -> DataFrame:
    """(id) of rows that only one side has."""
    mark = lambda df, n: df.select(F.col(by).alias("id"), F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).alias("a"), F.xxhash64(F.lit(1), *[F.col(c) for c in sorted(df.columns)]).alias("b"), F.lit(n).alias("n"))
    both = mark(old, -1).unionByName(mark(new, 1))
    return both.groupBy("id", "a", "b").agg(F.sum("n").alias("n")).filter("n <> 0").select("id")


def within(df: DataFrame, key: Column, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose key is among the ids (left_semi), or not (left_anti); null is an id like others."""
    return df.withColumn("_key", key).join(ids.withColumnRenamed("id", "_id"), F.col("_key").eqNullSafe(F.col("_id")), how).drop("_key")


def build(spark: SparkSession, files: DataFrame, out: str, observed_at: datetime, previous: str | None = None, sidecar: DataFrame | None = None, observations: DataFrame | None = None) -> dict[str, int]:
    """Builds ``out`` from the files (corpus, path, boe_id, content), as a build of all of them would, from what
    ``previous`` has; returns how many files there are, were parsed, and went, and how many ids were touched."""
    if previous is not None and previous.rstrip("/") == out.rstrip("/"):
        raise ValueError("a build does not overwrite the one that it starts from")

    def before(name: str, schema) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{previous}/state/{name}") if previous is not None else spark.createDataFrame([], schema)

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/state/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/state/{name}")

    one = parse_publications(spark.createDataFrame([], "path string, corpus string, sha256 string, content binary"), carry=["corpus", "sha256"])
    parsed_schema = one.schema
    hashed = files.select("corpus", "path", "boe_id", "content", F.sha2("content", 256).alias("sha256"))
    seen = keep(hashed.drop("content").select(*[c.split()[0] for c in FILES.split(", ")]), "files")
    old_parsed = before("parsed", parsed_schema)
    winners = flow.first_wins(seen, ["boe_id"], ["corpus", "path"])
    to_parse = winners.join(old_parsed.select(*NAME), NAME, "left_anti").select(*NAME)
    fresh = keep(parse_publications(hashed.join(to_parse, NAME, "left_semi"), carry=["corpus", "sha256"]), "parsed_now" if previous is not None else "parsed")
    parsed = keep(old_parsed.join(winners.select(*NAME), NAME, "left_semi").unionByName(fresh), "parsed") if previous is not None else fresh
    side = keep((sidecar if sidecar is not None else spark.createDataFrame([], SIDECAR)).select(*[c.split()[0] for c in SIDECAR.split(", ")]), "sidecar")
    looks = keep((observations if observations is not None else spark.createDataFrame([], OBSERVATIONS)).select("boe_id", "sha256", "notes", "status", "retrieval", "first_observed_at", "observed_at"), "observations")
    gone = old_parsed.join(winners.select(*NAME), NAME, "left_anti")
    ids = moved(before("files", FILES), seen).union(gone.select("publication.boe_id")).union(fresh.select("publication.boe_id"))
    ids = ids.union(moved(before("sidecar", SIDECAR), side)).union(moved(before("observations", OBSERVATIONS), looks))
    touched = keep(ids.distinct(), "touched")

    def counts() -> dict[str, int]:
        return {"n_files": seen.count(), "n_parsed": fresh.count(), "n_gone": gone.count(), "n_touched": touched.count()}

    # Without a build before, all ids are touched and nothing is carried over.
    publications = parsed if previous is None else kept(within(parsed, F.col("publication.boe_id"), touched))
    publications = publications.select("path", "corpus", "publication.*")
    near = lambda df: within(df, F.col("boe_id"), touched) if previous is not None else df
    part, mentions = assemble_with_people(publications, near(seen), observed_at, near(side), near(looks))
    if previous is None:
        part["respondents"] = respondents_of(keep(mentions, "people"))
        write_tables(part, out)
        return counts()
    old_people = before("people", PEOPLE)
    people = keep(within(old_people, F.col("boe_id"), touched, "left_anti").unionByName(mentions), "people")
    told = near(old_people).select("respondent_id").union(mentions.select("respondent_id")).distinct()
    old = readers.ledger_tables(spark, previous)
    tables = {}
    for name in TABLES:
        if name == "respondents":
            rest, new = old[name].join(told, "respondent_id", "left_anti"), respondents_of(people.join(told, "respondent_id", "left_semi"))
        elif name == "review_items":
            rest, new = old[name], part[name]
        else:
            rest, new = within(old[name], owner(name), touched, "left_anti"), part[name]
        tables[name] = rest.unionByName(new.select(*rest.columns))
    write_tables(tables, out)
    return counts()
