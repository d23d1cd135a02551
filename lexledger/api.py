"""The read interface without a server: a path and its parameters to DataFrames, and those to JSON lines.

A web framework of the user's choice can put ``get`` behind its routes; nothing here keeps state or collects rows."""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.operators import dataflow as flow
from lexledger.operators import ledger

MANIFEST, COVERAGE = "dataset_manifest.json", "coverage.json"
MANIFEST_SCHEMA = "release string, dataset_schema_version string, corpus_logical_sha256 string, code_commit string"


def artifact(spark: SparkSession, releases: str, file: str) -> DataFrame:
    """(path, value) of the file in the latest release folder, written by Spark or not; empty if no release has it."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", f"{{{file},part-*.txt}}").text(releases)
    found = files.select(F.col("_metadata.file_path").alias("path"), "value")
    return found.join(flow.latest_release(found, "path", re.escape(file) + "(?:/[^/]*)?"), "path")


def metadata(spark: SparkSession, releases: str) -> DataFrame:
    """One row: what release is served, nulls without one."""
    one = artifact(spark, releases, MANIFEST).select(F.from_json("value", MANIFEST_SCHEMA).alias("m")).select("m.*")
    return one.agg(*[F.max(c).alias(c) for c in one.columns]).withColumn("api_version", F.lit("v1"))


def responses(df: DataFrame) -> DataFrame:
    """Rows as JSON objects, nulls kept."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("json"))


def get(spark: SparkSession, t: Mapping[str, DataFrame], path: str, releases: str | None = None, **params) -> dict[str, DataFrame]:
    """The named parts of an answer. Unknown paths raise LookupError, unknown parameters ValueError."""

    def number(name: str, default: int, most: int) -> int:
        value = int(params.pop(name, default))
        if not 1 <= value <= most:
            raise ValueError(f"{name} is not between 1 and {most}: {value}")
        return value

    route = re.sub(r"/+$", "", path)
    if route in ("/health", "/metadata", "/coverage"):
        if releases is None:
            raise LookupError("no folder of releases")
        about = metadata(spark, releases)
        out = {
            "/health": lambda: {"health": about.select(F.lit("ok").alias("status"), "release")},
            "/metadata": lambda: {"metadata": about},
            "/coverage": lambda: {"coverage": artifact(spark, releases, COVERAGE).select("value"), "release": about},
        }[route]()
    elif route == "/stats":
        out = {"totals": ledger.stats_totals(t), "by_severity": ledger.stats_by_severity(t), "by_type": ledger.stats_by_type(t), "by_statute": ledger.stats_by_statute(t)}
    elif route == "/cases":
        limit, offset = number("limit", 100, ledger.MOST_CASES), int(params.pop("offset", 0))
        out = {"cases": ledger.list_cases(t, params.pop("severity", None), params.pop("statute", None), params.pop("respondent", None), limit, offset)}
    elif m := re.fullmatch("/cases/([^/]+)", route):
        out = ledger.case_detail(t, unquote(m[1]), params.pop("known_at", None))
    elif route == "/respondents":
        out = {"respondents": ledger.respondents(t, params.pop("q", None), number("limit", 200, ledger.MOST_RESPONDENTS))}
    elif m := re.fullmatch("/respondents/([^/]+)", route):
        key = unquote(m[1])
        out = {"respondent": t["respondents"].filter(F.col("respondent_id") == key), "sanctions": t["sanctions"].filter(F.col("respondent_id") == key), "cases": ledger.respondent_cases(t, key)}
    elif route == "/laws":
        out = {"laws": ledger.laws(t)}
    elif m := re.fullmatch("/laws/([^/]+)/articles/([^/]+)", route):
        out = {"infringements": ledger.article(t, unquote(m[1]), unquote(m[2]))}
    elif route == "/status":
        out = {"status": ledger.status(t)}
    else:
        raise LookupError(path)
    if params:
        raise ValueError(f"unknown parameters: {sorted(params)}")
    return out
