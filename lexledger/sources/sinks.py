"""Sinks: Parquet tables, JSON and CSV exports, append-only ledgers, release manifests."""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.operators import dataflow as flow
from lexledger.operators import merkle


def write_tables(tables: dict[str, DataFrame], folder: str, files: int | None = None, side_by_side: int = 4) -> None:
    """Every table as zstd Parquet, empty ones too; some side by side, as small tables leave most of a cluster idle."""

    def put(name: str) -> None:
        df = tables[name].coalesce(files) if files else tables[name]
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")

    with ThreadPoolExecutor(side_by_side) as pool:
        list(pool.map(put, tables))


def load_views(spark: SparkSession, tables: dict[str, DataFrame], built_at: str) -> None:
    """The tables as temporary views, for SQL, and ``meta``: the rows of each, when it was built, and by what."""
    counts = None
    for name, df in sorted(tables.items()):
        df.createOrReplaceTempView(name)
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        counts = one if counts is None else counts.union(one)
    counts.select("*", F.lit(built_at).alias("built_at_utc"), F.lit(spark.version).alias("engine_version")).createOrReplaceTempView("meta")


FORMATS = ("json", "csv", "parquet")


def export(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "json":
        df.write.mode("overwrite").json(path)
    elif fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def append_ledger(spark: SparkSession, rows: DataFrame, path: str, key: str) -> None:
    """Rows whose key the ledger has not seen."""
    flow.append_new(spark.read.schema(rows.schema).json(path), rows.dropDuplicates([key]), key).write.mode("append").json(path)


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, logical_sha256, schema_fingerprint): what a release holds; the hash is the root of the table's
    Merkle tree over row hashes, so no table has to meet in one task."""
    out = None
    for name, df in sorted(tables.items()):
        one = merkle.tree(df).root().select(F.lit(name).alias("table_name"), "n_rows", F.col("digest").alias("logical_sha256"), F.lit(flow.schema_fingerprint(df)).alias("schema_fingerprint"))
        out = one if out is None else out.union(one)
    return out


def file_sums(spark: SparkSession, folder: str) -> DataFrame:
    """(path below the folder, bytes, sha256) of all files of a release, as for SHA256SUMS; names starting with "_" or "."
    don't count."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    below = F.regexp_replace("path", r"^.*?" + re.escape(re.sub(r"^[a-z]+:/*", "", folder).strip("/")) + "/", "")
    return files.filter(~F.col("path").rlike(r"/[_.][^/]*$")).select(below.alias("path"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def is_release(tag: str) -> bool:
    return re.fullmatch(r"v\d+\.\d+\.\d+(?:-[0-9A-Za-z.]+)?", tag) is not None


def release(spark: SparkSession, tables: dict[str, DataFrame], folder: str, tag: str, commit: str, limitations: list[str] = ()) -> None:
    """A release: the tables, their manifest and coverage as JSON, and the sums of all files."""
    if not is_release(tag):
        raise ValueError(f"no release tag: {tag!r}")
    base = f"{folder}/{tag}"
    write_tables(tables, base)
    back = {name: spark.read.schema(df.schema).parquet(f"{base}/{name}.parquet") for name, df in tables.items()}
    parts = {r.table_name: r.asDict() for r in manifest(back).collect()}  # one row for each table
    whole = flow.corpus_hash({k: v["logical_sha256"] for k, v in parts.items()})
    put = lambda name, text: spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/{name}")
    put("dataset_manifest.json", json.dumps({"release": tag, "code_commit": commit, "corpus_logical_sha256": whole, "tables": parts}, sort_keys=True))
    cover = {k: [r.asDict() for r in v.collect()] for k, v in coverage(back["cases"], back["documents"], back["parse_issues"]).items()}  # grouped rows
    put("coverage.json", json.dumps({"counts": {k: v["n_rows"] for k, v in parts.items()}, "limitations": list(limitations), **cover}, default=str, sort_keys=True))
    file_sums(spark, base).coalesce(1).write.mode("overwrite").csv(f"{base}/_SHA256SUMS")


def coverage(cases: DataFrame, documents: DataFrame, issues: DataFrame) -> dict[str, DataFrame]:
    """The parts of the coverage ledger: date range, documents and cases by corpus, issues by kind."""
    made = cases.select(F.col("canonical_boe_id").alias("boe_id"), F.lit(1).alias("is_case"))
    return {
        "range": cases.agg(F.count(F.lit(1)).alias("n_cases"), F.min("boe_publication_date").alias("first"), F.max("boe_publication_date").alias("last")),
        "corpora": documents.join(made, "boe_id", "left").groupBy("corpus").agg(F.count(F.lit(1)).alias("n_documents"), F.countDistinct("boe_id").alias("n_publications"), F.count("is_case").alias("n_cases"), F.count_if(F.col("is_case").isNull()).alias("n_non_case")),
        "issues": issues.groupBy("kind").agg(F.count(F.lit(1)).alias("n")),
    }
