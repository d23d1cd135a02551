"""Acquisition: documents of an enumeration fetched into the content store, and repeated looks at PDF documents.

Both go on where they stopped: what a store's manifest has is not fetched again, and what was observed is keyed state in its
folder. Fetched bytes are written down before anything is made of them, as fetching again could give other bytes."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.sources import http, pdf, readers, store
from lexledger.streaming.observation import observe_stream

MANIFEST = "boe_id string, url string, status int, retrieved_at timestamp, sha256 string"
NOTES = "array<struct<kind: string, page: int, verbatim: string>>"


def _fetched(spark: SparkSession, rows: DataFrame, folder: str, **polite) -> DataFrame:
    path = f"{folder}/fetched/run={uuid.uuid4().hex}"
    http.fetched(rows, "url", **polite).write.parquet(path)
    return spark.read.parquet(path)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(boe_id, url, status, retrieved_at, sha256) of all that was stored."""
    try:
        return spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], MANIFEST)


def fetch_documents(spark: SparkSession, items: DataFrame, folder: str, **polite) -> DataFrame:
    """Fetches the documents (boe_id, url) that the store has not; returns (boe_id, url, status, stored) of this run."""
    todo = items.select("boe_id", "url").filter("url IS NOT NULL").dropDuplicates(["boe_id"]).join(manifest(spark, folder).select("boe_id"), "boe_id", "left_anti")
    got = _fetched(spark, todo, folder, **polite)
    good = got.filter("status BETWEEN 200 AND 299 AND content IS NOT NULL")
    store.store(spark, good.select("boe_id", "url", "status", "retrieved_at", "sha256", "content"), folder)
    return got.select("boe_id", "url", "status", (F.col("status").between(200, 299) & F.col("content").isNotNull()).alias("stored"))


def corpus(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """(corpus, path, boe_id, content) of the stored documents, for a build: of each boe_id what was retrieved last."""
    last = manifest(spark, folder).groupBy("boe_id").agg(F.max_by("sha256", F.struct("retrieved_at", "sha256")).alias("sha256"))
    files = last.join(store.objects(spark, folder), "sha256")
    return files.select(F.lit(name).alias("corpus"), F.concat(F.lit(f"/{name}/"), "boe_id", F.lit(".xml")).alias("path"), "boe_id", "content")


def notes_of(documents: DataFrame, key: str = "boe_id") -> DataFrame:
    """(key, notes, retrieval) of fetched documents (key, status, content): notes in the order of page and kind; retrieval is
    OK, FETCH_FAILED, EXTRACT_EMPTY or EXTRACT_FAILED."""
    fine = F.col("status").between(200, 299) & F.startswith("content", F.lit(b"%PDF"))
    pages = pdf.pdf_pages(documents.filter(fine), [key])
    state = pages.groupBy(key).agg(F.bool_or(F.col("error").isNotNull() & (F.col("error") != "no pages")).alias("bad"), F.bool_or(F.trim(F.coalesce("text", F.lit(""))) != "").alias("some"))
    found = readers.page_notes(pages.filter("error IS NULL"), key, "page", "text").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page", "kind", "position", "verbatim"))).alias("n"))
    notes = F.transform(F.coalesce("n", F.array()), lambda x: F.struct(x["kind"].alias("kind"), x["page"].cast("int").alias("page"), x["verbatim"].alias("verbatim"))).cast(NOTES)
    retrieval = F.when(F.col("bad").isNull(), "FETCH_FAILED").when(F.col("bad"), "EXTRACT_FAILED").when(~F.col("some"), "EXTRACT_EMPTY").otherwise("OK")
    return documents.select(key).join(state, key, "left").join(found, key, "left").select(key, notes.alias("notes"), retrieval.alias("retrieval"))


def pdf_status(spark: SparkSession, links: DataFrame, folder: str, **polite) -> DataFrame:
    """Looks at the PDF documents (boe_id, url) once more; returns the observed state of all documents ever looked at, as a build
    takes it: (boe_id, sha256, notes, status, retrieval, first_observed_at, observed_at), with changes and note_changes.

    Every look is a row of the folder's log, and its bytes are in the store; a failed look moves observed_at alone."""
    got = _fetched(spark, links.select("boe_id", "url").dropDuplicates(["boe_id"]), folder, **polite)
    store.store(spark, got.filter("content IS NOT NULL").select("boe_id", "url", "status", "retrieved_at", "sha256", "content"), folder)
    looks = got.join(notes_of(got), "boe_id")
    read = F.col("retrieval") == "OK"
    seen = F.to_json(F.struct("notes", "retrieval"))
    looks.select("boe_id", F.when(read, F.col("sha256")).alias("sha256"), seen.alias("notes"), F.col("retrieved_at").alias("observed_at"), "retrieval").coalesce(1).write.mode("append").parquet(f"{folder}/looks")
    schema = "boe_id string, sha256 string, notes string, observed_at timestamp, retrieval string"
    state = observe_stream(spark, spark.readStream.schema(schema).parquet(f"{folder}/looks").drop("retrieval"), "boe_id", f"{folder}/observed")
    last = spark.read.schema(schema).parquet(f"{folder}/looks").groupBy("boe_id").agg(F.max_by("retrieval", "observed_at").alias("retrieval"))
    said = F.from_json("notes", f"notes {NOTES}, retrieval string")
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return state.join(last, "boe_id", "left").select(
        "boe_id", "sha256", F.coalesce(said["notes"], F.array().cast(NOTES)).alias("notes"), F.lit(None).cast("string").alias("status"), "retrieval",
        text("first_observed_at").alias("first_observed_at"), text("observed_at").alias("observed_at"), "changes", "note_changes",
    )
