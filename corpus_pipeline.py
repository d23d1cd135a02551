"""Corpus pipeline: STAGES applied one after another, each written as Parquet and read again.

Quality classifier, line dedup, near-duplicate removal and benchmark decontamination filter or trim the documents, BPE
encodes what is left. Every stage takes all that the one before kept; rows are carried whole, whatever their columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.llm import bpe as bpe_operator
from lexledger.llm import decontaminate, jaccard_join, line_dedup, quality
from lexledger.llm.exchange import checkpoint_dir


def _row(docs: DataFrame, *without: str):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without]).alias("row")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or better by a classifier trained on the labels of documents still here."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = quality.train(docs, labels, learns=lambda c: quality.remainder(c, 4) != 2)
    scored = quality.score(docs.select(_row(docs), "text"), weights, keep=["row"])
    return scored.filter(F.col("score") >= quality.THRESHOLD).select("row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows taken out of the texts; n_chars follows. Rows stay."""
    out = line_dedup.line_dedup(docs.select(_row(docs, "text"), "doc_id", "text"), keep=["row"])
    changed = {"text": F.col("kept_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[(changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the benchmark contaminates."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = decontaminate.contamination(docs.select(_row(docs), "text"), benchmark, keep=["row"])
    return out.filter(~decontaminate.is_contaminated()).select("row.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return bpe_operator.digests(bpe_operator.bpe(docs.select("doc_id", "text"), keep=["doc_id"]))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: Classifier, near duplicates and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            path = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
