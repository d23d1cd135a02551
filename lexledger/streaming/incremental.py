"""Structured Streaming forms of the incremental patterns: folders that outlive a run, first sightings, windows.

Every function takes the folder that holds its checkpoint and output. Called again on the same folder it goes on where
the last run ended; without one it works in a new folder below the shared one."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a folder of our own only in local mode, where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not re.match(r"local(\[[^,]*\])?$", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexledger-"))
        base = spark.sparkContext.getCheckpointDir()
    return base


def state_dir(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def drain(stream) -> None:
    """Runs a started query until all that is available has been taken, however many batches that takes."""
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()


def first_seen(spark: SparkSession, source: DataFrame, keys: list[str], folder: str | None = None) -> DataFrame:
    """Distinct keys of a stream, run over what is available now; the state is one entry for each key."""
    folder = folder or state_dir(spark)
    stream = source.select(*keys).dropDuplicates(keys).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.read.schema(source.select(*keys).schema).parquet(f"{folder}/out")


def windowed_counts(source: DataFrame, at: str, width: str, late: str, *keys: str) -> DataFrame:
    """Beyond the ledger's needs: tumbling counts with a watermark."""
    return source.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count(F.lit(1)).alias("n"))
