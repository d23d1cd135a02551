"""Repeated observation: what was seen of each key first and last, and what changed in between, as keyed state.

Each key's state is read and written only in batches that look at it (transformWithState over RocksDB), so work follows the
keys of a batch and not all keys. A timer marks keys as expired that were not seen for a time, by the stream's own clock,
which is the greatest time observed so far less the watermark's delay. The state lives in the folder's checkpoint: another
run on the same folder goes on from it. What a batch changes is appended to a log, a part for each batch."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lexledger.streaming.incremental import state_dir

#: Times in state are microseconds.
STATE = "sha256 string, notes string, first_observed_at bigint, observed_at bigint, changes bigint, note_changes bigint, expired boolean"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Observe(StatefulProcessor):
    """Folds looks (key, sha256, notes, observed_at) into STATE, in the order of observed_at whatever their batch's order.

    A look older than the last one only moves first_observed_at. Bytes that differ count as a change; equal bytes with
    other notes as a change of notes. A failed look has a null sha256 and changes neither."""

    def __init__(self, key: str, keep_days: int | None):
        self.key, self.keep = key, keep_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("observed", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        s = self.state.get() if self.state.exists() else None
        sha, notes, first, last, changes, other, _ = s if s is not None else (None, None, None, None, 0, 0, False)
        for r in sorted(rows, key=lambda r: (r.at, r.sha256 or "", r.notes or "")):
            first = r.at if first is None else min(first, r.at)
            if last is not None and r.at < last:
                continue
            last = r.at
            if r.sha256 is not None:
                if sha is not None and r.sha256 != sha:
                    changes += 1
                elif sha is not None and r.notes != notes:
                    other += 1
                sha, notes = r.sha256, r.notes
        self._put(key, (sha, notes, first, last, changes, other, False))
        if self.keep is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(max(last // 1000 + self.keep * 86_400_000, timerValues.getCurrentWatermarkInMs() + 1))
        yield self._row(key)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            self._put(key, (*tuple(self.state.get())[:-1], True))
            yield self._row(key)

    def _put(self, key, value: tuple) -> None:
        self.state.update(value)
        self.now = value

    def _row(self, key) -> Row:
        return Row(**{self.key: key[0]}, **dict(zip((c.split()[0] for c in STATE.split(", ")), self.now)))

    def close(self) -> None:
        pass


def observe_stream(spark: SparkSession, source: DataFrame, key: str, folder: str | None = None, keep_days: int | None = None, delay: str = "0 seconds") -> DataFrame:
    """The observed state of all keys after what is available now: (key, sha256, notes, first_observed_at, observed_at,
    changes, note_changes, expired).

    ``source``: a stream of (key, sha256, observed_at), with notes if there are any. ``keep_days``: after how many days
    without a look a key counts as expired (a later look revives it); ``delay``: of the watermark that tells the time;
    with ``keep_days`` looks older than the watermark come too late and are left out."""
    folder = folder or state_dir(spark)
    notes = F.col("notes").cast("string") if "notes" in source.columns else F.lit(None).cast("string").alias("notes")
    looks = source.select(key, F.col("sha256").cast("string").alias("sha256"), notes.alias("notes"), F.col("observed_at").cast("timestamp").alias("observed_at")).filter(F.col(key).isNotNull() & F.col("observed_at").isNotNull())
    looks = looks.withColumn("at", F.unix_micros("observed_at"))
    schema = f"`{key}` {dict(source.dtypes)[key]}, {STATE}"
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        folded = looks.withWatermark("observed_at", delay).groupBy(key).transformWithState(statefulProcessor=Observe(key, keep_days), outputStructType=schema, outputMode="Update", timeMode="None" if keep_days is None else "EventTime")
        put = lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/log/batch={n}")
        folded.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return observed(spark, folder, schema, key)


def observed(spark: SparkSession, folder: str, schema: str, key: str) -> DataFrame:
    """The last state of each key in the log; one batch can hold a key's look and its expiry, the expiry is later."""
    log = spark.read.schema(f"{schema}, batch bigint").parquet(f"{folder}/log")
    rest = [c for c in log.columns if c not in (key, "batch")]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("batch", "expired")).alias("x")).select(key, "x.*").withColumns({c: F.timestamp_micros(c) for c in ("first_observed_at", "observed_at")})
