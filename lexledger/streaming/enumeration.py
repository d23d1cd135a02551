"""Resumable daily enumeration: days as a streaming source, one manifest row for each look at a day.

The source's offsets are days. A batch takes the next days of the calendar, and days that are offered again; both stand in
the logged offset, so a batch that was planned but not committed is the same when it is planned anew. Days whose last look
ended in an error are offered again by the next run on the same folder. A day without a summary or without items is
settled with no items. A day that an earlier batch has settled is not taken twice, whatever the source offers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from lexledger.sources import http, readers
from lexledger.streaming.incremental import drain

ITEMS = "array<struct<boe_id: string, title: string, seccion: string, epigrafe: string, url_xml: string, sanction_like: boolean>>"
MANIFEST = f"day date, items {ITEMS}, error string"


@dataclass
class Stretch(InputPartition):
    days: list[str]


class CalendarDays(DataSource):
    """Options: start and end (ISO days, both included), batch_days, split_days (days for a task), again (days to offer
    again, separated by commas). Rows: day."""

    @classmethod
    def name(cls) -> str:
        return "calendar_days"

    def schema(self) -> str:
        return "day date"

    def streamReader(self, schema):
        return _Days(self.options)


class _Days(DataSourceStreamReader):
    def __init__(self, options):
        self.start, self.stop = date.fromisoformat(options["start"]), date.fromisoformat(options["end"]) + timedelta(days=1)
        self.size, self.split = int(options.get("batch_days", "31")), int(options.get("split_days", "31"))
        self.again = [x for x in options.get("again", "").split(",") if x]
        self.at: dict | None = None
        self.unplanned: list[str] = []

    def initialOffset(self) -> dict:
        return {"next": self.start.isoformat(), "again": "", "round": 0}

    def latestOffset(self) -> dict:
        at = self.at or self.initialOffset()
        some, self.again = self.again[: self.size], self.again[self.size :]
        self.unplanned += some
        begin = date.fromisoformat(at["next"])
        end = max(begin, min(self.stop, begin + timedelta(days=self.size - len(some))))
        if some or end > begin:
            at = {"next": end.isoformat(), "again": ",".join(self.unplanned), "round": at["round"] + 1}
        self.at = at
        return at

    def partitions(self, start: dict, end: dict):
        if self.at is None:  # a restart: the last planned batch is planned once more
            self.at = end
        self.unplanned = []
        if start["round"] == end["round"]:
            return []
        first, last = date.fromisoformat(start["next"]), date.fromisoformat(end["next"])
        days = [(first + timedelta(days=i)).isoformat() for i in range((last - first).days)] + [x for x in end["again"].split(",") if x]
        return [Stretch(days[i : i + self.split]) for i in range(0, len(days), self.split)]

    def read(self, partition: Stretch):
        for day in partition.days:
            yield (date.fromisoformat(day),)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(day, items, error, batch) of all looks so far."""
    schema = f"{MANIFEST}, batch bigint"
    try:
        return spark.read.schema(schema).parquet(f"{folder}/manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def settled(looks: DataFrame) -> DataFrame:
    """(day, items, error, attempts): a day's look without an error, or else its last one."""
    best = F.max_by(F.struct("items", "error"), F.struct(F.col("error").isNull(), "batch"))
    return looks.groupBy("day").agg(best.alias("x"), F.count(F.lit(1)).alias("attempts")).select("day", "x.items", "x.error", "attempts")


def summaries_in(table: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Days looked up in a table of (day, payload, error)."""
    return lambda days: days.join(table, "day")


def summaries_over_http(template: str, **polite) -> Callable[[DataFrame], DataFrame]:
    """Days fetched from a URL with {yyyymmdd} in it; an answer of 404 is a day without a summary."""

    def fetch(days: DataFrame) -> DataFrame:
        url = F.replace(F.lit(template), F.lit("{yyyymmdd}"), F.date_format("day", "yyyyMMdd"))
        got = http.fetched(days.select("day", url.alias("url")), "url", **polite)
        bad = (F.col("status") != 404) & ((F.col("status") < 200) | (F.col("status") > 299))
        return got.select("day", F.when(F.col("status") == 404, None).otherwise(readers.text_of(F.col("content"))).alias("payload"), F.when(bad, F.concat(F.lit("status "), F.col("status").cast("string"))).alias("error"))

    return fetch


def looked_at(days: DataFrame, fetch: Callable[[DataFrame], DataFrame], department: str = readers.DEPARTMENT) -> DataFrame:
    """(day, items, error): every day once, with its items of the department."""
    got = fetch(days).groupBy("day").agg(F.any_value("payload").alias("payload"), F.max("error").alias("error"))
    got = got.withColumn("error", F.coalesce("error", F.when(F.col("payload").isNotNull() & F.try_parse_json("payload").isNull(), "unreadable summary")))
    found = readers.of_department(readers.sumario_items(got.filter("error IS NULL AND payload IS NOT NULL").select("day", "payload"), "payload"), department)
    item = F.struct(
        F.col("identificador").alias("boe_id"), F.col("titulo").alias("title"), F.col("seccion_codigo").alias("seccion"), F.col("epigrafe_nombre").alias("epigrafe"), "url_xml", readers.sanction_like(F.col("titulo")).alias("sanction_like")
    )
    items = found.groupBy("day").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return days.join(got.select("day", "error"), "day", "left").join(items, "day", "left").select("day", F.coalesce("items", F.array()).cast(ITEMS).alias("items"), "error")


def enumerate_days(spark: SparkSession, start: str, end: str, fetch: Callable[[DataFrame], DataFrame], folder: str, batch_days: int = 31, split_days: int = 31) -> DataFrame:
    """Looks at all days from start to end that the folder has not settled; returns the settled manifest.

    ``folder`` holds the checkpoint and the manifest, a part for each batch, rewritten if the batch is run again."""
    spark.dataSource.register(CalendarDays)
    failed = [r.day.isoformat() for r in settled(manifest(spark, folder)).filter("error IS NOT NULL").select("day").orderBy("day").toLocalIterator()]  # days of a calendar

    def look(batch: DataFrame, number: int) -> None:
        done = manifest(spark, folder).filter((F.col("batch") != number) & F.col("error").isNull()).select("day")
        looked_at(batch.dropDuplicates(["day"]).join(done, "day", "left_anti"), fetch).write.mode("overwrite").parquet(f"{folder}/manifest/batch={number}")

    days = spark.readStream.format("calendar_days").options(start=start, end=end, batch_days=batch_days, split_days=split_days, again=",".join(failed)).load()
    drain(days.writeStream.foreachBatch(look).option("checkpointLocation", f"{folder}/state").start())
    return settled(manifest(spark, folder))
