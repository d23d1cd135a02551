"""The content-addressed store: every object once by its SHA-256, whoever writes at the same time.

Objects lie in Parquet files by the first two digits of their hash, versions of a *bucket*: objects/ab/00000007.parquet. A
task writes what is new to a bucket into a hidden file, and publishes it by linking it to the bucket's next version, which
fails if another writer has been there first. Then it reads that version's hashes, drops what has become known, and tries
the version after. So a version is whole or not there, a task that fails or runs twice leaves nothing twice, and two writers
at once store each hash once. Links that fail if the name is taken need a mounted file system, as shared folders of a
cluster are; other stores are refused."""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections import defaultdict
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

DIGITS = 2
#: Bytes of a bucket's objects that a task holds before it publishes them.
HELD = 32 << 20
OBJECT = pa.schema([("sha256", pa.string()), ("content", pa.binary())])


def mounted(path: str) -> str:
    """The path of a folder in the file system."""
    parts = urlsplit(path)
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path) and parts.scheme != "file":
        raise ValueError(f"the content store needs a mounted folder: {path!r}")
    return unquote(parts.path) if parts.scheme == "file" else path


class Bucket:
    """One bucket's versions, as far as this task has read them."""

    def __init__(self, folder: str):
        self.folder, self.known, self.version = folder, set(), 0
        os.makedirs(folder, exist_ok=True)

    def _file(self, version: int) -> str:
        return f"{self.folder}/{version:08d}.parquet"

    def refresh(self) -> None:
        while os.path.exists(self._file(self.version)):
            self.known.update(pq.read_table(self._file(self.version), columns=["sha256"])["sha256"].to_pylist())
            self.version += 1

    def publish(self, objects: dict[str, bytes]) -> int:
        """How many of the objects were new."""
        while True:
            self.refresh()
            new = {k: v for k, v in objects.items() if k not in self.known}
            if not new:
                return 0
            hidden = f"{self.folder}/.{uuid.uuid4().hex}"
            try:
                with open(hidden, "wb") as f:
                    pq.write_table(pa.table([list(new), list(new.values())], schema=OBJECT), f, compression="zstd")
                    f.flush()
                    os.fsync(f.fileno())
                os.link(hidden, self._file(self.version))
                return len(new)
            except FileExistsError:
                continue  # another writer has published this version
            finally:
                if os.path.exists(hidden):
                    os.remove(hidden)


class ContentStore(DataSource):
    """Writes (sha256, content); option path: the store's folder."""

    @classmethod
    def name(cls) -> str:
        return "content_store"

    def schema(self) -> str:
        return "sha256 string, content binary"

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("what is stored stays: append to the store")
        return _Writer(mounted(self.options["path"]))


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, batches):
        held: dict[str, dict[str, bytes]] = defaultdict(dict)
        size: dict[str, int] = defaultdict(int)
        buckets: dict[str, Bucket] = {}

        def put(name: str) -> None:
            if name not in buckets:
                buckets[name] = Bucket(f"{self.folder}/objects/{name}")
            buckets[name].publish(held.pop(name))
            size[name] = 0

        for b in batches:
            for sha, content in zip(b.column("sha256").to_pylist(), b.column("content").to_pylist()):
                if content is None or hashlib.sha256(content).hexdigest() != sha:
                    raise ValueError(f"content that isn't what its hash says: {sha}")
                name = sha[:DIGITS]
                held[name][sha] = content
                size[name] += len(content)
                if size[name] >= HELD:
                    put(name)
        for name in sorted(held):
            put(name)
        return WriterCommitMessage()

    def commit(self, messages) -> None:
        """Nothing left to do: what a task has published is in the store."""

    def abort(self, messages) -> None:
        """What tasks have published is whole, and stays."""


def store(spark: SparkSession, docs: DataFrame, folder: str) -> None:
    """Bytes (content) once by sha256; then a manifest row, all other columns, for every retrieval,
    in a folder of this run's own, as two runs can't append to one.

    A bucket is one task's alone, so a job competes with other jobs only; rows of equal hash meet nowhere but once a task."""
    spark.dataSource.register(ContentStore)
    new = docs.select("sha256", "content").dropDuplicates(["sha256"])
    new.repartition(F.substr("sha256", F.lit(1), F.lit(DIGITS))).write.format("content_store").option("path", folder).mode("append").save()
    docs.drop("content").write.json(f"{folder}/manifest/run={uuid.uuid4().hex}")


def objects(spark: SparkSession, folder: str) -> DataFrame:
    """(sha256, content) of everything stored."""
    return spark.read.schema("sha256 string, content binary").option("recursiveFileLookup", True).parquet(f"{folder}/objects")
