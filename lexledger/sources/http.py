"""Documents over HTTP, polite by host: pauses, retries and a size limit, as a data source and as a step over a table of URLs.

spark.dataSource.register(HttpDocuments)
spark.read.format("http_documents").option("urls", "\\n".join(urls)).load()  # url, status, content, sha256, retrieved_at

A host is one partition's alone, as pauses would mean nothing to several clients; different hosts run side by side. Within a
partition the hosts' requests interleave: a host gets its next request when its pause, or the wait before a repetition, is
over, and other hosts' requests fill the time."""

from __future__ import annotations

import hashlib
import heapq
import time
import urllib.error
import urllib.request
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, status int, content binary, sha256 string, retrieved_at timestamp"
# Seconds between requests, seconds for a request, tries and seconds before the first repetition, bytes.
PAUSE, TIMEOUT, TRIES, FIRST_WAIT, MOST_BYTES = 0.5, 30.0, 3, 2.0, 64 << 20
#: URLs of a partition that are known ahead, so that its hosts can interleave.
AHEAD = 10_000


def host_of(url: str) -> str:
    return urlsplit(url or "").netloc.lower()


def _get(url: str) -> tuple[int, bytes | None]:
    """Status and body; status 0 for no answer."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "lexledger"}), timeout=TIMEOUT) as answer:
            body = answer.read(MOST_BYTES + 1)
            return (answer.status, body) if len(body) <= MOST_BYTES else (413, None)
    except urllib.error.HTTPError as e:
        return e.code, None
    except (OSError, ValueError):
        return 0, None


def politely(urls: Iterator[str], pause: float = PAUSE, wait: float = FIRST_WAIT, tries: int = TRIES) -> Iterator[tuple]:
    """(place in ``urls``, status, body) of each, in the order in which they are settled."""
    urls = enumerate(urls)
    waiting: dict[str, deque] = {}
    due: list[tuple[float, str]] = []
    n, more = 0, True
    while True:
        while more and n < AHEAD:
            at, url = next(urls, (None, None))
            if at is None:
                more = False
                break
            host = host_of(url)
            if host not in waiting:
                waiting[host] = deque()
                heapq.heappush(due, (time.monotonic(), host))
            waiting[host].append((at, url, 1))
            n += 1
        if not due:
            return
        when, host = heapq.heappop(due)
        if not waiting[host]:
            del waiting[host]
            continue
        time.sleep(max(0.0, when - time.monotonic()))
        at, url, attempt = waiting[host].popleft()
        status, body = _get(url)
        again = (status in (0, 429) or status >= 500) and attempt < tries
        if again:
            waiting[host].appendleft((at, url, attempt + 1))
        else:
            n -= 1
        # The host stays known while its pause lasts, so a URL that comes in meanwhile waits too.
        heapq.heappush(due, (time.monotonic() + max(pause, wait * 2 ** (attempt - 1) if again else 0.0), host))
        if not again:
            yield at, status, body


def _row(url: str, status: int, body: bytes | None) -> tuple:
    return url, status, body, hashlib.sha256(body).hexdigest() if body is not None else None, datetime.now(UTC).replace(tzinfo=None)


class HttpDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "http_documents"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


@dataclass
class Host(InputPartition):
    urls: list[str]


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.urls = [u for u in options["urls"].split("\n") if u]
        self.pause, self.wait = float(options.get("pause", PAUSE)), float(options.get("wait", FIRST_WAIT))

    def partitions(self):
        hosts: dict[str, list[str]] = {}
        for u in self.urls:
            hosts.setdefault(host_of(u), []).append(u)
        return [Host(x) for x in hosts.values()] or [Host([])]

    def read(self, partition: Host):
        for at, status, body in politely(iter(partition.urls), self.pause, self.wait):
            yield _row(partition.urls[at], status, body)


def fetched(urls: DataFrame, url: str = "url", pause: float = PAUSE, wait: float = FIRST_WAIT, tasks: int = 16) -> DataFrame:
    """The table's rows with status, content, sha256 and retrieved_at: one task has all URLs of a host, and a task at most
    one request at a time. Rows without a URL have status 0."""
    schema = urls.schema
    names = schema.names

    def run(batches):
        held: list[dict] = []

        def each():
            for b in batches:
                for r in b.to_pylist():
                    held.append(r)
                    yield r[url] or ""

        for at, status, body in politely(each(), pause, wait):
            _, _, body, sha, when = _row("", status, body)
            row, held[at] = held[at], None
            yield pa.RecordBatch.from_pylist([{**row, "status": status, "content": body, "sha256": sha, "retrieved_at": when.replace(tzinfo=UTC)}], schema=pa.schema([*kinds, ("status", pa.int32()), ("content", pa.binary()), ("sha256", pa.string()), ("retrieved_at", pa.timestamp("us", "UTC"))]))

    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = list(to_arrow_schema(schema))
    by_host = urls.repartition(tasks, F.lower(F.coalesce(F.try_parse_url(F.col(url), F.lit("AUTHORITY")), F.lit(""))))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if clash := {"status", "content", "sha256", "retrieved_at"} & set(names):
        raise ValueError(f"columns have names of results: {sorted(clash)}")
    return by_host.mapInArrow(run, f"{columns}, status int, content binary, sha256 string, retrieved_at timestamp")
