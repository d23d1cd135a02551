"""Structure probes: which paths documents have, and how that drifts from a profile taken before.

A profile has a row for each path with the number of documents that have it and its occurrences; row "" counts all documents.
Profiles of parts add up, so they are taken in the tasks and merged. HTML paths are element names from the root, JSON paths
keys with [] for lists. Drift compares the shares of documents that have a path: a renamed table or level is told as one path
lost and one new, a longer list or a longer page is not, as it only changes occurrences."""

from __future__ import annotations

import json
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements without an end, and those whose end may be left out with what ends them.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ENDED_BY = {"li": {"li"}, "p": {"p", "div", "ul", "ol", "table", "section", "article", "h1", "h2", "h3", "h4"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
DEEPEST, MOST = 64, 5000
SCHEMA = pa.schema([("path", pa.string()), ("n_documents", pa.int64()), ("n_occurrences", pa.int64())])


class _Paths(HTMLParser):
    def __init__(self):
        super().__init__()
        self.open: list[str] = []
        self.found: Counter = Counter()

    def handle_starttag(self, tag, attrs):
        while self.open and tag in ENDED_BY.get(self.open[-1], ()):
            self.open.pop()
        if len(self.open) < DEEPEST:
            self.found["/" + "/".join([*self.open, tag])] += 1
            if tag not in VOID:
                self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        if len(self.open) < DEEPEST:
            self.found["/" + "/".join([*self.open, tag])] += 1

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                pass


def html_paths(text: str) -> Counter:
    p = _Paths()
    p.feed(text)
    p.close()
    return p.found


def json_paths(text: str) -> Counter:
    """Paths of a JSON document; ``!`` alone if it is none."""
    try:
        stack = [("$", json.loads(text))]
    except (ValueError, RecursionError):
        return Counter({"!": 1})
    found: Counter = Counter()
    while stack:
        path, v = stack.pop()
        found[path] += 1
        if isinstance(v, dict):
            stack += [(f"{path}.{k}", x) for k, x in v.items()]
        elif isinstance(v, list):
            stack += [(f"{path}[]", x) for x in v]
    return found


KINDS = {"html": html_paths, "json": json_paths}


def profile(docs: DataFrame, content: str, kind: str) -> DataFrame:
    """(path, n_documents, n_occurrences) over all documents; a null document has no paths."""
    paths = KINDS[kind]

    def run(batches):
        have, times = Counter(), Counter()

        def rows():
            return pa.RecordBatch.from_pydict({"path": list(have), "n_documents": list(have.values()), "n_occurrences": [times[p] for p in have]}, schema=SCHEMA)

        for b in batches:
            for x in b.column(0).to_pylist():
                found = paths(x) if x is not None else Counter()
                have.update(["", *found])
                times.update(found)
                times[""] += 1
            if len(have) > MOST:  # names made up by each document would else pile up here
                yield rows()
                have, times = Counter(), Counter()
        yield rows()

    each = docs.select(F.col(content).cast("string").alias("x")).mapInArrow(run, "path string, n_documents bigint, n_occurrences bigint")
    return merged(each)


def merged(profiles: DataFrame) -> DataFrame:
    """One profile of several, by union."""
    return profiles.groupBy("path").agg(F.sum("n_documents").alias("n_documents"), F.sum("n_occurrences").alias("n_occurrences"))


def drift(before: DataFrame, now: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """(path, share_before, share_now, change): paths whose share of the documents has moved by more than the tolerance.
    LOST if no document has it now, NEW if none had it before, else LESS or MORE; a profile of no documents has no shares."""

    def shares(p: DataFrame, name: str) -> DataFrame:
        total = p.filter("path = ''").agg(F.max("n_documents").alias("total"))
        return p.filter("path <> ''").join(F.broadcast(total)).select("path", (F.col("n_documents") / F.col("total")).alias(name))

    both = shares(before, "b").join(shares(now, "n"), "path", "full_outer").select("path", F.coalesce("b", F.lit(0.0)).alias("share_before"), F.coalesce("n", F.lit(0.0)).alias("share_now"))
    change = F.when(F.col("share_now") == 0, "LOST").when(F.col("share_before") == 0, "NEW").when(F.col("share_now") < F.col("share_before"), "LESS").otherwise("MORE")
    return both.filter(F.abs(F.col("share_now") - F.col("share_before")) > tolerance).withColumn("change", change)
