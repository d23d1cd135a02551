"""Merkle trees over tables of any size: a logical hash without a single task, and changed rows without a full join.

A row's place in the tree is a path of hexadecimal digits: the first ``depth`` of its key's SHA-256 and then ``slots`` of
the SHA-256 of the whole canonical row. Rows of one key share a range of leaves, so a changed row stays in its range, and a
key that very many rows have is cut into slots, so no leaf grows with it. A leaf's digest is over its sorted distinct row
hashes with their counts (equal rows are counted in the tasks first); an inner node's over its children's, at most 16.
Depth and slots follow the row counts, so a leaf has some LEAF rows; trees to be compared are built alike.

Two trees are compared from the root down, level by level, children of differing nodes only. Rows are then read where leaves
differ; a table stored by path reads just those files."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexledger.operators.dataflow import canonical_row
from lexledger.streaming.incremental import shared_dir

LEAF = 4096
NODES = "level int, path string, digest string, n_rows bigint"


@dataclass
class Tree:
    """``nodes``: (level, path, digest, n_rows), the root at level 0 with an empty path."""

    nodes: DataFrame
    keys: list[str]
    depth: int
    slots: int

    def root(self) -> DataFrame:
        """(digest, n_rows); for an empty table the digest of nothing."""
        return self.nodes.filter("level = 0").agg(F.coalesce(F.max("digest"), F.sha2(F.lit(""), 256)).alias("digest"), F.coalesce(F.max("n_rows"), F.lit(0)).alias("n_rows"))

    def save(self, folder: str) -> None:
        self.nodes.write.mode("overwrite").partitionBy("level").parquet(folder)


def _digits(rows: int, leaf: int) -> int:
    return max(0, math.ceil(math.log(max(1, rows) / leaf, 16) - 1e-9))


def placed(df: DataFrame, keys: list[str], depth: int, slots: int) -> DataFrame:
    """The rows with _path and _hash."""
    row = F.sha2(canonical_row(df), 256)
    key = F.sha2(canonical_row(df.select(*keys)), 256) if keys else row
    # Both hashes are columns before they are cut, so each is made once.
    out = df.withColumns({"_hash": row, "_key": key})
    slot = F.substr("_hash", F.lit(1), F.lit(slots)) if slots else F.lit("")
    return out.withColumn("_path", F.concat(F.substr("_key", F.lit(1), F.lit(depth)) if depth else F.lit(""), slot)).drop("_key")


def tree(df: DataFrame, keys: list[str] = (), like: Tree | None = None, leaf: int = LEAF) -> Tree:
    """The table's tree; ``like``: with the depth and slots of another one. Without keys the row's hash is its key."""
    keys = list(keys) if like is None else like.keys
    if like is not None:
        depth, slots = like.depth, like.slots
    else:
        n = df.count()
        depth, slots = _digits(n, leaf), 0
        if keys:  # rows of the fullest range, by the keys alone
            ranges = placed(df.select(*keys), keys, depth, 0).groupBy("_path").count()
            slots = _digits(ranges.agg(F.max("count")).first()[0] or 0, 4 * leaf)
    shared_dir(df.sparkSession)
    # Hashes move as bytes, half as long as their digits, and sort alike.
    each = placed(df, keys, depth, slots).groupBy("_path", F.unhex("_hash").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    entries = F.transform(F.array_sort(F.collect_list(F.struct("h", "n"))), lambda x: F.concat_ws("*", F.lower(F.hex(x["h"])), x["n"].cast("string")))
    leaves = each.groupBy(F.col("_path").alias("path")).agg(F.sha2(F.array_join(entries, "\n"), 256).alias("digest"), F.sum("n").alias("n_rows")).checkpoint()
    level = leaves.select(F.lit(depth + slots).alias("level"), "path", "digest", "n_rows")
    nodes = level
    for at in range(depth + slots - 1, -1, -1):
        up = F.substr("path", F.lit(1), F.lit(at)) if at else F.lit("")
        child = F.struct(F.col("path"), F.col("digest"))
        level = level.groupBy(up.alias("path")).agg(F.array_sort(F.collect_list(child)).alias("c"), F.sum("n_rows").alias("n_rows"))
        level = level.select(F.lit(at).alias("level"), "path", F.sha2(F.array_join(F.transform("c", lambda x: F.concat(x["path"], F.lit(":"), x["digest"])), "\n"), 256).alias("digest"), "n_rows")
        nodes = nodes.unionByName(level)
    # Kept too: a comparison asks for level after level.
    return Tree(nodes.checkpoint(), keys, depth, slots)


def differing(a: Tree, b: Tree) -> DataFrame:
    """(path) of the leaves that differ, or that only one tree has."""
    if (a.keys, a.depth, a.slots) != (b.keys, b.depth, b.slots):
        raise ValueError("trees to be compared are built alike")
    up = None
    for at in range(a.depth + a.slots + 1):
        x, y = (t.nodes.filter(F.col("level") == at).select("path", F.col("digest").alias(d)) for t, d in ((a, "x"), (b, "y")))
        if up is not None:
            x, y = (n.withColumn("up", F.substr("path", F.lit(1), F.lit(at - 1))).join(up, "up", "left_semi").drop("up") for n in (x, y))
        found = x.join(y, "path", "full_outer").filter(~F.col("x").eqNullSafe(F.col("y"))).select("path")
        up = found.withColumnRenamed("path", "up")
    return found


def changes(before: DataFrame, after: DataFrame, a: Tree, b: Tree) -> DataFrame:
    """(keys, n_before, n_after, change): keys of rows that only one version has, with how many of each, by comparing
    the differing leaves only; all rows, if half of the leaves or more differ, as telling leaves apart would move more than
    it leaves out. ADDED, REMOVED, or CHANGED if the key has such rows in both."""
    if not a.keys:
        raise ValueError("changes are told by key")
    paths = differing(a, b).checkpoint()
    few = 2 * paths.count() < a.nodes.filter(F.col("level") == a.depth + a.slots).count()

    def side(df: DataFrame, old: int) -> DataFrame:
        rows = placed(df, a.keys, a.depth, a.slots)
        rows = rows.join(paths.withColumnRenamed("path", "_path"), "_path", "left_semi") if few else rows
        return rows.select(*a.keys, F.unhex("_hash").alias("_hash"), F.lit(old).alias("old"))

    each = side(before, 1).unionByName(side(after, 0)).groupBy(*a.keys, "_hash").agg(F.sum("old").alias("x"), F.sum(1 - F.col("old")).alias("y"))
    both = each.filter("x <> y")
    told = both.groupBy(*a.keys).agg(F.sum(F.greatest(F.col("x") - F.col("y"), F.lit(0))).alias("n_before"), F.sum(F.greatest(F.col("y") - F.col("x"), F.lit(0))).alias("n_after"))
    return told.withColumn("change", F.when(F.col("n_before") == 0, "ADDED").when(F.col("n_after") == 0, "REMOVED").otherwise("CHANGED"))
