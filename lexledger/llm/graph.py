"""Connected components of an edge table, by least-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import settle


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, root): the least id of each component, for every id in edges (u bigint, v bigint).

    Joins and partially aggregated minima only: nobody gathers a node's neighbours. Labels are settled in the shared
    checkpoint folder each round; with pointer jumping a component of diameter d takes about log2(d) rounds."""
    both = settle(edges.filter("u <> v").select("u", "v").union(edges.filter("u <> v").select("v", "u")).distinct())
    labels = settle(both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("m")).select("id", F.least("id", "m").alias("root")))
    for _ in range(rounds):
        around = both.join(labels.select(F.col("id").alias("u"), "root"), "u").groupBy(F.col("v").alias("id")).agg(F.min("root").alias("m"))
        step = labels.join(around, "id").select("id", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        jump = step.join(labels.select(F.col("id").alias("root"), F.col("root").alias("up")), "root")
        new = settle(jump.select("id", F.least("root", "up").alias("root"), (F.least("root", "up") < F.col("old")).alias("moved")))
        labels = new.select("id", "root")
        if new.filter("moved").limit(1).count() == 0:
            return labels
    raise RuntimeError(f"components not found in {rounds} rounds")


def joined(labels: DataFrame, edges: DataFrame) -> tuple[DataFrame, int]:
    """Labels (id, root) after more edges (u, v), and how many components or new ids these have tied to others.

    Only edges between components are worked on."""
    own = labels.select(F.col("id").alias("u"), F.col("root").alias("a")), labels.select(F.col("id").alias("v"), F.col("root").alias("b"))
    between = edges.join(own[0], "u", "left").join(own[1], "v", "left").select(F.coalesce("a", "u").alias("u"), F.coalesce("b", "v").alias("v")).filter("u <> v").distinct()
    between = settle(between)
    if not between.limit(1).count():
        return labels, 0
    more = components(between)
    gained = more.filter("id <> root").count()
    fresh = more.join(labels, "id", "left_anti").select("id", F.col("id").alias("root"))
    up = more.select(F.col("id").alias("root"), F.col("root").alias("up"))
    return settle(labels.union(fresh).join(up, "root", "left").select("id", F.coalesce("up", "root").alias("root"))), gained
