"""Line dedup with overlapping three-line windows, in DataFrame functions only.

A window is three consecutive lines of one document. Its key is a pair of 64-bit hashes of the lines. Keys that occur
twice or more anywhere are grouped with their first occurrence (least doc_id, nulls last, then least line number; rows of
equal doc_id count one after another, by their text's hash and place in the input, which is made stable for that); each
later occurrence covers its three lines, covered positions merge, and covered lines go. Windows of blank lines
only don't count.

Shuffles: partially aggregated keys (a hot window arrives once from each task), the windows with the keys that repeat
(an equi-join whose hot keys AQE splits), and the texts with their covered positions. A document's positions are
bounded by its own lines; nothing gathers the documents of one window.

Defined results: null text has no lines and stays null; fewer than three lines never change; a line may go with a
later window although an earlier window that starts in it is kept; rows with the same doc_id and text, or without doc_id,
are documents of their own, so the second and further ones lose what the first has; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import stable

SIZE = 3


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with n_lines, n_removed and kept_text (the lines left, joined as they were)."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    body = F.col(f"`{text}`").cast("string")
    rows = stable(docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{doc_id}`").alias("id"), body.alias("body")))
    base = rows.select(*[f"k{i}" for i in range(len(keep))], "id", F.xxhash64("body").alias("h"), F.split("body", "\n").alias("lines"), F.monotonically_increasing_id().alias("row"))

    def window(i):
        at = [F.element_at("lines", i + j + 1) for j in range(SIZE)]
        return F.struct(i.alias("pos"), F.xxhash64(*at).alias("a"), F.xxhash64(F.lit("2"), *at).alias("b"), (F.trim(F.concat(*at)) == "").alias("blank"))

    windows = (
        base.select("id", "h", "row", "lines")
        .filter(F.size("lines") >= SIZE)
        .select("id", "h", "row", F.inline(F.transform(F.sequence(F.lit(0), F.size("lines") - SIZE), window)))
        .filter(~F.col("blank"))
        .select("id", "h", "row", "pos", "a", "b")
    )
    place = F.struct(F.col("id").isNull().alias("none"), "id", "h", "row", "pos")
    again = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("a").alias("a2"), F.col("b").alias("b2"), "first")
    later = (
        windows.join(again, (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2")))
        .filter(~place.eqNullSafe(F.col("first")))
        .groupBy(F.col("row").alias("row2"))
        .agg(F.collect_set("pos").alias("at"))
    )
    # Hash-based set functions, so a document of very many lines stays linear; ``lines`` is a column of the join's
    # input and not split again for each element.
    gone = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + (SIZE - 1)))))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone), lambda i: F.element_at("lines", i + 1))
    n = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long")
    return (
        base.join(later, F.col("row") == F.col("row2"), "left")
        .withColumn("left_lines", F.when(F.col("at").isNull(), F.col("lines")).otherwise(left))
        .select(
            *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
            n.alias("n_lines"),
            (n - F.when(F.col("lines").isNull(), 0).otherwise(F.size("left_lines"))).alias("n_removed"),
            F.array_join("left_lines", "\n").alias("kept_text"),
        )
    )


def op8(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return line_dedup(docs, keep=["doc_id"])


SQL = """
WITH lines AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS r, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
windows AS (
  SELECT r, i, ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] AS k
  FROM (SELECT r, ls, unnest(range(1, len(ls) - 1)) AS i FROM lines WHERE len(ls) >= 3)
  WHERE trim(ls[i] || ls[i + 1] || ls[i + 2]) <> ''
),
ranked AS (SELECT r, i, row_number() OVER (PARTITION BY k ORDER BY r, i) AS n FROM windows),
gone AS (SELECT DISTINCT r, i + j AS i FROM ranked, (SELECT unnest([0, 1, 2]) AS j) WHERE n > 1),
each_line AS (SELECT r, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM lines),
kept AS (
  SELECT e.r, count(g.i) AS n_removed, string_agg(CASE WHEN g.i IS NULL THEN e.line END, chr(10) ORDER BY e.i) AS t
  FROM each_line e LEFT JOIN gone g ON e.r = g.r AND e.i = g.i GROUP BY e.r
)
SELECT l.doc_id, coalesce(len(l.ls), 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(k.t, '') END AS kept_text
FROM lines l LEFT JOIN kept k ON l.r = k.r
"""
