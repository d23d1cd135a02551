"""Structure profiles and drift."""

import pytest
from pyspark.sql import functions as F

from lexledger.sources import probe

PAGE = "<!DOCTYPE html><html><body><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table><p>x<br>y<p>z<img src=a></body></html>"


def test_html_paths():
    p = "/html/body"
    assert probe.html_paths(PAGE) == {"/html": 1, p: 1, f"{p}/ul": 1, f"{p}/ul/li": 2, f"{p}/table": 1, f"{p}/table/tr": 2, f"{p}/table/tr/td": 3, f"{p}/p": 2, f"{p}/p/br": 1, f"{p}/p/img": 1}
    assert probe.html_paths("") == {} and probe.html_paths("<b><i></b></x>") == {"/b": 1, "/b/i": 1}
    assert max(len(x.split("/")) for x in probe.html_paths("<div>" * 5000)) == probe.DEEPEST + 1


def test_json_paths():
    assert probe.json_paths('{"a": [{"b": 1}, {"b": null, "c": []}]}') == {"$": 1, "$.a": 1, "$.a[]": 2, "$.a[].b": 2, "$.a[].c": 1}
    assert probe.json_paths("{") == {"!": 1} and probe.json_paths("[" * 100_000) == {"!": 1}


def test_a_renamed_level_is_told_and_a_longer_list_is_not(spark):
    old = spark.createDataFrame([(PAGE,)] * 10 + [(None,)], "html string")
    longer = old.withColumn("html", F.replace("html", F.lit("<li>b"), F.lit("<li>b<li>c<li>d")))
    renamed = longer.withColumn("html", F.replace("html", F.lit("table>"), F.lit("section>")))
    a = probe.profile(old, "html", "html")
    assert {r.path: r.n_documents for r in a.filter("path IN ('', '/html')").collect()} == {"": 11, "/html": 10}
    assert probe.drift(a, probe.profile(longer, "html", "html")).count() == 0
    got = {r.path.rsplit("/body", 1)[1]: r.change for r in probe.drift(a, probe.profile(renamed, "html", "html")).collect()}
    assert got == {"/table": "LOST", "/table/tr": "LOST", "/table/tr/td": "LOST", "/section": "NEW", "/section/tr": "NEW", "/section/tr/td": "NEW"}


@pytest.mark.parametrize("share, told", [(0.5, {"$.b": "LESS"}), (0.97, {})])
def test_tolerance_and_merging(spark, share, told):
    full = spark.range(100).select(F.lit('{"a": 1, "b": 2}').alias("j"))
    some = spark.range(100).select(F.when(F.col("id") < 100 * share, '{"a": 1, "b": 2}').otherwise('{"a": 1}').alias("j"))
    now = probe.merged(probe.profile(some.limit(0), "j", "json").union(probe.profile(some, "j", "json")))
    assert {r.path: r.change for r in probe.drift(probe.profile(full, "j", "json"), now).collect()} == told


def test_no_documents(spark):
    none = probe.profile(spark.createDataFrame([], "x string"), "x", "html")
    assert none.filter("path <> ''").count() == 0 and probe.drift(none, none).count() == 0
