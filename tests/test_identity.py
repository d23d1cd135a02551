"""Merkle trees and the write-once store."""

import glob
import hashlib
import os
import threading

import pytest
from pyspark.sql import functions as F

from lexledger.operators import merkle
from lexledger.sources import store


def root(t):
    return tuple(t.root().first())


def test_roots_follow_content_alone(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    a = merkle.tree(df, ["id"], leaf=64)
    assert a.depth == 2 and root(a)[1] == 3000
    assert root(merkle.tree(df.orderBy(F.desc("id")).repartition(9), like=a)) == root(a)
    for other in (df.filter("id <> 7"), df.union(df.filter("id = 7")), df.withColumn("name", F.when(F.col("id") != 7, F.col("name")))):
        assert root(merkle.tree(other, like=a))[0] != root(a)[0]
    assert root(merkle.tree(df.limit(0), ["id"])) == (hashlib.sha256(b"").hexdigest(), 0)
    with pytest.raises(TypeError):
        merkle.tree(spark.createDataFrame([(1.5,)], "x double"))


def test_a_leaf_digest_by_hand(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    rows = sorted([f'{sha("""{"k":1,"v":"a"}""")}*2', f'{sha("""{"k":2,"v":null}""")}*1'])
    assert root(merkle.tree(df, ["k"])) == (sha("\n".join(rows)), 3)


def test_only_differing_leaves_are_read(spark):
    df = spark.range(20_000).select("id", (F.col("id") * 2).alias("v"))
    a = merkle.tree(df, ["id"], leaf=64)
    after = df.filter("id <> 5").withColumn("v", F.when(F.col("id") == 9, -1).otherwise(F.col("v"))).union(spark.createDataFrame([(10**6, 1)], "id long, v long"))
    b = merkle.tree(after, like=a)
    assert merkle.differing(a, b).count() == 3 and merkle.differing(a, a).count() == 0
    got = {r.id: (r.n_before, r.n_after, r.change) for r in merkle.changes(df, after, a, b).collect()}
    assert got == {5: (1, 0, "REMOVED"), 9: (1, 1, "CHANGED"), 10**6: (0, 1, "ADDED")}
    with pytest.raises(ValueError):
        merkle.differing(a, merkle.tree(after, ["id"], leaf=4096))


def test_a_key_with_a_third_of_all_rows_is_cut_into_slots(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    a = merkle.tree(df, ["k"], leaf=64)
    assert a.slots >= 1
    leaves = a.nodes.filter(F.col("level") == a.depth + a.slots)
    assert leaves.agg(F.max("n_rows")).first()[0] < 600
    equal = df.union(spark.range(3000).select(F.lit(-2).cast("long"), F.lit(0).cast("long")))  # equal rows are one entry
    b = merkle.tree(equal, like=a)
    assert [(r.k, r.n_after, r.change) for r in merkle.changes(df, equal, a, b).collect()] == [(-2, 3000, "ADDED")]


def test_saved_trees_compare(spark, tmp_path):
    df = spark.range(500).select("id")
    a = merkle.tree(df, ["id"], leaf=16)
    a.save(str(tmp_path / "t"))
    back = merkle.Tree(spark.read.parquet(str(tmp_path / "t")).select("level", "path", "digest", "n_rows"), a.keys, a.depth, a.slots)
    b = merkle.tree(df.filter("id <> 3"), like=back)
    assert [r.id for r in merkle.changes(df, df.filter("id <> 3"), back, b).collect()] == [3]


def things(spark, ids):
    df = spark.createDataFrame([(i, f"object {i % 900}".encode()) for i in ids], "n int, content binary")
    return df.withColumn("sha256", F.sha2("content", 256))


def test_two_writers_at_once_store_each_hash_once(spark, tmp_path):
    folder, errors = str(tmp_path / "s"), []

    def run(ids):
        try:
            store.store(spark, things(spark, ids), folder)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(ids,)) for ids in (range(0, 700), range(300, 1200))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors, errors[0]
    got = store.objects(spark, folder)
    assert got.count() == 900 == got.select("sha256").distinct().count() == got.filter(F.sha2("content", 256) == F.col("sha256")).count()
    assert spark.read.json(f"{folder}/manifest").count() == 1600
    assert not glob.glob(f"{folder}/objects/*/.*")


def test_writers_of_one_bucket_take_turns(tmp_path):
    a, b = store.Bucket(str(tmp_path)), store.Bucket(str(tmp_path))
    assert a.publish({"1": b"x", "2": b"y"}) == 2
    assert b.publish({"2": b"y", "3": b"z"}) == 1  # b finds version 0 taken, and reads it
    assert a.publish({"3": b"z"}) == 0 and sorted(os.listdir(tmp_path)) == ["00000000.parquet", "00000001.parquet"]


def test_a_failed_task_leaves_no_torn_file(spark, tmp_path):
    folder = str(tmp_path / "s")
    bad = things(spark, range(300)).withColumn("content", F.when(F.col("n") == 299, F.lit(b"forged")).otherwise(F.col("content")))
    with pytest.raises(Exception, match="isn't what its hash says"):
        store.store(spark, bad, folder)
    assert not glob.glob(f"{folder}/objects/*/.*")
    store.store(spark, things(spark, range(300)), folder)
    got = store.objects(spark, folder)
    assert got.count() == 300 == got.select("sha256").distinct().count()


def test_stores_without_links_are_refused():
    with pytest.raises(ValueError):
        store.mounted("hdfs://host/x")
    assert store.mounted("file:///a/b%20c") == "/a/b c" and store.mounted("/a/b") == "/a/b"


@pytest.mark.parametrize("changed", [3, 400])
def test_rows_move_as_bytes_and_leaves_are_told_apart_only_where_few_differ(spark, changed):
    df = spark.range(2000).select("id", F.col("id").cast("string").alias("v"))
    after = df.withColumn("v", F.when(F.col("id") < changed, "x").otherwise(F.col("v")))
    a = merkle.tree(df, ["id"], leaf=16)
    out = merkle.changes(df, after, a, merkle.tree(after, like=a))
    assert sorted((r.id, r.n_before, r.n_after, r.change) for r in out.collect()) == [(i, 1, 1, "CHANGED") for i in range(changed)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("LeftSemi" in plan) == (changed == 3) and "unhex" in plan
