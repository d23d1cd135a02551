"""Streams that are stopped and started again: enumeration, observation, first sightings; polite fetching."""

import http.server
import threading
import time
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lexledger.sources import http as fetching
from lexledger.streaming import enumeration, incremental, observation

HEAD, TAIL = '{"data":{"sumario":{"diario":[{"seccion":{"codigo":"3","departamento":{"codigo":"1040","item":[', "]}}}]}}}"


def summary(*ids):
    return HEAD + ",".join(f'{{"identificador":"{i}","titulo":"Resolución de sanción"}}' for i in ids) + TAIL


def table(spark, rows):
    return spark.createDataFrame([(date(2020, 1, d), p, e) for d, p, e in rows], "day date, payload string, error string")


def looks(spark, folder):
    return Counter(r.day.day for r in enumeration.manifest(spark, folder).collect())


def test_enumeration_goes_on_where_it_was_killed(spark, tmp_path):
    folder, t = str(tmp_path / "e"), table(spark, [(d, summary(f"A-{d}"), None) for d in range(1, 21) if d != 4])
    seen = []

    def dies(days):
        seen.append(sorted(r.day.day for r in days.collect()))
        if len(seen) == 3:
            raise ConnectionError
        return days.join(t, "day")

    with pytest.raises(StreamingQueryException):
        enumeration.enumerate_days(spark, "2020-01-01", "2020-01-20", dies, folder, batch_days=5, split_days=2)
    assert seen == [[1, 2, 3, 4, 5], [6, 7, 8, 9, 10], [11, 12, 13, 14, 15]] and set(looks(spark, folder)) == set(range(1, 11))
    got = {r.day.day: r for r in enumeration.enumerate_days(spark, "2020-01-01", "2020-01-20", enumeration.summaries_in(t), folder, batch_days=5).collect()}
    assert looks(spark, folder) == Counter(range(1, 21))  # each day once
    assert got[4].items == [] and got[4].error is None and got[4].attempts == 1  # a day without a summary is settled
    assert [i.boe_id for i in got[20].items] == ["A-20"] and got[20].items[0].sanction_like
    enumeration.enumerate_days(spark, "2020-01-01", "2020-01-22", enumeration.summaries_in(t), folder, batch_days=5)
    assert looks(spark, folder) == Counter(range(1, 23))  # a longer calendar on the same folder: the new days only


def test_failed_days_are_offered_again(spark, tmp_path):
    folder = str(tmp_path / "e")
    bad = table(spark, [(1, summary("A-1"), None), (2, None, "status 503"), (3, "{no json", None), (5, None, "status 503")])
    first = {r.day.day: r.error for r in enumeration.enumerate_days(spark, "2020-01-01", "2020-01-05", enumeration.summaries_in(bad), folder, batch_days=2).collect()}
    assert first == {1: None, 2: "status 503", 3: "unreadable summary", 4: None, 5: "status 503"}
    good = table(spark, [(2, summary("A-2", "B-2"), None), (3, summary("A-3"), None), (5, None, "status 500")])
    got = {r.day.day: (len(r.items), r.error, r.attempts) for r in enumeration.enumerate_days(spark, "2020-01-01", "2020-01-06", enumeration.summaries_in(good), folder, batch_days=2).collect()}
    assert got == {1: (1, None, 1), 2: (2, None, 2), 3: (1, None, 2), 4: (0, None, 1), 5: (0, "status 500", 2), 6: (0, None, 1)}


def test_a_batch_that_was_planned_is_planned_alike(spark):
    r = enumeration._Days({"start": "2020-01-01", "end": "2020-01-10", "batch_days": "4", "split_days": "3", "again": "2019-05-01,2019-05-02"})
    a = r.initialOffset()
    b, c = r.latestOffset(), r.latestOffset()  # asked twice before anything is planned
    days = [d for p in r.partitions(a, c) for d in p.days]
    assert sorted(days) == ["2019-05-01", "2019-05-02", *[f"2020-01-0{i}" for i in range(1, 7)]] and b["round"] == 1
    again = enumeration._Days({"start": "2020-01-01", "end": "2020-01-10", "batch_days": "4"})
    assert again.partitions(c, c) == [] and [d for p in again.partitions(a, c) for d in p.days] == days
    assert again.latestOffset() == {"next": "2020-01-11", "again": "", "round": 3} == again.latestOffset()


def look(spark, folder, rows):
    spark.createDataFrame(rows, "id string, sha256 string, notes string, observed_at timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema("id string, sha256 string, notes string, observed_at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def test_observation_goes_on_from_its_state(spark, tmp_path):
    folder, day = str(tmp_path), lambda d: datetime(2020, 1, d)
    first = look(spark, folder, [("a", "1", "n", day(1)), ("b", "1", None, day(1)), (None, "1", None, day(1)), ("a", "1", "m", day(2))])
    got = {r.id: r for r in observation.observe_stream(spark, first, "id", f"{folder}/out").collect()}
    assert (got["a"].changes, got["a"].note_changes, got["a"].notes) == (0, 1, "m") and set(got) == {"a", "b"}
    second = look(spark, folder, [("a", "2", "m", day(4)), ("a", None, None, day(5)), ("c", "9", None, day(3)), ("b", "0", None, datetime(2019, 12, 30))])
    got = {r.id: r for r in observation.observe_stream(spark, second, "id", f"{folder}/out").collect()}
    assert (got["a"].sha256, got["a"].changes, got["a"].first_observed_at.day, got["a"].observed_at.day) == ("2", 1, 1, 5)
    assert (got["b"].sha256, got["b"].changes, got["b"].first_observed_at.year, got["b"].observed_at.day) == ("1", 0, 2019, 1)  # an old look
    wrote = lambda: [set(r.ids) for r in spark.read.parquet(f"{folder}/out/log").groupBy("batch").agg(F.collect_list("id").alias("ids")).orderBy("batch").collect()]
    assert wrote() == [{"a", "b"}, {"a", "b", "c"}]  # a batch writes its own keys only
    assert observation.observe_stream(spark, look(spark, folder, [("d", "1", None, day(6))]), "id", f"{folder}/out").count() == 4
    assert wrote() == [{"a", "b"}, {"a", "b", "c"}, {"d"}]


def test_keys_expire_and_come_back(spark, tmp_path):
    folder, day = str(tmp_path), lambda d: datetime(2020, 1, d)
    run = lambda rows: {r.id: (r.expired, r.changes) for r in observation.observe_stream(spark, look(spark, folder, rows), "id", f"{folder}/out", keep_days=5).collect()}
    assert run([("a", "1", None, day(1)), ("b", "1", None, day(1))]) == {"a": (False, 0), "b": (False, 0)}
    assert run([("b", "1", None, day(4)), ("c", "1", None, day(8))])["c"] == (False, 0)
    assert run([("c", "1", None, day(12))]) == {"a": (True, 0), "b": (True, 0), "c": (False, 0)}
    assert run([("a", "2", None, day(13))])["a"] == (False, 1)


def test_first_seen_on_the_same_folder(spark, tmp_path):
    source = look(spark, str(tmp_path), [("a", "1", None, datetime(2020, 1, 1))]).select("id")
    assert incremental.first_seen(spark, source, ["id"], f"{tmp_path}/f").count() == 1
    source = look(spark, str(tmp_path), [("a", "1", None, datetime(2020, 1, 1)), ("b", "1", None, datetime(2020, 1, 1))]).select("id")
    assert sorted(r.id for r in incremental.first_seen(spark, source, ["id"], f"{tmp_path}/f").collect()) == ["a", "b"]


@pytest.fixture
def servers():
    hits, out = [], []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            hits.append((self.headers["Host"], self.path, time.monotonic()))
            busy = self.path == "/busy" and sum(h[:2] == (self.headers["Host"], "/busy") for h in hits) < 2
            body = summary("A-" + self.path[-2:]).encode() if self.path[1:].isdigit() else b"ok"
            self.send_response(503 if busy else 404 if self.path.endswith("05") or self.path == "/none" else 200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    for _ in range(3):
        s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=s.serve_forever, daemon=True).start()
        out.append(s)
    yield [f"http://127.0.0.1:{s.server_port}" for s in out], hits
    for s in out:
        s.shutdown()


def test_hosts_run_side_by_side_and_none_too_often(servers):
    bases, hits = servers
    urls = [f"{b}/{i}" for i in range(4) for b in bases] + [f"{bases[0]}/busy"]
    began = time.monotonic()
    got = {urls[at]: (status, body) for at, status, body in fetching.politely(iter(urls), pause=0.3, wait=0.6)}
    took = time.monotonic() - began
    assert set(got) == set(urls) and got[f"{bases[0]}/busy"] == (200, b"ok")
    for b in bases:
        at = [t for h, _, t in hits if b.endswith(h)]
        assert all(y - x >= 0.28 for x, y in zip(at, at[1:]))
    assert took < 3.5  # 13 requests and one repetition one after another would take 4.2 seconds and more


def test_a_table_of_urls(spark, servers):
    bases, hits = servers
    rows = [(i, f"{b}/{i}") for i in range(3) for b in bases] + [(7, f"{bases[1]}/none"), (8, None), (9, "no url at all")]
    got = fetching.fetched(spark.createDataFrame(rows, "n int, url string"), pause=0.3, wait=0.1, tasks=4).collect()
    assert len(got) == len(rows) and {r.n: r.status for r in got if r.n > 6} == {7: 404, 8: 0, 9: 0}
    assert all(r.content and r.sha256 for r in got if r.n < 3)
    for b in bases:
        at = sorted(t for h, _, t in hits if b.endswith(h))
        assert all(y - x >= 0.28 for x, y in zip(at, at[1:]))
    with pytest.raises(ValueError):
        fetching.fetched(spark.range(1).select(F.lit("x").alias("url"), F.lit(1).alias("status")))


def test_enumeration_over_http(spark, servers, tmp_path):
    (base, *_), _ = servers
    fetch = enumeration.summaries_over_http(base + "/{yyyymmdd}", pause=0.01, wait=0.01)
    got = {r.day.day: ([i.boe_id for i in r.items], r.error) for r in enumeration.enumerate_days(spark, "2020-01-03", "2020-01-06", fetch, str(tmp_path / "e")).collect()}
    assert got == {3: (["A-03"], None), 4: (["A-04"], None), 5: ([], None), 6: (["A-06"], None)}
