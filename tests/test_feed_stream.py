"""The feed data source: rounds that survive a crash without a second request, validators as offsets."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from threatlake.operators.store import Store
from threatlake.sources import feed_stream, feeds

REPO = str(Path(__file__).resolve().parents[1])
CHILD = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from threatlake.sources import feed_stream
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.task.maxFailures", "1").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
rows = feed_stream.read_stream(spark, [{registry!r}], {landing!r}, client="tests.feed_stand_in:Client", clock="tests.feed_stand_in:clock", partitions="2")
q = rows.writeStream.format("parquet").option("checkpointLocation", {checkpoint!r}).option("path", {out!r}).trigger(availableNow=True).start()
q.awaitTermination()
"""

FOLLOW = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from threatlake.operators.store import Store
from threatlake.plans import ingest
from threatlake.schemas import FEED
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
store = Store(spark, {out!r})
if store.read("feed").isEmpty():
    store.replace("feed", spark.read.parquet({registry!r}).selectExpr("id", "id as name", "url", "'rss' as kind", "poll_interval_minutes", "etag", "last_modified", "last_polled_at", "enabled", "false as fetch_articles"))
ingest.follow(store, {landing!r}, {checkpoint!r}, client="tests.feed_stand_in:Client", clock="tests.feed_stand_in:clock", partitions="2").awaitTermination()
"""


class World:
    """A folder with the clock, the feeds' version and a log of requests; run() is one run of the stream in a process of its own."""

    def __init__(self, spark, tmp_path):
        self.spark, self.at = spark, tmp_path
        (tmp_path / "world").mkdir()
        rows = [(f"f{k}", f"https://host{k % 3}.example/{'broken' if k == 5 else 'feed'}{k}", None, None, None, 10, k != 4) for k in range(6)]
        spark.createDataFrame(rows, "id string, url string, etag string, last_modified string, last_polled_at timestamp, poll_interval_minutes int, enabled boolean").coalesce(1).write.parquet(str(tmp_path / "registry"))
        self.put("clock", "1000")
        self.put("version", "v1")

    def put(self, name, text):
        (self.at / "world" / name).write_text(text)

    def asked(self):
        """The requests since the last call."""
        out = []
        for p in sorted((self.at / "world").glob("get-*")):
            out.append(tuple(p.read_text().replace("https://", "").split(" ")))
            p.unlink()
        return sorted(out)

    def run(self, script=CHILD):
        paths = {n: str(self.at / n) for n in ("registry", "landing", "checkpoint", "out")}
        env = os.environ | {"FEED_STAND_IN": str(self.at / "world"), "PYTHONPATH": REPO, "PYSPARK_PYTHON": sys.executable}
        return subprocess.run([sys.executable, "-c", script.format(repo=REPO, **paths)], env=env, cwd=REPO, capture_output=True, timeout=180).returncode

    def rows(self):
        return sorted((r.feed_id, r.status, r.etag, int(r.polled_at.timestamp())) for r in self.spark.read.parquet(str(self.at / "out")).collect())


FIRST = [("host0.example/feed0", "None"), ("host0.example/feed3", "None"), ("host1.example/feed1", "None"), ("host2.example/broken5", "None"), ("host2.example/feed2", "None")]


def test_rounds(spark, tmp_path):
    w = World(spark, tmp_path)
    assert w.run() == 0
    assert w.asked() == FIRST
    assert [r[:3] for r in w.rows()] == [("f0", "ok", "v1"), ("f1", "ok", "v1"), ("f2", "ok", "v1"), ("f3", "ok", "v1"), ("f5", "error", None)]
    assert w.run() == 0 and w.asked() == []  # nothing is due
    w.put("clock", "1061")
    assert w.run() == 0 and w.asked() == [("host2.example/broken5", "None")]  # after its pause
    w.put("clock", "1100")
    assert w.run() == 0 and w.asked() == []  # the pause has doubled
    w.put("clock", "1600")
    w.put("mended", "")
    assert w.run() == 0
    assert w.asked() == [(u, "None" if "broken" in u else "v1") for u, _ in FIRST]
    assert sorted(r[:2] for r in w.rows() if r[3] == 1600) == [("f0", "not_modified"), ("f1", "not_modified"), ("f2", "not_modified"), ("f3", "not_modified"), ("f5", "ok")]


def test_a_crash_asks_no_feed_twice(spark, tmp_path):
    w = World(spark, tmp_path)
    w.put("crash", "")
    assert w.run() != 0  # a worker dies while host1's feed is asked
    first = w.asked()
    assert ("host1.example/feed1", "None") in first
    (w.at / "world" / "crash").unlink()
    w.put("clock", "1500")
    assert w.run() == 0
    again = w.asked()
    # What had been landed isn't asked for again; the one that was lost is.
    assert ("host1.example/feed1", "None") in again
    assert sorted(set(first) | set(again)) == FIRST and set(first) & set(again) <= {("host1.example/feed1", "None")}
    assert sorted(r[0] for r in w.rows()) == ["f0", "f1", "f2", "f3", "f5"]


def test_follow_stores_each_round(spark, tmp_path):
    w = World(spark, tmp_path)
    store = Store(spark, str(tmp_path / "out"))
    for clock, version, documents in (("1000", "v1", 4), ("1700", "v1", 4), ("2400", "v2", 8)):
        w.put("clock", clock)
        w.put("version", version)
        assert w.run(FOLLOW) == 0
        assert store.read("raw_document").count() == documents
        feed = {r.id: (r.etag, r.last_polled_at and int(r.last_polled_at.timestamp())) for r in store.read("feed").collect()}
        assert feed == {f"f{k}": (version, int(clock)) for k in range(4)} | {"f4": (None, None), "f5": (None, None)}


def test_batch_and_partitions(spark, tmp_path, monkeypatch):
    w = World(spark, tmp_path)
    asked = [feed_stream.Asked(str(k), f"https://h{k % 7}.example/{k}") for k in range(50)]
    parts = feed_stream.by_host(asked, 4)
    assert sorted(a.feed_id for p in parts.values() for a in p) == sorted(a.feed_id for a in asked)
    hosts = [{a.url.split("/")[2] for a in p} for p in parts.values()]
    assert sum(map(len, hosts)) == 7
    monkeypatch.setenv("FEED_STAND_IN", str(w.at / "world"))
    reader = feed_stream.FeedReader({"registry": str(w.at / "registry"), "client": "tests.feed_stand_in:Client", "clock": "tests.feed_stand_in:clock"})
    got = sorted((r[0], r[5]) for p in reader.partitions() for r in reader.read(p))
    assert got == [("f0", "ok"), ("f1", "ok"), ("f2", "ok"), ("f3", "ok"), ("f5", "error")]


@pytest.mark.parametrize(("polled", "failures", "tried", "due"), [(None, 0, None, 0), (100.0, 0, None, 700), (100.0, 1, 700.0, 760), (100.0, 3, 700.0, 940), (None, 90, 700.0, 1300)])
def test_next_due(polled, failures, tried, due):
    assert feeds.next_due(polled, 10, failures, tried) == due
