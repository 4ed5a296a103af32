"""Poll state in a stream: it survives a restart, and equals the batch rule."""

from __future__ import annotations

import os
from collections import Counter
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from threatlake.sources import feeds
from threatlake.streaming import polling

T0 = 1_700_000_000


def stamp(seconds):
    return datetime.fromtimestamp(T0 + seconds, UTC)


class Stream:
    """Events by batches, each one run of the stream from its checkpoint."""

    def __init__(self, spark, at):
        self.spark, self.at, self.seen = spark, at, Counter()
        os.makedirs(f"{at}/events")

    def run(self, *events):
        rows = [(f, f"https://{h}.example/{f}", kind, stamp(at), 10, enabled, None) for f, h, kind, at, enabled in events]
        self.spark.createDataFrame(rows, polling.EVENTS).coalesce(1).write.mode("append").parquet(f"{self.at}/events")
        due = polling.due_feeds(self.spark.readStream.schema(polling.EVENTS).parquet(f"{self.at}/events"), by_event_time=True)
        out = f"{self.at}/out"
        due.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{self.at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        got = self.spark.read.schema(polling.DUE).parquet(out).collect() if os.path.exists(out) else []
        now = Counter((r.feed_id, int(r.due_at.timestamp()) - T0, int(r.ask_at.timestamp()) - T0) for r in got)
        new, self.seen = now - self.seen, now
        return sorted(new.elements())


@pytest.fixture(scope="module")
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(key)


def test_due_pauses_and_restarts(rocks, tmp_path):
    s = Stream(rocks, str(tmp_path))
    clock = ("clock", "other", "feed", 0, False)
    tick = lambda at: ("clock", "other", "feed", at, False)  # noqa: E731  moves the watermark
    # Polled at 0: three feeds of one host, one of another, one that is switched off.
    start = [(f, h, kind, 0, e) for f, h, e in (("a", "h1", True), ("b", "h1", True), ("c", "h2", True), ("off", "h2", False)) for kind in ("feed", "ok")]
    assert s.run(*start, clock) == []
    assert s.run(tick(599)) == []
    # Ten minutes later all are due; the second feed of a host is asked for two seconds after the first.
    assert s.run(tick(601)) == [("a", 600, 601), ("b", 600, 603), ("c", 600, 601)]
    # a fails, b answers, c never does.
    assert s.run(("a", "h1", "error", 603, True), ("b", "h1", "ok", 604, True), tick(604)) == []
    assert s.run(tick(662)) == []
    assert s.run(tick(664)) == [("a", 663, 664)]
    assert s.run(("a", "h1", "error", 665, True), tick(784)) == []
    assert s.run(tick(786)) == [("a", 785, 786)]
    assert s.run(("a", "h1", "ok", 790, True), tick(1199)) == []
    # c, asked for at 601, is due again after its interval; b from its last answer.
    assert s.run(tick(1206)) == [("b", 1204, 1206), ("c", 1201, 1206)]


def test_equals_the_batch_rule(rocks, tmp_path):
    """Each run's feeds, answered at once, are those that due() gives for the table at that time."""
    s, polled = Stream(rocks, str(tmp_path)), {f"f{k}": 37 * k for k in range(12)}
    s.run(*[(f, f"h{int(f[1:]) % 3}", kind, at, True) for f, at in polled.items() for kind in ("feed", "ok")], ("clock", "other", "feed", 407, False))
    for now in (640, 800, 1015):
        rows = [(f, T0 + at) for f, at in polled.items()]
        table = rocks.createDataFrame(rows, "name string, at long").select("name", F.timestamp_seconds("at").alias("last_polled_at"), F.lit(10).alias("poll_interval_minutes"), F.lit(True).alias("enabled"))
        want = {r.name for r in feeds.due(table, str(stamp(now - 0.001).replace(tzinfo=None))).collect()}
        got = {f for f, _, _ in s.run(("clock", "other", "feed", now, False))}
        assert got == want and got
        s.run(*[(f, f"h{int(f[1:]) % 3}", "ok", now, True) for f in got])
        polled |= dict.fromkeys(got, now)
