"""Poll state of feeds in a stream: due times, pauses after failures and between requests of one host, by timers.

Input are events of two kinds: what the registry says of a feed, and what a request
of it came to. State is kept by host: a record for each feed and one timer at the
host's earliest due time. When it expires the feeds that are due by then are
emitted, each some seconds after the one before, as one host isn't asked for two at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import text as X
from ..sources.feeds import next_due
from ..sources.fetch import DELAY_SECONDS

#: feed: the registry's row (interval, enabled, and polled_at, if it was polled before); ok, not_modified, error: a request's end.
EVENTS = "feed_id string, url string, kind string, at timestamp, poll_interval_minutes int, enabled boolean, polled_at timestamp"
DUE = "feed_id string, host string, due_at timestamp, ask_at timestamp"
RECORD = "interval int, enabled boolean, polled double, failures int, tried double, asked double"
NEVER = -1.0


class PollState(StatefulProcessor):
    """Feeds of a host; times are seconds since 1970, NEVER where there is none."""

    def __init__(self, by_event_time: bool):
        self.by_event_time = by_event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.feeds = handle.getMapState("feeds", "feed_id string", RECORD)
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for r in batch.sort_values("at", kind="stable").itertuples(index=False):
                self._event(r)
        self._set_timer()
        yield pd.DataFrame(columns=["feed_id", "host", "due_at", "ask_at"])

    def _event(self, r) -> None:
        at = r.at.timestamp()
        interval, enabled, polled, failures, tried, asked = self.feeds.getValue((r.feed_id,)) if self.feeds.containsKey((r.feed_id,)) else (0, False, NEVER, 0, NEVER, NEVER)
        if r.kind == "feed":
            interval, enabled = int(r.poll_interval_minutes), bool(r.enabled)
            if not pd.isna(r.polled_at):
                polled = max(polled, r.polled_at.timestamp())
        elif r.kind == "error":
            failures, tried, asked = failures + 1, at, NEVER
        else:
            polled, failures, tried, asked = max(polled, at), 0, NEVER, NEVER
        self.feeds.updateValue((r.feed_id,), (interval, enabled, polled, failures, tried, asked))

    @staticmethod
    def _due(record) -> float | None:
        """When a feed is due, None if it isn't asked for; one that was emitted and never answered is due again after its interval."""
        interval, enabled, polled, failures, tried, asked = record
        if not enabled:
            return None
        due = next_due(None if polled == NEVER else polled, interval, failures, None if tried == NEVER else tried)
        return due if asked == NEVER else max(due, asked + 60 * interval)

    def _set_timer(self) -> None:
        times = [d for _, record in self.feeds.iterator() if (d := self._due(record)) is not None]
        old = self.timer.get()[0] if self.timer.exists() else None
        new = int(min(times) * 1000) if times else None
        if old is not None and old != new:
            self.handle.deleteTimer(old)
            self.timer.clear()
        if new is not None and new != old:
            self.handle.registerTimer(new)
            self.timer.update((new,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Not only when the timer was set for: feeds that came due since then are as late.
        reached = timerValues.getCurrentWatermarkInMs() if self.by_event_time else timerValues.getCurrentProcessingTimeInMs()
        now = max(expiredTimerInfo.getExpiryTimeInMs(), reached) / 1000
        self.timer.clear()
        due = sorted((d, feed[0]) for feed, record in self.feeds.iterator() if (d := self._due(record)) is not None and d <= now)
        out = []
        for k, (at, feed) in enumerate(due):
            *record, _ = self.feeds.getValue((feed,))
            self.feeds.updateValue((feed,), (*record, now))
            out.append((feed, key[0], pd.Timestamp(at, unit="s"), pd.Timestamp(now + k * DELAY_SECONDS, unit="s")))
        self._set_timer()
        yield pd.DataFrame(out, columns=["feed_id", "host", "due_at", "ask_at"])

    def close(self) -> None:
        pass


def due_feeds(events: DataFrame, delay: str = "0 seconds", by_event_time: bool = False) -> DataFrame:
    """A stream of (feed_id, host, due_at, ask_at) from one of events, as their times come.

    Timers follow the clock; by_event_time lets them follow the events' watermark.
    Needs the RocksDB state store.
    """
    rows = events.withColumn("host", F.coalesce(X.url_host(F.col("url")), F.lit("")))
    if by_event_time:
        rows = rows.withWatermark("at", delay)
    return rows.groupBy("host").transformWithStateInPandas(PollState(by_event_time), DUE, "append", "EventTime" if by_event_time else "ProcessingTime")
