"""A Python data source of feed bodies: spark.read.format("feeds") and spark.readStream.format("feeds").

Options: registry, comma-separated Parquet folders of the feed table; landing, a folder
that driver and executors share (streams only); client and clock, "module:name" of the fetch
client's factory and of a function that gives the seconds since 1970; partitions, into how
many tasks hosts are dealt (one host is one task's, which keeps the client's pause between two requests).

A stream goes by rounds. Its offset is a round's plan: for each feed that is asked, the
validators (ETag, Last-Modified) that its request sends. The task that gets an answer lands it
before it passes it on, so a batch that is run again, after a crash too, reads what is
landed and asks only for the rest; the next round's validators are those of the landed answers.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .feeds import POLL_MINUTES, next_due
from .fetch import checked_host

SCHEMA = "feed_id string, url string, body binary, etag string, last_modified string, status string, polled_at timestamp"
CLIENT, CLOCK, PARTITIONS = "threatlake.sources.fetch:Client", "time:time", 16


def _named(path: str):
    module, name = path.split(":")
    return getattr(importlib.import_module(module), name)


class Folder:
    """Small files under an address that Arrow's file systems reach; a file appears whole or not at all."""

    def __init__(self, address: str):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(address) if "://" in address or address.startswith("file:") else (fs.LocalFileSystem(), address)

    def names(self, *at: str) -> list[str]:
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector("/".join((self.root, *at)), allow_not_found=True))
        return sorted(f.base_name for f in found if not f.base_name.startswith("."))

    def read(self, *at: str) -> bytes | None:
        try:
            with self.fs.open_input_stream("/".join((self.root, *at))) as f:
                return f.read()
        except FileNotFoundError:
            return None

    def write(self, data: bytes, *at: str) -> None:
        folder, name = "/".join((self.root, *at[:-1])), at[-1]
        self.fs.create_dir(folder, recursive=True)
        hidden = f"{folder}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(hidden) as f:
            f.write(data)
        self.fs.move(hidden, f"{folder}/{name}")

    def drop(self, *at: str) -> None:
        from pyarrow import fs

        path = "/".join((self.root, *at))
        if self.fs.get_file_info(path).type == fs.FileType.Directory:
            self.fs.delete_dir(path)
        else:
            self.fs.delete_file(path)


@dataclass(frozen=True)
class Asked:
    """A request of a feed: what the plan says of it."""

    feed_id: str
    url: str
    etag: str | None = None
    last_modified: str | None = None


@dataclass
class Hosts(InputPartition):
    """The requests of some hosts in one round; round -1 lands nothing."""

    round: int
    asked: list[Asked]


def by_host(asked: list[Asked], most: int) -> dict[int, list[Asked]]:
    """Requests by partition: all of a host's together."""

    def place(url: str) -> int:
        try:
            host = checked_host(url)[0]
        except ValueError:
            host = url
        return int.from_bytes(hashlib.sha256(host.encode()).digest()[:4]) % most

    out: dict[int, list[Asked]] = {}
    for a in sorted(asked, key=lambda a: a.url):
        out.setdefault(place(a.url), []).append(a)
    return out


class _Reader:
    """What the batch and the stream reader share: the registry, and the tasks' work."""

    def __init__(self, options: dict[str, str]):
        self.registry = [p for p in options["registry"].split(",") if p]
        self.client, self.clock = options.get("client", CLIENT), options.get("clock", CLOCK)
        self.partitions_wanted = int(options.get("partitions", PARTITIONS))
        self.landing = options.get("landing")

    def feeds(self) -> list[dict]:
        """The enabled feeds; a registry has some thousand rows."""
        import pyarrow.dataset as ds

        columns = ["id", "url", "etag", "last_modified", "last_polled_at", "poll_interval_minutes", "enabled"]
        rows = [r for p in self.registry for r in self._dataset(ds, p).to_table(columns=columns).to_pylist()]
        return [r for r in rows if r["enabled"]]

    @staticmethod
    def _dataset(ds, path: str):
        folder = Folder(path)
        return ds.dataset(folder.root, filesystem=folder.fs, format="parquet")

    def now(self) -> float:
        return float(_named(self.clock)())

    def read(self, partition: Hosts) -> Iterator[tuple]:
        own, landing = None, Folder(self.landing) if self.landing else None
        for a in partition.asked:
            name = hashlib.sha256(a.feed_id.encode()).hexdigest()
            told = landing.read("rounds", f"{partition.round:012d}", f"{name}.json") if landing else None
            if told is not None:
                said = json.loads(told)
                body = landing.read("rounds", f"{partition.round:012d}", f"{name}.body") if said["has_body"] else None
            else:
                own = own or _named(self.client)()
                said, body = self._ask(own, a)
                if landing:
                    if body is not None:
                        landing.write(body, "rounds", f"{partition.round:012d}", f"{name}.body")
                    landing.write(json.dumps(said | {"feed_id": a.feed_id, "has_body": body is not None}).encode(), "rounds", f"{partition.round:012d}", f"{name}.json")
            yield a.feed_id, a.url, body, said["etag"], said["last_modified"], said["status"], datetime.fromtimestamp(said["at"], UTC)

    def _ask(self, client, a: Asked) -> tuple[dict, bytes | None]:
        try:
            got = client.fetch(a.url, a.etag, a.last_modified)
        except (OSError, ValueError, RuntimeError):
            return {"status": "error", "etag": a.etag, "last_modified": a.last_modified, "at": self.now()}, None
        status = "not_modified" if got.not_modified else "ok"
        return {"status": status, "etag": got.etag, "last_modified": got.last_modified, "at": self.now()}, None if got.not_modified else got.body


class FeedReader(_Reader, DataSourceReader):
    """One round of the enabled feeds that are due by the registry."""

    def __init__(self, options):
        super().__init__({k: v for k, v in options.items() if k != "landing"})

    def partitions(self) -> list[Hosts]:
        now = self.now()
        asked = [Asked(r["id"], r["url"], r["etag"], r["last_modified"]) for r in self.feeds() if next_due(_seconds(r["last_polled_at"]), r["poll_interval_minutes"]) <= now]
        return [Hosts(-1, a) for a in by_host(asked, self.partitions_wanted).values()] or [Hosts(-1, [])]


def _seconds(stamp: datetime | None) -> float | None:
    return None if stamp is None else (stamp if stamp.tzinfo else stamp.replace(tzinfo=UTC)).timestamp()


class FeedStreamReader(_Reader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"round": 0, "asked": {}, "state": {}}

    def _last_plan(self) -> dict:
        folder = Folder(self.landing)
        names = folder.names("plans")
        return json.loads(folder.read("plans", names[-1])) if names else self.initialOffset()

    def latestOffset(self) -> dict:
        """The running round's plan while answers of it are missing, or the next one's if feeds are due by then."""
        last, folder = self._last_plan(), Folder(self.landing)
        at = f"{last['round']:012d}"
        told = {}
        for name in folder.names("rounds", at):
            if name.endswith(".json"):
                answer = json.loads(folder.read("rounds", at, name))
                told[answer["feed_id"]] = answer
        if set(last["asked"]) - set(told):
            return last
        state = dict(last["state"])
        for feed, answer in told.items():
            polled, failures = (answer["at"], 0) if answer["status"] != "error" else (state.get(feed, [None] * 4)[2], state.get(feed, [None, None, None, 0])[3] + 1)
            state[feed] = [answer["etag"], answer["last_modified"], polled, failures, answer["at"]]
        asked, now = {}, self.now()
        for r in self.feeds():
            etag, modified, polled, failures, tried = state.get(r["id"]) or (r["etag"], r["last_modified"], _seconds(r["last_polled_at"]), 0, None)
            if next_due(polled, r["poll_interval_minutes"], failures, tried) <= now:
                asked[r["id"]] = [r["url"], etag, modified]
        if not asked:
            return last
        plan = {"round": last["round"] + 1, "asked": asked, "state": state}
        folder.write(json.dumps(plan).encode(), "plans", f"{plan['round']:012d}")
        return plan

    def partitions(self, start: dict, end: dict) -> list[Hosts]:
        if start["round"] >= end["round"]:
            return [Hosts(end["round"], [])]
        asked = [Asked(feed, *said) for feed, said in end["asked"].items()]
        return [Hosts(end["round"], a) for a in by_host(asked, self.partitions_wanted).values()]

    def commit(self, end: dict) -> None:
        """Rounds before the committed one are needed no more."""
        folder = Folder(self.landing)
        for kind in ("rounds", "plans"):
            for name in folder.names(kind):
                if int(name) < end["round"]:
                    folder.drop(kind, name)


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feeds"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FeedReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        if not self.options.get("landing"):
            raise ValueError("a stream of feeds needs a landing folder")
        return FeedStreamReader(self.options)


def read_stream(spark: SparkSession, registry: list[str], landing: str, **options: str) -> DataFrame:
    """The stream of answers of the registry's feeds."""
    spark.dataSource.register(FeedSource)
    return spark.readStream.format("feeds").options(registry=",".join(registry), landing=landing, **options).load()


def read_due(spark: SparkSession, registry: list[str], **options: str) -> DataFrame:
    """One round's answers of the feeds that are due."""
    spark.dataSource.register(FeedSource)
    return spark.read.format("feeds").options(registry=",".join(registry), **options).load()
