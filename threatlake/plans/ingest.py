"""Ingestion: parse fetched bodies, hash, probe, follow thin entries, insert, advance the poll state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import udfs as U
from ..operators.store import Store, absent, first_by_key
from ..sources import feed_stream
from ..sources import feeds as feed_source


def documents_of(parsed: DataFrame) -> DataFrame:
    """Parsed entries with the content hash of the feed's own body, before any article replaces it."""
    return parsed.where("error is null").withColumn("content_hash", X.content_hash(F.coalesce("clean_text", F.lit(""))))


def with_articles(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """Thin entries with the article's body where it is clearly longer.

    entries: feed_url, fetch_articles, source_url, raw_html, clean_text; pages: url, html
    of what was fetched, joined by address.
    """
    body = pages.select(F.col("url").alias("source_url"), U.html_article("html").alias("article")).where("article is not null").withColumn("article_text", U.html_text("article"))
    joined = entries.join(first_by_key(body, ["source_url"], ["article"]), "source_url", "left")
    use = F.col("fetch_articles") & X.thin(F.col("clean_text")) & X.same_site(F.col("feed_url"), F.col("source_url")) & (F.length("article_text") >= F.length(F.coalesce("clean_text", F.lit(""))) * X.IMPROVEMENT)
    use = F.coalesce(use, F.lit(False))
    return joined.withColumns({"raw_html": F.when(use, F.col("article")).otherwise(F.col("raw_html")), "clean_text": F.when(use, F.col("article_text")).otherwise(F.col("clean_text")), "replaced": use}).drop("article", "article_text")


def seed(store: Store) -> None:
    """The registry's feeds: new ones whole, known ones with name, kind and fetch_articles renewed."""
    store.upsert("feed", feed_source.seeds(store.spark), ["name", "kind", "fetch_articles"])


def _written(rows: DataFrame, path: str) -> tuple[DataFrame, int]:
    """The rows, written before anything reads them, and how many: counted as they are written."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), seen.get["n"]


def poll(store: Store, bodies: DataFrame, now: str, pages: DataFrame | Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """One round over fetched bodies: feed_id, body, etag, last_modified, status (ok, not_modified, error).

    An error leaves the feed due; an unchanged body only renews the time; a body
    that doesn't parse is not asked for again until it changes. Returns stored, deduped (entries
    that the table or the round already had) and fetched. pages is a table of url and html, or a
    function that fetches it for the thin entries' addresses (feed_url, source_url).
    Bodies are fetched, parsed and counted once each.
    """
    stamp = F.lit(now).cast("timestamp")
    with store.scratch("bodies") as bodies_at, store.scratch("parsed") as parsed_at, store.scratch("pages") as pages_at:
        bodies, fetched = _written(bodies, bodies_at)
        feeds = store.read("feed")
        known = feeds.select(F.col("id").alias("feed_id"), "kind", F.col("url"), "name", "fetch_articles")
        parsed, found = _written(documents_of(feed_source.parse_bodies(bodies.where("status = 'ok'").select("feed_id", "body").join(known, "feed_id"))), parsed_at)
        entries = parsed.join(known.select("feed_id", F.col("url").alias("feed_url"), "fetch_articles"), "feed_id")
        entries = absent(first_by_key(entries, ["feed_id", "content_hash"], ["position"]), store.read("raw_document"), ["feed_id", "content_hash"])
        if callable(pages):
            follow = F.col("fetch_articles") & X.thin(F.col("clean_text")) & X.same_site(F.col("feed_url"), F.col("source_url"))
            pages, _ = _written(pages(entries.where(follow).select("source_url").distinct()), pages_at)
        if pages is not None:
            entries = with_articles(entries, pages)
        rows = entries.withColumns({"id": F.sha2(F.concat_ws("|", "feed_id", "content_hash"), 256), "fetched_at": stamp})
        stored = store.insert_if_absent("raw_document", rows, ["id"])
        seen = bodies.where("status in ('ok', 'not_modified')").select(F.col("feed_id").alias("id"), F.col("etag").alias("new_etag"), F.col("last_modified").alias("new_modified"), "status")
        moved = feeds.join(first_by_key(seen, ["id"], ["status"]), "id").withColumns({"etag": F.when(F.col("status") == "ok", F.col("new_etag")).otherwise(F.col("etag")), "last_modified": F.when(F.col("status") == "ok", F.col("new_modified")).otherwise(F.col("last_modified")), "last_polled_at": stamp})
        store.upsert("feed", moved.select(*feeds.columns), ["etag", "last_modified", "last_polled_at"])
        return {"stored": stored, "deduped": found - stored, "fetched": fetched}


def fetch_pages(client: Callable) -> Callable[[DataFrame], DataFrame]:
    """A function from addresses (source_url) to url and html; one host goes to one task, and an address that fails has no row."""
    import pandas as pd

    def run(batches):
        own = client()
        for batch in batches:
            rows = []
            for url in batch["source_url"]:
                try:
                    rows.append((url, own.fetch(url).body.decode("utf-8", "replace")))
                except (OSError, ValueError, RuntimeError):
                    continue
            yield pd.DataFrame(rows, columns=["url", "html"])

    return lambda wanted: wanted.withColumn("host", X.url_host(F.col("source_url"))).repartition("host").mapInPandas(run, "url string, html string")


def run(store: Store, now: str, client: Callable) -> dict[str, int]:
    """One round: seed the registry, fetch the feeds that are due, store their entries and follow the thin ones."""
    seed(store)
    return poll(store, fetch_due(store, now, client), now, fetch_pages(client))


def follow(store: Store, landing: str, checkpoint: str, pages: Callable[[DataFrame], DataFrame] | None = None, **options: str):
    """The stream of feed bodies into the store: each round of answers is one poll(); a round that is run again stores nothing twice."""
    rows = feed_stream.read_stream(store.spark, store.folders("feed"), landing, **options)

    def write(batch: DataFrame, _: int) -> None:
        at = batch.agg(F.max("polled_at").cast("string").alias("at")).first().at
        if at is not None:
            poll(store, batch.drop("url", "polled_at"), at, pages)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fetch_due(store: Store, now: str, client: Callable):
    """Bodies of the feeds that are due, fetched where each feed's partition runs, one host to one task."""
    import pandas as pd

    todo = feed_source.due(store.read("feed"), now).select("id", "url", "etag", "last_modified").withColumn("host", X.url_host(F.col("url")))

    def run(batches):
        own = client()
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                try:
                    got = own.fetch(r.url, r.etag, r.last_modified)
                    rows.append((r.id, got.body, got.etag, got.last_modified, "not_modified" if got.not_modified else "ok"))
                except (OSError, ValueError, RuntimeError):
                    rows.append((r.id, None, None, None, "error"))
            yield pd.DataFrame(rows, columns=["feed_id", "body", "etag", "last_modified", "status"])

    return todo.repartition("host").mapInPandas(run, "feed_id string, body binary, etag string, last_modified string, status string")
