"""Streaming ingestion over a landing folder: the batch transforms, exactly once by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.store import Store

LANDED = "feed_id string, source_url string, fetched_at timestamp, title string, published_at timestamp, raw_html string, clean_text string"


def read(spark: SparkSession, folder: str, schema: str = LANDED) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def documents(landed: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Landed rows with content hash and id; repeats within the delay are dropped early, later ones by the sink."""
    rows = landed.withColumn("content_hash", X.content_hash(F.coalesce("clean_text", F.lit(""))))
    rows = rows.withColumn("id", F.sha2(F.concat_ws("|", "feed_id", "content_hash"), 256))
    return rows.withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(["feed_id", "content_hash"])


def sink(rows: DataFrame, store: Store, checkpoint: str):
    """Appends what the table lacks by (feed_id, content_hash); a repeated batch inserts nothing."""

    def write(batch: DataFrame, _: int) -> None:
        store.insert_if_absent("raw_document", batch, ["id"])

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(landed: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Landed documents by feed and window of fetched_at; late rows within the delay count."""
    return landed.withWatermark("fetched_at", delay).groupBy(F.window("fetched_at", window), "feed_id").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "feed_id", "n")
