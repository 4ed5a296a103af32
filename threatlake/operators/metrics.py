"""Scoring: confusion counts, averages with their zero rules, telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(predicted: DataFrame, gold: DataFrame, keys: tuple[str, ...] = ("doc", "field"), item: str = "item") -> DataFrame:
    """tp, fp and fn of each key from two tables of items; repeats count once."""
    sides = predicted.select(*keys, item, F.lit(1).alias("p"), F.lit(0).alias("g")).unionByName(gold.select(*keys, item, F.lit(0).alias("p"), F.lit(1).alias("g")))
    each = sides.groupBy(*keys, item).agg(F.max("p").alias("p"), F.max("g").alias("g"))
    return each.groupBy(*keys).agg(*(F.sum(F.when(c, 1).otherwise(0)).cast("long").alias(n) for n, c in (("tp", F.expr("p = 1 and g = 1")), ("fp", F.expr("p = 1 and g = 0")), ("fn", F.expr("p = 0 and g = 1")))))


def precision(tp: Column, fp: Column, fn: Column) -> Column:
    """No prediction is perfect only if nothing was missed."""
    return F.when(tp + fp == 0, F.when(fn == 0, 1.0).otherwise(0.0)).otherwise(tp / (tp + fp))


def recall(tp: Column, fp: Column, fn: Column) -> Column:
    return F.when(tp + fn == 0, F.when(fp == 0, 1.0).otherwise(0.0)).otherwise(tp / (tp + fn))


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    p, r = precision(tp, fp, fn), recall(tp, fp, fn)
    return F.when(p + r == 0, 0.0).otherwise(2 * p * r / F.greatest(p + r, F.lit(1e-300)))


def degenerate(tp: Column, fp: Column, fn: Column) -> Column:
    return tp + fp + fn == 0


def with_scores(counts: DataFrame) -> DataFrame:
    c = (F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.withColumns({"precision": precision(*c), "recall": recall(*c), "f1": f1(*c)})


def micro(counts: DataFrame, *keys: str) -> DataFrame:
    """Triples added up, then divided once."""
    return with_scores(counts.groupBy(*keys).agg(*(F.sum(n).alias(n) for n in ("tp", "fp", "fn"))))


def macro_f1(counts: DataFrame, *keys: str) -> DataFrame:
    """Mean F1 of documents that have a prediction or gold; null if none has."""
    c = (F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.groupBy(*keys).agg(F.avg(F.when(~degenerate(*c), f1(*c))).alias("macro_f1"))


def rate(n: Column, d: Column) -> Column:
    """n / d, null over zero."""
    return F.try_divide(n.cast("double"), d.cast("double"))


def implicit_recall(gold: DataFrame, predicted: DataFrame, keys: tuple[str, ...] = ("doc",), item: str = "item") -> DataFrame:
    """Share of the gold items not written in the text that were predicted."""
    hit = predicted.select(*keys, item).distinct().withColumn("hit", F.lit(1))
    return gold.where("not explicit").join(hit, [*keys, item], "left").agg(F.count("*").alias("support"), F.coalesce(F.sum("hit"), F.lit(0)).cast("long").alias("found")).withColumn("recall", rate(F.col("found"), F.col("support")))


def token_sums(attempts: DataFrame, *keys: str) -> DataFrame:
    """Sums of tokens_in and tokens_out; null where no attempt of a key reported any."""
    return attempts.groupBy(*keys).agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))


def status_rollup(chunks: DataFrame, doc: str = "document_id") -> DataFrame:
    """ok if any chunk's last attempt is ok, else the last chunk's status; attempts and failed chunks."""
    last = F.max_by("status", "attempt")
    each = chunks.groupBy(doc, F.coalesce("chunk_index", F.lit(0)).alias("chunk")).agg(last.alias("status"), F.count("*").alias("attempts"))
    return each.groupBy(doc).agg(
        F.when(F.bool_or(F.col("status") == "ok"), "ok").otherwise(F.max_by("status", "chunk")).alias("status"),
        F.sum("attempts").alias("attempts"),
        F.count("*").alias("chunks"),
        F.sum(F.when(F.col("status") != "ok", 1).otherwise(0)).cast("long").alias("failed_chunks"),
    )


def first_ok(attempts: DataFrame, *order: str | Column, key: str = "document_id") -> DataFrame:
    """key, enrichment_run_id: the id of each document's first usable attempt in the given order; a document without one has no row."""
    return attempts.where("status = 'ok'").groupBy(key).agg(F.min_by("id", F.struct(*order)).alias("enrichment_run_id"))
