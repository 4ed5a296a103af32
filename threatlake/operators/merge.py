"""Merging the extractions of a document's chunks into one.

Input rows are (document_id, chunk, extraction struct). List fields become one row
per mention with its place (chunk, pos), so that "first" and "strongest" are
windows on the place and never depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.vocabulary import ATTRIBUTION, CONFIDENCE

SUMMARY_CHARS = 600


def rank_of(value: Column, order: tuple[str, ...]) -> Column:
    return F.array_position(F.array(*map(F.lit, order)), value)


def merge_summaries(parts: Column) -> Column:
    """Trimmed parts joined by spaces and cut at a sentence end, at most 600 characters."""
    joined = F.array_join(F.filter(F.transform(parts, X.trimmed), lambda p: p != ""), " ")
    head = F.substring(joined, 1, SUMMARY_CHARS)
    back = F.reverse(head)
    last = F.greatest(*(F.when(F.instr(back, f" {m}") > 0, F.lit(SUMMARY_CHARS) - F.instr(back, f" {m}") - 1).otherwise(-1) for m in ".!?"))
    cut = F.when(last > SUMMARY_CHARS // 2, F.substr(head, F.lit(1), last + 1)).otherwise(F.concat(F.rtrim(F.substring(head, 1, SUMMARY_CHARS - 1)), F.lit("…")))
    return F.when(F.length(joined) <= SUMMARY_CHARS, joined).otherwise(cut)


def mentions(extractions: DataFrame, field: str, doc: str = "document_id") -> DataFrame:
    """document_id, chunk, pos and the fields of each mention."""
    return extractions.select(doc, "chunk", F.posexplode(f"extraction.{field}").alias("pos", "m")).select(doc, "chunk", "pos", "m.*")


def _first(rows: DataFrame, keys: list[Column], doc: str, *before: Column) -> DataFrame:
    w = Window.partitionBy(doc, *keys)
    many = F.col("chunks") > 1
    n = F.row_number().over(w.orderBy(*before, "chunk", "pos"))
    first = F.min(F.struct("chunk", "pos")).over(w)
    # A document of one chunk passes through as it is, repeats included.
    return rows.withColumns({"n": n, "first": first}).where(~many | (F.col("n") == 1)).withColumn("place", F.when(many, F.col("first")).otherwise(F.struct("chunk", "pos"))).drop("n", "first", "chunk", "pos", "chunks")


def merge_lists(extractions: DataFrame, doc: str = "document_id") -> dict[str, DataFrame]:
    """actors, techniques, targets and iocs with their place, merged as the chunks' union."""
    counts = extractions.groupBy(doc).agg(F.countDistinct("chunk").alias("chunks"))
    rows = {f: mentions(extractions, f, doc).join(counts, doc) for f in ("actors", "techniques", "targets", "iocs")}
    return {
        "actors": _first(rows["actors"], [X.casefold(F.col("name"))], doc, rank_of(F.col("attribution_confidence"), ATTRIBUTION).desc()),
        "techniques": _first(rows["techniques"], [F.col("technique_id")], doc),
        "targets": _first(rows["targets"], [F.col("country"), F.col("sector")], doc),
        "iocs": _first(rows["iocs"], [F.col("kind"), F.col("value")], doc),
    }


def merge_scalars(extractions: DataFrame, doc: str = "document_id") -> DataFrame:
    """summary, first stated report_date and lowest confidence of each document."""
    e = F.col("extraction")
    ordered = F.array_sort(F.collect_list(F.struct(F.col("chunk"), e["summary"].alias("s"))))
    many = F.count("*") > 1
    return extractions.groupBy(doc).agg(
        F.when(many, merge_summaries(F.transform(ordered, lambda x: x["s"]))).otherwise(F.first(e["summary"])).alias("summary"),
        F.min_by(e["report_date"], F.when(e["report_date"].isNotNull(), F.col("chunk"))).alias("report_date"),
        F.min_by(e["confidence"], F.struct(rank_of(e["confidence"], CONFIDENCE), F.col("chunk"))).alias("confidence"),
    )


__all__ = ["merge_lists", "merge_scalars", "merge_summaries", "mentions", "rank_of"]
