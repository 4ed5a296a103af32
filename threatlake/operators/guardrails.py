"""Guardrails: every mention is kept, resolved or dropped with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.udfs import canonicalize
from .similar import most_similar

FUZZY_THRESHOLD = 0.9


def check_techniques(mentions: DataFrame, techniques: DataFrame, column: str = "technique_id") -> DataFrame:
    """mentions with the id's canonical form and technique_reason (null if it stands).

    The technique list is a reference table of a published framework (hundreds of
    rows); Catalyst broadcasts it when its size is under the session's threshold.
    """
    known = techniques.select(F.col("technique_id").alias("__known")).distinct()
    key = X.technique_key(F.col(column))
    joined = mentions.withColumn(column, key).join(known, F.col(column) == F.col("__known"), "left")
    reason = F.when(~X.technique_shape(F.col(column)), "malformed technique id").when(F.col("__known").isNull(), "not in the closed world")
    return joined.withColumn("technique_reason", F.when(F.col(column).isNull(), "malformed technique id").otherwise(reason)).drop("__known")


def check_quotes(mentions: DataFrame, documents: DataFrame, doc: str = "document_id", quote: str = "evidence_quote") -> DataFrame:
    """mentions with evidence_reason (null if the quote stands in the document's text).

    Texts are made canonical once for each document that has a mention, and quotes once each.
    """
    wanted = documents.join(mentions.select(doc).distinct(), doc, "left_semi").select(doc, canonicalize("clean_text").alias("__hay"))
    joined = mentions.withColumn("__needle", canonicalize(quote)).join(wanted, doc, "left")
    return joined.withColumn("evidence_reason", X.evidence_verdict(F.col("__hay"), F.col("__needle"))).drop("__hay", "__needle")


def name_index(actors: DataFrame) -> DataFrame:
    """name_key, actor_id, name, ordinal of every canonical name and alias; on a collision the first written wins.

    actors: id, canonical_name, aliases, load_ordinal.
    """
    names = F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = actors.select("id", "load_ordinal", F.posexplode(names).alias("pos", "name")).withColumn("name_key", X.name_key(F.col("name"))).where("name_key != ''")
    w = Window.partitionBy("name_key").orderBy("load_ordinal", "pos")
    return rows.withColumn("n", F.row_number().over(w)).where("n = 1").select("name_key", F.col("id").alias("actor_id"), "name", (F.col("load_ordinal") * 1_000_000 + F.col("pos")).alias("ordinal"))


def resolve_actors(mentions: DataFrame, index: DataFrame, column: str = "name", threshold: float = FUZZY_THRESHOLD) -> DataFrame:
    """mentions with actor_id, match (exact, fuzzy or null), best_match_actor_id and best_match_score.

    Exact lookup first; only distinct names that miss look for their most similar name.
    """
    keyed = mentions.withColumn("__key", X.name_key(F.col(column)))
    exact = keyed.join(index.select(F.col("name_key").alias("__key"), F.col("actor_id").alias("__exact")), "__key", "left")
    missed = exact.where("__exact is null and __key != ''").select("__key").distinct()
    near = most_similar(missed, index.select("name_key", "actor_id", "ordinal"), "__key").select("__key", F.col("actor_id").alias("__best"), F.col("score").alias("__score"))
    joined = exact.join(near, "__key", "left")
    hit = F.col("__score") > threshold
    return joined.withColumns(
        {
            "actor_id": F.coalesce("__exact", F.when(hit, F.col("__best"))),
            "match": F.when(F.col("__exact").isNotNull(), "exact").when(hit, "fuzzy"),
            "best_match_actor_id": F.col("__best"),
            "best_match_score": F.col("__score"),
        }
    ).drop("__key", "__exact", "__best", "__score")


def _first(rows: DataFrame, *keys: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*keys).orderBy("place"))
    return rows.withColumn("__n", n).where("__n = 1").drop("__n")


def validate(lists: dict[str, DataFrame], documents: DataFrame, techniques: DataFrame, actors: DataFrame, doc: str = "document_id") -> dict[str, DataFrame]:
    """Survivors and drops of a document's mentions (each with `place`, its order).

    Techniques: closed world, then evidence, then the first survivor of an id.
    Actors: resolved, first mention of an actor wins; what isn't goes to the review
    queue and the drops. Indicators: defanged or dropped, and a dropped
    value is never shown. Targets pass. Repeats that survive are no drops.
    """
    t = check_quotes(check_techniques(lists["techniques"], techniques), documents, doc)
    good = _first(t.where("technique_reason is null and evidence_reason is null"), doc, "technique_id")
    a = resolve_actors(lists["actors"], name_index(actors))
    i = lists["iocs"].withColumn("d", X.defang_ioc(F.col("kind"), F.col("value")))

    def drop(rows: DataFrame, category: str, item, reason) -> DataFrame:
        return rows.select(doc, F.lit(category).alias("category"), item.alias("item"), reason.alias("reason"), "place")

    shown = F.concat(F.col("technique_id"), F.lit(": "), F.col("evidence_quote"))
    drops = drop(t.where("technique_reason is not null"), "closed_world_technique", F.col("technique_id"), F.col("technique_reason"))
    drops = drops.unionByName(drop(t.where("technique_reason is null and evidence_reason is not null"), "evidence_quote", shown, F.col("evidence_reason")))
    drops = drops.unionByName(drop(a.where("actor_id is null"), "actor_resolution", F.col("name"), F.lit("unresolved; routed to actor_review_queue")))
    drops = drops.unionByName(drop(i.where("not d.ok"), "ioc_defang", F.concat(F.lit("<"), F.coalesce("kind", F.lit("null")), F.lit(">")), F.col("d.reason")))
    return {
        "techniques": good.select(doc, "technique_id", "evidence_quote", "place"),
        "actors": _first(a.where("actor_id is not null"), doc, "actor_id").select(doc, "actor_id", F.col("name").alias("raw_name"), "attribution_confidence", "match", "place"),
        "review_queue": a.where("actor_id is null").select(doc, F.col("name").alias("raw_name"), "attribution_confidence", "best_match_actor_id", "best_match_score", "place"),
        "iocs": i.where("d.ok").select(doc, "kind", F.col("d.value_defanged").alias("value_defanged"), "place"),
        "targets": lists["targets"],
        "drops": drops,
    }
