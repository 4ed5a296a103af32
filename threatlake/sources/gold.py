"""Gold annotations: JSON fixtures with their texts, and what is wrong with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.vocabulary import SECTORS
from ..operators.guardrails import name_index

SCHEMA = (
    "id string, status string, document struct<text_file:string,text:string,title:string,source_url:string,source_kind:string,published_on:string>, "
    "annotation struct<actors:array<struct<name:string,attribution_confidence:string>>,techniques:array<struct<technique_id:string,explicit_in_text:boolean,note:string>>,targets:array<struct<country:string,sector:string>>>, "
    "annotated_by string, annotated_on string, notes string"
)


class GoldError(ValueError):
    pass


def load(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(annotated, placeholders) of a folder's fixtures, each with its text.

    Repeated ids are refused, as are texts inside the JSON, targets that name
    nothing and annotated fixtures without a text; a
    placeholder without one is a warning, shown by its null text.
    """
    rows = spark.read.schema(SCHEMA).option("multiLine", True).json(f"{folder}/*.json").withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    if inline := [r.file for r in rows.where("document.text is not null").select("file").collect()]:
        raise GoldError(f"text inside the fixture instead of a file of its own: {', '.join(sorted(inline))}")
    if aimless := [r.id for r in rows.where("exists(annotation.targets, t -> coalesce(t.country, t.sector) is null)").select("id").collect()]:
        raise GoldError(f"targets with neither country nor sector: {', '.join(sorted(aimless))}")
    rows = rows.withColumn("document", F.col("document").dropFields("text"))
    texts = spark.read.option("wholetext", True).text(f"{folder}/*.txt").select(F.col("value").alias("text"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("text_name"))
    joined = rows.join(texts, F.col("document.text_file") == F.col("text_name"), "left").drop("text_name")
    if twice := [r.id for r in rows.groupBy("id").count().where("count > 1").collect()]:
        raise GoldError(f"repeated ids: {', '.join(sorted(twice))}")
    annotated = joined.where("status = 'annotated'")
    if bare := [r.id for r in annotated.where("text is null").select("id").collect()]:
        raise GoldError(f"annotated without a text: {', '.join(sorted(bare))}")
    return annotated, joined.where("status = 'placeholder'")


def items(fixtures: DataFrame) -> DataFrame:
    """doc, field, item, explicit: the gold side of scoring, in long form."""
    def rows(field, column, item, explicit=F.lit(None).cast("boolean")):
        return fixtures.select(F.col("id").alias("doc"), F.explode(column).alias("m")).select("doc", F.lit(field).alias("field"), item.alias("item"), explicit.alias("explicit"))

    a = F.col("annotation")
    out = rows("actors", a["actors"], F.col("m.name"))
    out = out.unionByName(rows("techniques", a["techniques"], X.technique_key(F.col("m.technique_id")), F.col("m.explicit_in_text")))
    out = out.unionByName(rows("countries", a["targets"], F.upper(X.trimmed(F.col("m.country")))))
    out = out.unionByName(rows("sectors", a["targets"], X.normalize_sector(F.col("m.sector"))))
    return out.where("item is not null").distinct()


def defects(fixtures: DataFrame, techniques: DataFrame, actors: DataFrame) -> DataFrame:
    """id, problem, item: empty texts, unknown techniques, unknown actors, odd countries, sectors outside the vocabulary."""
    long = items(fixtures)

    def found(rows, problem):
        return rows.select(F.col("doc").alias("id"), F.lit(problem).alias("problem"), "item")

    out = fixtures.where("trim(text) = ''").select("id", F.lit("empty text").alias("problem"), F.lit("").alias("item"))
    t = long.where("field = 'techniques'").join(techniques.select(F.col("technique_id").alias("item")).distinct(), "item", "left_anti")
    names = long.where("field = 'actors'").withColumn("name_key", X.name_key(F.col("item"))).join(name_index(actors), "name_key", "left_anti")
    c = long.where("field = 'countries'").where(~F.col("item").rlike("^[A-Z]{2}$"))
    s = long.where("field = 'sectors'").where(~F.col("item").isin(*SECTORS))
    for rows, problem in ((t, "unknown technique"), (names, "unresolvable actor"), (c, "bad country"), (s, "sector outside the vocabulary")):
        out = out.unionByName(found(rows, problem))
    return out
