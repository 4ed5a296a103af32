"""Reference data from bundles: attack techniques and threat actors, by JSON functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from . import bundle

STIX = "objects array<struct<type:string,name:string,revoked:boolean,x_mitre_deprecated:boolean,external_references:array<struct<source_name:string,external_id:string>>,kill_chain_phases:array<struct<kill_chain_name:string,phase_name:string>>>>"
GALAXY = "values array<struct<value:string,uuid:string,meta:struct<country:string,synonyms:array<string>>>>"
FRAMEWORK = "mitre-attack"
UUID = "^[0-9a-fA-F]{8}-?([0-9a-fA-F]{4}-?){3}[0-9a-fA-F]{12}$"


def techniques(bundles: DataFrame, column: str = "body") -> DataFrame:
    """technique_id, name, tactic of a STIX bundle's current attack patterns."""
    return _techniques(bundles.select(F.explode(F.from_json(column, STIX)["objects"]).alias("o")).select("o.*"))


def split_techniques(spark: SparkSession, paths: list[str], **ranges: int) -> DataFrame:
    """techniques() of bundles by their addresses, each in many tasks."""
    found = bundle.split(spark, paths, "objects", **ranges)
    return _techniques(found.select(F.from_json("object", STIX.removeprefix("objects array<").removesuffix(">")).alias("o")).select("o.*"))


def _techniques(o: DataFrame) -> DataFrame:
    o = o.where("type = 'attack-pattern' and not coalesce(revoked, false) and not coalesce(x_mitre_deprecated, false)")
    ids = F.filter("external_references", lambda r: (r["source_name"] == FRAMEWORK) & (F.coalesce(r["external_id"], F.lit("")) != ""))
    phases = F.filter("kill_chain_phases", lambda p: (p["kill_chain_name"] == FRAMEWORK) & (F.coalesce(p["phase_name"], F.lit("")) != ""))
    tactic = F.array_join(F.array_sort(F.array_distinct(F.transform(phases, lambda p: p["phase_name"]))), ",")
    found = o.select(F.try_element_at(ids, F.lit(1))["external_id"].alias("technique_id"), "name", tactic.alias("tactic"))
    return found.where("technique_id is not null and tactic != ''").select("technique_id", F.coalesce(F.when(F.col("name") != "", F.col("name")), F.col("technique_id")).alias("name"), "tactic")


def actors(bundles: DataFrame, column: str = "body") -> DataFrame:
    """canonical_name, aliases, suspected_origin_country, misp_uuid and load_ordinal of a galaxy's entries."""
    return _actors(bundles.select(F.posexplode(F.from_json(column, GALAXY)["values"]).alias("load_ordinal", "v")).select("load_ordinal", "v.*"))


def split_actors(spark: SparkSession, paths: list[str], **ranges: int) -> DataFrame:
    """actors() of galaxies by their addresses, each in many tasks; load_ordinal is the entry's place in bytes, which has the entries' order."""
    found = bundle.split(spark, paths, "values", **ranges)
    return _actors(found.select(F.col("position").alias("load_ordinal"), F.from_json("object", GALAXY.removeprefix("values array<").removesuffix(">")).alias("v")).select("load_ordinal", "v.*"))


def _actors(v: DataFrame) -> DataFrame:
    name = X.trimmed(F.col("value"))
    trimmed = F.transform(F.coalesce(F.col("meta.synonyms"), F.array().cast("array<string>")), X.trimmed)
    aliases = F.array_sort(F.array_distinct(F.filter(trimmed, lambda s: (F.coalesce(s, F.lit("")) != "") & (F.lower(s) != F.lower(name)))))
    country = F.when(X.trimmed(F.col("meta.country")).rlike(r"^\p{L}{2}$"), F.upper(X.trimmed(F.col("meta.country"))))
    return v.where(name != "").select(name.alias("canonical_name"), aliases.alias("aliases"), country.alias("suspected_origin_country"), F.when(F.col("uuid").rlike(UUID), F.lower("uuid")).alias("misp_uuid"), "load_ordinal")
