"""Loading reference data: bundles into the technique and actor tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import Store, first_by_key
from ..sources import reference
from ..sources.fetch import REFERENCE_MAX_BYTES

# Where the bundles are published.
ATTACK_URL = "https://raw.githubusercontent.com/mitre/cti/master/enterprise-attack/enterprise-attack.json"
GALAXY_URL = "https://raw.githubusercontent.com/MISP/misp-galaxy/main/clusters/threat-actor.json"


def load(store: Store, attack: DataFrame | None, galaxy: DataFrame | None) -> dict[str, int]:
    """Upserts the bundles' techniques and actors (tables with a body column); what a bundle no longer has stays.

    A name that occurs twice keeps its first entry. An actor's load_ordinal is its place in the
    bundle, which decides whose alias wins; it is renewed with the rest.
    """
    return load_rows(store, None if attack is None else reference.techniques(attack), None if galaxy is None else reference.actors(galaxy))


def load_files(store: Store, attack: list[str], galaxy: list[str]) -> dict[str, int]:
    """load() of bundles that lie in files, however large: each is cut into its objects by many tasks."""
    return load_rows(store, reference.split_techniques(store.spark, attack), reference.split_actors(store.spark, galaxy))


def load_rows(store: Store, techniques: DataFrame | None, actors: DataFrame | None) -> dict[str, int]:
    counts = {}
    if techniques is not None:
        rows = first_by_key(techniques, ["technique_id"], ["name", "tactic"])
        store.upsert("attack_technique", rows, ["name", "tactic"])
        counts["techniques"] = rows.count()
    if actors is not None:
        rows = first_by_key(actors, ["canonical_name"], ["load_ordinal"]).withColumn("id", F.sha2(F.concat(F.lit("actor|"), "canonical_name"), 256))
        store.upsert("threat_actor", rows, ["aliases", "suspected_origin_country", "misp_uuid", "load_ordinal"])
        counts["actors"] = rows.count()
    return counts


def run(store: Store, client: Callable, attack_url: str = ATTACK_URL, galaxy_url: str = GALAXY_URL) -> dict[str, int]:
    """Fetches both bundles, each one body, and loads them."""
    own = client()
    bodies = [store.spark.createDataFrame([(own.fetch(url, most=REFERENCE_MAX_BYTES).body.decode("utf-8"),)], "body string") for url in (attack_url, galaxy_url)]
    return load(store, *bodies)
