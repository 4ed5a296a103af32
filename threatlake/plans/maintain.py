"""Maintenance: re-embedding, pruning, exporting fixtures, the health report."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..clients import EmbeddingClient, advertised
from ..functions import text as X
from ..functions import udfs as U
from ..operators.store import Store, cascade, remaining
from .enrich import embed

# How tables hang on each other (table, column, parent, parent column).
LINKS = (
    ("raw_document", "feed_id", "root", "id"),
    ("enrichment_run", "document_id", "raw_document", "id"),
    ("report", "document_id", "raw_document", "id"),
    ("report_actor", "report_id", "report", "id"),
    ("report_technique", "report_id", "report", "id"),
    ("report_target", "report_id", "report", "id"),
    ("ioc", "report_id", "report", "id"),
    ("actor_review_queue", "report_id", "report", "id"),
)


def needing_embedding(report: DataFrame, model: str, key: str = "id", limit: int | None = None) -> DataFrame:
    """Reports whose vector is missing or of another model, in the order of the key."""
    todo = report.where(~F.col("embedding_model").eqNullSafe(F.lit(model))).orderBy(key)
    return todo if limit is None else todo.limit(limit)


#: Reports of a part; a run that breaks off goes on with the parts that are left.
REEMBED_ROWS = 20_000


def reembed(store: Store, client: Callable[[], EmbeddingClient], model: str, width: int, limit: int | None = None, dry_run: bool = False, rows: int = REEMBED_ROWS) -> int:
    """Renews what needs it, vector, model and width together; how many that is. A failed vector stays as it was.

    Refused if the client's vectors haven't the stored width. What needs a vector is dealt
    once to parts of about `rows` reports, each part's vectors are written by themselves and kept if
    a run breaks off, and the table is rewritten once, so the cost follows the reports that are renewed.
    """
    if dry_run:
        return needing_embedding(store.read("report"), model, limit=limit).count()
    if (got := len(client().embed(["width"])[0])) != width:
        raise ValueError(f"the model makes vectors of {got}, the table has {width}")
    place = f"_vectors/{hashlib.sha256(f'{model}|{width}|{limit}'.encode()).hexdigest()[:16]}"
    spark, todo, parts_at = store.spark, f"{store.root}/{place}/todo", f"{place}/todo/_SUCCESS"
    if not store.exists(parts_at):
        wanted = needing_embedding(store.read("report"), model, limit=limit).select("id", "summary")
        parts = max(1, -(-wanted.count() // rows))
        wanted.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).repartition("part").write.mode("overwrite").partitionBy("part").parquet(todo)
    dealt = spark.read.schema("id string, summary string, part int").parquet(todo)
    made = [r.part for r in dealt.select("part").distinct().orderBy("part").collect()]
    for part in made:
        if not store.exists(f"{place}/vectors/part-{part}/_SUCCESS"):
            embed(dealt.where(F.col("part") == part), client, width, key="id").where("embedding is not null").write.mode("overwrite").parquet(f"{store.root}/{place}/vectors/part-{part}")
    done = 0
    if made:
        new = spark.read.schema("id string, embedding array<float>").parquet(*(f"{store.root}/{place}/vectors/part-{part}" for part in made))
        report = store.read("report")
        renewed = report.drop("embedding", "embedding_model", "embedding_dim").join(new, "id").withColumns({"embedding_model": F.lit(model), "embedding_dim": F.lit(width)})
        done = renewed.count()
        if done:
            store.upsert("report", renewed.select(*report.columns), ["embedding", "embedding_model", "embedding_dim"])
    store.discard(place)
    return done


def feeds_named(feeds: DataFrame, prefix: str) -> DataFrame:
    """Feeds whose name begins with the prefix, in which % and _ stand for any text and character."""
    return feeds.where(F.col("name").like(f"{prefix}%"))


def prune(store: Store, prefix: str, apply: bool = False, drop_feed: bool = False, reset_poll_state: bool = False) -> dict[str, int]:
    """Rows that go with the feeds whose name begins with the prefix, in which % and _ stand for any text and character; nothing is touched without apply."""
    hit = F.col("name").like(f"{prefix}%")
    feeds = feeds_named(store.read("feed"), prefix)
    gone = cascade(feeds, {t: store.read(t) for t, *_ in LINKS}, LINKS)
    counts = {("feed" if t == "root" else t): rows.count() for t, rows in gone.items()}
    if apply:
        keys = {"report_actor": "report_id", "report_technique": "report_id"}
        for table, *_ in reversed(LINKS):  # children first
            key = keys.get(table, "id")
            store.replace(table, remaining(store.read(table), gone[table], key))
        if drop_feed:
            store.replace("feed", remaining(store.read("feed"), feeds, "id"))
        elif reset_poll_state:
            store.replace("feed", store.read("feed").withColumns({c: F.when(~hit, F.col(c)) for c in ("etag", "last_modified", "last_polled_at")}))
    return counts


def export_candidates(documents: DataFrame, feeds: DataFrame, exported: DataFrame | None = None, kind: str | None = None, limit: int | None = None) -> DataFrame:
    """Documents worth annotating, best first: long enough, not of a JSON feed, not exported yet."""
    rows = documents.where(F.length("clean_text") >= X.MIN_USEFUL_CHARS).join(feeds.where("kind != 'json'").select(F.col("id").alias("feed_id"), "name"), "feed_id")
    rows = rows.withColumns({"source_kind": X.source_kind(F.col("name")), "score": X.export_score(F.col("clean_text"))})
    if kind is not None:
        rows = rows.where(F.col("source_kind") == kind)
    if exported is not None:
        rows = rows.join(exported.select("source_url").distinct(), "source_url", "left_anti")
    rows = rows.orderBy(F.desc("score"), "id")
    return rows if limit is None else rows.limit(limit)


def fixtures(candidates: DataFrame, first_index: int) -> DataFrame:
    """name, text (inert) and a placeholder's JSON for each candidate, numbered in their order."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.orderBy(F.desc("score"), "id")) - 1 + first_index  # a fixture batch is a handful of rows
    made = candidates.withColumn("n", n).withColumn("name", F.concat(F.format_string("%04d-", "n"), X.slugify(F.col("title"))))
    document = F.struct(F.concat("name", F.lit(".txt")).alias("text_file"), F.col("title"), F.col("source_url"), F.col("source_kind"))
    return made.withColumn("d", U.defang_text("clean_text")).select("name", F.col("d.text").alias("text"), F.to_json(F.struct(F.col("name").alias("id"), F.lit("placeholder").alias("status"), document.alias("document"))).alias("json"))


def next_index(names: DataFrame, column: str = "name") -> int:
    """The number after the highest that a fixture's file name begins with; 1 if none does."""
    number = F.regexp_extract(column, r"^(\d{4})-.*\.json$", 1)
    return (names.select(F.max(F.when(number != "", number.cast("int"))).alias("n")).first().n or 0) + 1


def export(candidates: DataFrame, first_index: int, folder: str) -> list[str]:
    """Writes each candidate's inert text and placeholder; the names written. A batch for annotators is a handful of rows."""
    from .evaluate import write

    made = fixtures(candidates, first_index).orderBy("name").collect()
    for r in made:
        write(candidates.sparkSession, f"{folder}/{r.name}.txt", r.text)
        write(candidates.sparkSession, f"{folder}/{r.name}.json", r.json)
    return [r.name for r in made]


def doctor(tables: dict[str, DataFrame], width: int) -> DataFrame:
    """check, status, detail: one row for each, from counts; `error` if anything can't work."""
    t = tables["attack_technique"].agg(F.count("*").alias("techniques"))
    a = tables["threat_actor"].agg(F.count("*").alias("actors"))
    reference = t.join(a).select(F.lit("reference data").alias("check"), F.when((F.col("techniques") > 0) & (F.col("actors") > 0), "ok").otherwise("error").alias("status"), F.concat("techniques", F.lit(" techniques, "), "actors", F.lit(" actors")).alias("detail"))
    v = tables["report"].agg(F.count("*").alias("reports"), F.countDistinct("embedding_model").alias("models"), F.count_if(F.col("embedding").isNotNull() & (F.size("embedding") != width)).alias("odd"))
    stored = v.select(F.lit("stored embeddings").alias("check"), F.when(F.col("models") > 1, "degraded").otherwise("ok").alias("status"), F.concat("reports", F.lit(" reports, "), "models", F.lit(" models")).alias("detail"))
    schema = v.select(F.lit("schema").alias("check"), F.when(F.col("odd") > 0, "error").otherwise("ok").alias("status"), F.concat("odd", F.lit(f" vectors not of width {width}")).alias("detail"))
    return reference.unionByName(stored).unionByName(schema)


def endpoint_checks(spark, endpoints: dict[str, tuple[str, str]], probe=advertised) -> DataFrame:
    """A row of doctor() for each endpoint (name -> address, model): error if it lists nothing, degraded if it doesn't list the model."""
    rows = []
    for name, (base, model) in endpoints.items():
        listed = probe(base)
        status = "error" if listed is None else "ok" if model in listed else "degraded"
        rows.append((name, status, "no answer" if listed is None else f"{len(listed)} models" + ("" if status == "ok" else f", not {model}")))
    return spark.createDataFrame(rows, "check string, status string, detail string")


def exit_code(checks: DataFrame) -> int:
    """1 if any check is an error."""
    return int(not checks.where("status = 'error'").isEmpty())
