"""Enrichment: split, complete, parse, merge, guard, embed, store."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..clients import SYSTEM_PROMPT, ClientError, CompletionClient, EmbeddingClient, prompt_version
from ..functions import text as X
from ..functions import udfs as U
from ..operators import merge
from ..operators import metrics as M
from ..operators.guardrails import validate
from ..operators.store import Store
from ..schemas import EXTRACTION

MAX_ATTEMPTS = 2


def pending(documents: DataFrame, reports: DataFrame, limit: int | None = None) -> DataFrame:
    """Documents with a text and no report, oldest first."""
    todo = documents.where("clean_text is not null").join(reports.select(F.col("document_id").alias("id")), "id", "left_anti").orderBy("fetched_at", "id")
    return todo if limit is None else todo.limit(limit)


def chunked(documents: DataFrame, budget: int, doc: str = "id", text: str = "clean_text") -> DataFrame:
    """document_id, chunk_index (null for a document of one chunk), chunk."""
    parts = U.with_chunks(documents.select(F.col(doc).alias("document_id"), text), budget, text)
    return parts.select("document_id", F.size("parts").alias("n"), F.explode("parts").alias("p")).select("document_id", F.when(F.col("n") > 1, F.col("p.pos")).alias("chunk_index"), F.col("p.chunk").alias("chunk"))


def run_attempts(client: CompletionClient, system: str, user: str, max_tokens: int) -> list[tuple]:
    """Up to two attempts: (attempt, status, error, raw, tokens_in, tokens_out, stop_reason, extraction_json).

    A refused answer is asked for once more with the reason; a provider's error is not.
    """
    out, ask = [], user
    for n in range(1, MAX_ATTEMPTS + 1):
        try:
            got = client.complete(system, ask, max_tokens=max_tokens)
        except ClientError as e:
            return [*out, (n, "api_error", str(e), None, None, None, None, None)]
        status, error, clean = U.parse_contract(got.text)
        out.append((n, status, error, got.text, got.tokens_in, got.tokens_out, got.stop_reason, clean))
        if status == "ok":
            break
        ask = f"{user}\n\nThe previous answer was refused ({status}): {error}\nAnswer again with one JSON object and nothing else."
    return out


ATTEMPTS = "document_id string, chunk_index int, attempt int, status string, error string, raw_response string, tokens_in long, tokens_out long, stop_reason string, extraction_json string"


def complete(chunks: DataFrame, client: Callable[[], CompletionClient], system: str = SYSTEM_PROMPT, max_tokens: int = 2048) -> DataFrame:
    """One row for each attempt on each chunk. Write it before it is used: calls aren't to be repeated."""
    asked = chunks.select(F.col("document_id").cast("string").alias("document_id"), "chunk_index", X.enclosed(F.col("chunk")).alias("user"))
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(name, types[kind]) for name, kind in (c.split() for c in ATTEMPTS.split(", "))])

    def run(batches):
        own = client()
        for batch in batches:
            for s in U.slices(batch.column("user")):
                part = batch.slice(s.start, s.stop - s.start).to_pylist()
                rows = [(r["document_id"], r["chunk_index"], *a) for r in part for a in run_attempts(own, system, r["user"], max_tokens)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return asked.mapInArrow(run, ATTEMPTS)


def extractions(attempts: DataFrame) -> DataFrame:
    """document_id, chunk and the extraction struct of each usable chunk."""
    good = attempts.where("status = 'ok'")
    return good.select("document_id", F.coalesce("chunk_index", F.lit(0)).alias("chunk"), F.from_json("extraction_json", EXTRACTION).alias("extraction"))


EMBED_BATCH = 32


def embed(rows: DataFrame, client: Callable[[], EmbeddingClient], width: int, key: str = "document_id", text: str = "summary") -> DataFrame:
    """key, embedding: null where the client failed or the width differs. A call has EMBED_BATCH texts, and only its own fail with it."""

    def run(batches):
        own = client()
        for batch in batches:
            got = []
            for lo in range(0, len(batch), EMBED_BATCH):
                asked = batch[text].iloc[lo : lo + EMBED_BATCH].tolist()
                try:
                    found = own.embed(asked)
                except ClientError:
                    found = []
                got += found if len(found) == len(asked) else [None] * len(asked)
            yield pd.DataFrame({key: batch[key], "embedding": [v if v is not None and len(v) == width else None for v in got]})

    return rows.select(key, text).mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, embedding array<float>")


def enrich(documents: DataFrame, attempts: DataFrame, techniques: DataFrame, actors: DataFrame) -> dict[str, DataFrame]:
    """Reports and guarded child rows from stored attempts; documents: document_id, clean_text."""
    found = extractions(attempts)
    lists = merge.merge_lists(found)
    out = validate(lists, documents, techniques, actors)
    out["reports"] = merge.merge_scalars(found)
    return out


def run(store: Store, client: Callable[[], CompletionClient], embedder: Callable[[], EmbeddingClient] | None = None, model: str = "offline", embedding_model: str | None = None, width: int = 64, max_input_tokens: int = 6000, limit: int | None = None, now: str = "1970-01-01") -> dict[str, int]:
    """One batch over a store's tables. Attempts are stored before guardrails look at them."""
    spark: SparkSession = store.spark
    budget = X.document_budget(max_input_tokens, len(SYSTEM_PROMPT))
    techniques, actors = store.read("attack_technique"), store.read("threat_actor")
    if techniques.isEmpty() or actors.isEmpty():
        raise ValueError("reference data is empty: nothing could be validated")
    todo = pending(store.read("raw_document"), store.read("report"), limit)
    made = complete(chunked(todo, budget), client)
    uid = F.sha2(F.concat_ws("|", "document_id", F.coalesce(F.col("chunk_index").cast("string"), F.lit("-")), "attempt", F.lit(now)), 256)
    stamp = F.lit(now).cast("timestamp")
    with store.scratch("attempts") as path, store.scratch("reports") as reports_path:
        made.withColumn("id", uid).write.parquet(path)
        attempts = spark.read.parquet(path)
        return _store_run(store, attempts, reports_path, techniques, actors, embedder, model, embedding_model, width, stamp)


def _store_run(store: Store, attempts: DataFrame, reports_path: str, techniques: DataFrame, actors: DataFrame, embedder: Callable[[], EmbeddingClient] | None, model: str, embedding_model: str | None, width: int, stamp) -> dict[str, int]:
    """Attempts, then what they come to, into the store's tables."""
    store.append("enrichment_run", attempts.select("id", "document_id", F.lit(model).alias("model"), F.lit(prompt_version()).alias("prompt_version"), stamp.alias("started_at"), stamp.alias("finished_at"), "status", "raw_response", "attempt", "chunk_index"))

    documents = store.read("raw_document").select(F.col("id").alias("document_id"), "clean_text")
    ranked = actors.withColumn("load_ordinal", F.coalesce("load_ordinal", F.lit((1 << 40) - 1)))
    got = enrich(documents, attempts, techniques, ranked)
    first_ok = M.first_ok(attempts, F.coalesce("chunk_index", F.lit(0)), "attempt")
    reports = got["reports"].join(first_ok, "document_id").withColumn("id", F.sha2(F.concat(F.lit("report|"), "document_id"), 256))
    if embedder is None:
        reports = reports.withColumn("embedding", F.lit(None).cast("array<float>"))
    else:
        reports = reports.join(embed(got["reports"], embedder, width), "document_id", "left")
    has = F.col("embedding").isNotNull()
    reports = reports.withColumns({"embedding_model": F.when(has, F.lit(embedding_model)), "embedding_dim": F.when(has, F.size("embedding"))})
    reports.write.parquet(reports_path)
    reports = store.spark.read.schema(reports.schema).parquet(reports_path)
    ids = reports.select("document_id", F.col("id").alias("report_id"))
    # The report and its children become visible together, so a run that breaks off leaves its documents pending and nothing else.
    together = store.transaction()

    def child(name: str, rows: DataFrame, order: list[str], **more) -> None:
        full = rows.join(ids, "document_id").withColumns(more) if more else rows.join(ids, "document_id")
        if "id" in store.read(name).columns:
            full = full.withColumn("id", F.sha2(F.concat_ws("|", F.lit(name), "report_id", F.to_json("place"), *order), 256))
        together.insert_if_absent(name, full, order)

    child("report_actor", got["actors"].withColumn("actor_id", F.col("actor_id").cast("string")), ["actor_id"])
    child("report_technique", got["techniques"], ["technique_id"])
    child("ioc", got["iocs"], ["kind", "value_defanged"])
    child("actor_review_queue", got["review_queue"], ["raw_name"], created_at=stamp, resolved=F.lit(False))
    targets = got["targets"].where("country is not null or sector is not null").join(ids, "document_id")
    together.insert_if_absent("report_target", targets.withColumn("id", F.sha2(F.concat_ws("|", "report_id", F.to_json("place")), 256)), ["id"])
    together.insert_if_absent("report", reports, ["id"])
    inserted = together.commit()["report"]
    return {"documents": attempts.select("document_id").distinct().count(), "reports": inserted}
