"""Evaluation: predictions against gold, averages, telemetry and scorecards."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..clients import SYSTEM_PROMPT, CompletionClient, prompt_version
from ..functions import text as X
from ..operators import merge
from ..operators import metrics as M
from ..operators.find_names import find_names
from ..operators.guardrails import check_quotes, check_techniques, name_index, resolve_actors, validate
from ..sources import gold
from . import enrich

MIN_ALIAS_CHARS = 4
GATE = 0.85


def find_actors(documents: DataFrame, actors: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """(doc, canonical_name) of names and aliases written in the text, the longest at each place.

    Names of 4 characters or more that aren't numbers, in one pass of each text.
    """
    index = name_index(actors)
    names = index.where((F.length("name") >= MIN_ALIAS_CHARS) & ~F.col("name").rlike("^[0-9]+$"))
    found = find_names(documents, names.select("name", F.col("name_key").alias("key")), doc, text).withColumnRenamed("key", "name_key")
    canonical = index.join(actors.select(F.col("id").alias("actor_id"), "canonical_name"), "actor_id").select("name_key", "canonical_name")
    return found.join(canonical, "name_key").select(doc, "canonical_name").distinct()


def baseline(documents: DataFrame, techniques: DataFrame, actors: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """doc, field, item: what a reader of written ids and names alone would find."""
    t = documents.select(doc, F.explode(F.array_distinct(X.technique_mentions(F.col(text)))).alias("item"))
    t = t.join(techniques.select(F.col("technique_id").alias("item")).distinct(), "item", "left_semi").select(doc, F.lit("techniques").alias("field"), "item")
    c = documents.select(doc, F.lit("countries").alias("field"), F.explode(X.find_countries(F.col(text))).alias("item"))
    s = documents.select(doc, F.lit("sectors").alias("field"), F.explode(X.find_sectors(F.col(text))).alias("item"))
    a = find_actors(documents, actors, doc, text).select(doc, F.lit("actors").alias("field"), F.col("canonical_name").alias("item"))
    return t.unionByName(c).unionByName(s).unionByName(a)


def with_parents(items: DataFrame) -> DataFrame:
    """Items and, for techniques, a further field of their parents."""
    up = items.where("field = 'techniques'").withColumns({"field": F.lit("techniques_parent"), "item": X.parent_technique(F.col("item"))})
    return items.unionByName(up).distinct()


def predictions(validated: dict[str, DataFrame], actors: DataFrame, doc: str = "document_id") -> DataFrame:
    """doc, field, item of guarded extractions."""
    d = F.col(doc).alias("doc")
    a = validated["actors"].join(actors.select(F.col("id").alias("actor_id"), "canonical_name"), "actor_id").select(d, F.lit("actors").alias("field"), F.col("canonical_name").alias("item"))
    t = validated["techniques"].select(d, F.lit("techniques").alias("field"), F.col("technique_id").alias("item"))
    c = validated["targets"].where("country is not null").select(d, F.lit("countries").alias("field"), F.col("country").alias("item"))
    s = validated["targets"].where("sector is not null").select(d, F.lit("sectors").alias("field"), X.normalize_sector(F.col("sector")).alias("item"))
    return a.unionByName(t).unionByName(c).unionByName(s).distinct()


def score(predicted: DataFrame, gold: DataFrame, processed: DataFrame | None = None) -> dict[str, DataFrame]:
    """Counts by document and field, micro and macro averages by field.

    processed (doc): the documents that a system was asked about. What gold says of
    others is skipped; a document that was asked about and came to nothing is all misses.
    """
    if processed is not None:
        own = processed.select("doc").distinct()
        predicted, gold = predicted.join(own, "doc", "left_semi"), gold.join(own, "doc", "left_semi")
    counts = M.confusion(with_parents(predicted), with_parents(gold.select("doc", "field", "item")))
    return {"documents": counts, "micro": M.micro(counts, "field"), "macro": M.macro_f1(counts, "field")}


def telemetry(emitted: DataFrame) -> DataFrame:
    """Quote validity over all emitted techniques, closed-world pass rate, review rate; null over zero.

    emitted: kind (technique, actor), quote_ok, closed_world_ok, resolved.
    """
    t, a = F.col("kind") == "technique", F.col("kind") == "actor"
    n = F.count_if
    return emitted.agg(M.rate(n(t & F.col("quote_ok")), n(t)).alias("quote_validity"), M.rate(n(t & F.col("closed_world_ok")), n(t)).alias("closed_world_rate"), M.rate(n(a & ~F.col("resolved")), n(a)).alias("review_rate"))


def compare(scores: DataFrame, systems: list[str]) -> DataFrame:
    """field and one F1 column for each system, from micro scores with a column system."""
    return scores.groupBy("field").pivot("system", systems).agg(F.first("f1")).orderBy("field")


def _table(rows: list[tuple], head: tuple[str, ...]) -> list[str]:
    return ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(map(str, r)) + " |" for r in rows)]


def _n(x) -> str:
    return "n/a" if x is None else f"{x:.3f}"


def off_vocabulary(validated: dict[str, DataFrame]) -> DataFrame:
    """sector: the distinct sectors of guarded extractions that the vocabulary doesn't have."""
    sector = X.normalize_sector(F.col("sector"))
    return validated["targets"].where(F.col("sector").isNotNull() & ~X.in_vocabulary(sector)).select(sector.alias("sector")).distinct()


def chunk_counts(attempts: DataFrame) -> DataFrame:
    """documents, chunked_documents (that no call saw whole) and failed_chunks (of documents that had others), in one row."""
    split = attempts.groupBy("document_id").agg(F.bool_or(F.col("chunk_index").isNotNull()).alias("split"))
    each = M.status_rollup(attempts).join(split, "document_id")
    return each.agg(F.count("*").alias("documents"), F.count_if("split").alias("chunked_documents"), F.coalesce(F.sum(F.when(F.col("split"), F.col("failed_chunks"))), F.lit(0)).alias("failed_chunks"))


def failed_documents(attempts: DataFrame) -> list[str]:
    """Documents without a usable chunk: status, attempts and the last error, in brief. Fixtures are annotated by hand, so few."""
    last = attempts.groupBy("document_id").agg(F.max_by("error", F.struct(F.coalesce("chunk_index", F.lit(0)), "attempt")).alias("error"))
    rows = M.status_rollup(attempts).where("status != 'ok'").join(last, "document_id").orderBy("document_id")
    return [f"{r.document_id}: {r.status} after {r.attempts} attempts: {' '.join((r.error or '').split())[:160]}".rstrip(": ") for r in rows.collect()]


#: The fields of a document's row, and the baseline's beside them.
DOCUMENT_FIELDS = ("actors", "techniques_parent", "countries", "sectors")


def _documents(model: DataFrame, base: DataFrame, status: dict[str, str]) -> list[str]:
    """F1 of each document's main fields; a document whose status isn't known was read by rules alone."""
    own = model.groupBy("doc").pivot("field", list(DOCUMENT_FIELDS)).agg(F.first(M.f1(F.col("tp"), F.col("fp"), F.col("fn"))))
    other = base.where("field = 'techniques_parent'").select("doc", M.f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("base"))
    rows = own.join(other, "doc", "left").orderBy("doc").toLocalIterator()
    return _table([(r.doc, status.get(r.doc, "ok"), *(_n(r[f]) for f in DOCUMENT_FIELDS), _n(r.base)) for r in rows], ("document", "status", *(f"{f} F1" for f in DOCUMENT_FIELDS), "baseline techniques_parent F1"))


def scorecard(model: dict[str, DataFrame], base: dict[str, DataFrame], rates: DataFrame, title: str, failures: list[str] = (), defects: list[str] = (), lift: list[tuple] = (), about: dict | None = None, counts: dict | None = None, sectors: list[str] = ()) -> str:
    """Markdown: the run, headline, macro, lift (of lift()), guardrails, failures, documents, defects. A few rows for each field reach the driver.

    about: what the run table says; counts: chunked_documents and failed_chunks; sectors: those outside the vocabulary.
    """
    one = {r.field: r for r in model["micro"].collect()}
    two = {r.field: r for r in base["micro"].collect()}
    fields = sorted({*one, *two})
    out = [f"# {title}", ""]
    if about:
        out += ["## Run", *_table(list(about.items()), ("key", "value")), ""]

    def gain(f: str) -> str:
        a, b = getattr(one.get(f), "f1", None), getattr(two.get(f), "f1", None)
        return "n/a" if a is None or b is None else f"{a - b:+.3f}"

    def support(f: str) -> int:
        r = one.get(f) or two[f]
        return r.tp + r.fn

    out += ["## Micro averages"]
    out += _table([(f, *(_n(getattr(s.get(f), m, None)) for s in (one, two) for m in ("precision", "recall", "f1")), gain(f), support(f)) for f in fields], ("field", "P", "R", "F1", "baseline P", "baseline R", "baseline F1", "F1 gained", "gold items"))
    macro = {r.field: r.macro_f1 for r in model["macro"].collect()}
    base_macro = {r.field: r.macro_f1 for r in base["macro"].collect()}
    out += ["", "## Macro F1", *_table([(f, _n(macro.get(f)), _n(base_macro.get(f))) for f in fields], ("field", "model", "baseline"))]
    out += ["", "## Lift", *_table([(label, _n(a), _n(b), _n(None if a is None or b is None else a - b)) for label, a, b in lift], ("granularity", "model recall", "baseline recall", "difference"))]
    r = rates.first()
    guards = [(k, "n/a" if v is None else f"{100 * v:.1f}%") for k, v in r.asDict().items()]
    guards += [("sectors outside the vocabulary", len(sectors)), *((counts or {}).items())]
    out += ["", "## Guardrails", *_table(guards, ("measure", "model"))]
    out += ["", *(f"- sector outside the vocabulary: {s}" for s in sorted(sectors))]
    gate = getattr(one.get("techniques_parent"), "f1", None)
    out += ["", f"Gate (parent technique F1 over {GATE}): {'n/a' if gate is None else 'passed' if gate > GATE else 'failed'}"]
    status = {f.split(": ")[0]: f.split(": ")[1].split(" ")[0] for f in failures}
    out += ["", "## Documents", *_documents(model["documents"], base["documents"], status)]
    out += ["", "## Failures", *(f"- {f}" for f in failures or ["none"]), "", "## Gold defects", *(f"- {d}" for d in defects or ["none"]), ""]
    return "\n".join(out)


def lift(wanted: DataFrame, predicted: DataFrame, base: DataFrame) -> list[tuple]:
    """(granularity, model, baseline): recall of the techniques that gold marks as implicit, as they are and by their parent."""
    implicit = wanted.where("field = 'techniques' and not coalesce(explicit, false)")

    def recalled(found: DataFrame, parent: bool):
        rows = (x.where("field = 'techniques'").select("doc", "field", (X.parent_technique(F.col("item")) if parent else F.col("item")).alias("item")).distinct() for x in (implicit, found))
        gold, got = rows
        return M.implicit_recall(gold.withColumn("explicit", F.lit(False)), got).first().recall

    return [(label, recalled(predicted, parent), recalled(base, parent)) for label, parent in (("sub-technique", False), ("parent", True))]


def comparison(results: dict[str, dict], base: dict[str, DataFrame], title: str = "Comparison") -> str:
    """Markdown: micro F1 and diagnostics of each backend beside the shared baseline."""
    heads = [f"{name} ({r['model']})" for name, r in results.items()]
    micro = [{r.field: r.f1 for r in x["scores"]["micro"].collect()} for x in results.values()]
    floor = {r.field: r.f1 for r in base["micro"].collect()}
    fields = sorted({*floor, *(f for m in micro for f in m)})
    out = [f"# {title}", "", *_table([(f, *(_n(m.get(f)) for m in micro), _n(floor.get(f))) for f in fields], ("field", *heads, "baseline"))]
    rates = [x["rates"].first().asDict() for x in results.values()]
    rows = [(k, *("n/a" if r[k] is None else f"{100 * r[k]:.1f}%" for r in rates), "n/a") for k in (rates[0] if rates else ())]
    rows += [("implicit recall", *(_n(x["implicit"].first().recall) for x in results.values()), "n/a")]
    rows += [("failed documents", *(len(x["failures"]) for x in results.values()), "n/a")]
    return "\n".join([*out, "", "## Diagnostics", *_table(rows, ("measure", *heads, "baseline")), ""])


def slug(text: str) -> str:
    """A name that is safe in file names."""
    return "-".join(re.findall("[a-z0-9._-]+", text.lower())).strip("-")


def write(spark: SparkSession, path: str, content: str) -> None:
    """Writes a small text file to any file system that Spark reaches; one of the same name is replaced."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()


def predict(fixtures: DataFrame, client: Callable[[], CompletionClient], techniques: DataFrame, actors: DataFrame, folder: str, max_input_tokens: int = 6000, max_output_tokens: int = 2048) -> dict:
    """A model's guarded predictions on fixtures, with its rates, tokens and failures.

    Attempts are written under folder before anything reads them, as a call isn't
    to be repeated. A document without a usable chunk predicts nothing and is
    listed as a failure with its last status.
    """
    spark = fixtures.sparkSession
    documents = fixtures.select(F.col("id").alias("document_id"), F.coalesce("text", F.lit("")).alias("clean_text"))
    budget = X.document_budget(max_input_tokens, len(SYSTEM_PROMPT))
    asked = enrich.complete(enrich.chunked(documents, budget, "document_id"), client, max_tokens=max_output_tokens)
    asked.write.mode("overwrite").parquet(folder)
    attempts = spark.read.schema(asked.schema).parquet(folder)
    lists = merge.merge_lists(enrich.extractions(attempts))
    t = check_quotes(check_techniques(lists["techniques"], techniques), documents)
    a = resolve_actors(lists["actors"], name_index(actors))
    none = F.lit(None).cast("boolean")
    emitted = t.select(F.lit("technique").alias("kind"), F.col("evidence_reason").isNull().alias("quote_ok"), F.col("technique_reason").isNull().alias("closed_world_ok"), none.alias("resolved"))
    emitted = emitted.unionByName(a.select(F.lit("actor").alias("kind"), none.alias("quote_ok"), none.alias("closed_world_ok"), F.col("actor_id").isNotNull().alias("resolved")))
    valid = validate(lists, documents, techniques, actors)
    return {
        "predicted": predictions(valid, actors).persist(),  # run() releases it
        "rates": telemetry(emitted),
        "tokens": token_totals(attempts),
        "processed": attempts.select(F.col("document_id").alias("doc")).distinct(),
        "counts": chunk_counts(attempts).first().asDict(),
        "sectors": [r.sector for r in off_vocabulary(valid).orderBy("sector").collect()],  # of a few fixtures
        "failures": failed_documents(attempts),
    }


def token_totals(attempts: DataFrame) -> DataFrame:
    """tokens_in and tokens_out over all documents; a document without any counts as 0."""
    each = M.token_sums(attempts, "document_id")
    return each.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens_in", "tokens_out")))


def resolved_gold(items: DataFrame, actors: DataFrame) -> DataFrame:
    """Gold items with actor names replaced by the canonical name that they resolve to, where one does."""
    canonical = name_index(actors).join(actors.select(F.col("id").alias("actor_id"), "canonical_name"), "actor_id").select("name_key", "canonical_name")
    keyed = items.withColumn("name_key", F.when(F.col("field") == "actors", X.name_key(F.col("item"))))
    return keyed.join(canonical, "name_key", "left").withColumn("item", F.coalesce("canonical_name", "item")).drop("name_key", "canonical_name").distinct()


def run(spark: SparkSession, fixtures: DataFrame, techniques: DataFrame, actors: DataFrame, backends: dict[str, tuple[Callable[[], CompletionClient], str]], folder: str, limit: int | None = None, resolve_gold: bool = False, max_input_tokens: int = 6000, about: dict[str, dict] | None = None, placeholders: int = 0) -> dict[str, str]:
    """Scores each backend (name -> client factory, model) against gold and writes scorecards.

    about: for each backend what its run table says besides (provider, endpoint, commit, time).

    Returns written file names and their texts: one scorecard a backend, named by
    backend, model and prompt version, and a comparison for more than one backend.
    Without backends only the baseline's card is written. limit keeps the first
    fixtures by id.
    """
    if limit is not None:
        fixtures = fixtures.orderBy("id").limit(limit)
    version = prompt_version()
    wanted = gold.items(fixtures)
    if resolve_gold:
        wanted = resolved_gold(wanted, actors)
    wanted = wanted.persist()  # read by every score; recomputed if an executor is lost
    problems = [f"{r.id}: {r.problem} {r['item']}".rstrip() for r in gold.defects(fixtures, techniques, actors).orderBy("id", "problem", "item").collect()]
    plain = baseline(fixtures.select(F.col("id").alias("doc"), "text"), techniques, actors).persist()
    base = score(plain, wanted)
    none = spark.createDataFrame([], "kind string, quote_ok boolean, closed_world_ok boolean, resolved boolean")
    cards, results = {}, {}
    for name, (client, model) in backends.items():
        got = predict(fixtures, client, techniques, actors, f"{folder}/attempts-{slug(name)}", max_input_tokens)
        own = got | {"model": model, "scores": score(got["predicted"], wanted, got["processed"]), "implicit": M.implicit_recall(wanted.where("field = 'techniques'"), got["predicted"].where("field = 'techniques'"))}
        results[name] = own
        tokens = got["tokens"].first()
        ran = {"backend": name, "model": model, **(about or {}).get(name, {}), "prompt version": version, "gold documents": fixtures.count(), "placeholders skipped": placeholders, "token budget in": max_input_tokens, "documents chunked": f"{got['counts']['chunked_documents']} of {got['counts']['documents']}", "tokens in / out": f"{tokens.tokens_in} / {tokens.tokens_out}"}
        cards[f"{slug(name)}--{slug(model)}--{version}.md"] = scorecard(own["scores"], base, own["rates"], f"{name}: {model}", own["failures"], problems, lift(wanted, got["predicted"], plain), ran, {k: v for k, v in got["counts"].items() if k != "documents"}, got["sectors"])
    if not backends:
        cards[f"baseline--{version}.md"] = scorecard(base, base, telemetry(none), "Baseline", (), problems, lift(wanted, plain, plain))
    if len(results) > 1:
        cards[f"cross-backend--{version}.md"] = comparison(results, base)
    for name, card in cards.items():
        write(spark, f"{folder}/{name}", card)
    for reused in (wanted, plain, *(r["predicted"] for r in results.values())):
        reused.unpersist()
    return cards
