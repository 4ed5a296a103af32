"""The command line: python -m threatlake COMMAND --store FOLDER."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from . import clients
from .operators.store import Store
from .plans import enrich, evaluate, ingest, load, maintain
from .sources import fetch, gold


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="threatlake", description="Report analytics over a store of Parquet tables.")
    out.add_argument("--store", required=True, help="the store's folder, as a Spark path")
    commands = out.add_subparsers(dest="command", required=True)
    commands.add_parser("ingest", help="fetch the feeds that are due and store their entries")
    commands.add_parser("load-reference", help="load techniques and actors from their published bundles")
    one = commands.add_parser("enrich", help="extract reports from documents that have none")
    one.add_argument("--limit", type=int)
    one.add_argument("--offline", action="store_true", help="use the keyword client, without a network")
    one = commands.add_parser("evaluate", help="score backends against gold fixtures")
    one.add_argument("--gold", required=True)
    one.add_argument("--out", required=True)
    one.add_argument("--limit", type=int)
    one.add_argument("--resolve-gold", action="store_true")
    one.add_argument("--backend", action="append", choices=("first", "second", "offline"), help="may be repeated; none writes the baseline's card only")
    one = commands.add_parser("reembed", help="renew vectors of another model")
    one.add_argument("--width", type=int, default=64)
    one.add_argument("--limit", type=int)
    one.add_argument("--dry-run", action="store_true")
    one = commands.add_parser("prune", help="delete what hangs on feeds by name")
    one.add_argument("prefix", help="% and _ stand for any text and character")
    one.add_argument("--apply", action="store_true")
    one.add_argument("--drop-feed", action="store_true")
    one.add_argument("--reset-poll-state", action="store_true")
    one = commands.add_parser("export-fixtures", help="write documents worth annotating")
    one.add_argument("--out", required=True)
    one.add_argument("--kind")
    one.add_argument("--limit", type=int, default=10)
    one = commands.add_parser("doctor", help="check tables and endpoints; exit code 1 on an error")
    one.add_argument("--width", type=int, default=64)
    one.add_argument("--offline", action="store_true")
    one = commands.add_parser("vacuum", help="delete what no table's last version needs")
    one.add_argument("table")
    return out


def completion(endpoint: clients.Endpoint):
    return lambda: clients.completion_client(endpoint)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    store = Store(spark or SparkSession.builder.appName("threatlake").getOrCreate(), a.store)
    now = datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")
    done: object = None
    if a.command == "ingest":
        done = ingest.run(store, now, fetch.Client)
    elif a.command == "load-reference":
        done = load.run(store, fetch.Client)
    elif a.command == "enrich":
        done = _enrich(store, a, now)
    elif a.command == "evaluate":
        fixtures, waiting = gold.load(store.spark, a.gold)
        backends = {b: _backend(b) for b in a.backend or ()}
        done = sorted(evaluate.run(store.spark, fixtures, store.read("attack_technique"), store.read("threat_actor"), backends, a.out, a.limit, a.resolve_gold, about={b: {"generated at": now} for b in backends}, placeholders=waiting.count()))
    elif a.command == "reembed":
        at = clients.resolve_embedding()
        if at is None:
            raise clients.ConfigError("no embedding endpoint")
        done = maintain.reembed(store, lambda: clients.embedding_client(at), at.model, a.width, a.limit, a.dry_run)
    elif a.command == "prune":
        done = maintain.prune(store, a.prefix, a.apply, a.drop_feed, a.reset_poll_state)
    elif a.command == "export-fixtures":
        rows = maintain.export_candidates(store.read("raw_document"), store.read("feed"), kind=a.kind, limit=a.limit)
        done = maintain.export(rows, 1, a.out)
    elif a.command == "vacuum":
        done = store.vacuum(a.table)
    else:
        checks = maintain.doctor({n: store.read(n) for n in ("attack_technique", "threat_actor", "report")}, a.width)
        if not a.offline:
            found = {"completion": clients.resolve_completion(), "embedding": clients.resolve_embedding()}
            checks = checks.unionByName(maintain.endpoint_checks(store.spark, {n: (e.base_url or "", e.model or "") for n, e in found.items() if e}))
        for r in checks.collect():
            print(f"{r.check}: {r.status} ({r.detail})")
        return maintain.exit_code(checks)
    print(done)
    return 0


def _backend(name: str):
    if name == "offline":
        return clients.KeywordClient, "offline"
    at = clients.resolve_completion() if name == "first" else clients.resolve_second()
    return completion(at), at.model


def _enrich(store: Store, a, now: str) -> dict[str, int]:
    if a.offline:
        return enrich.run(store, clients.KeywordClient, clients.HashEmbedder, embedding_model="hash", limit=a.limit, now=now)
    at, vectors = clients.resolve_completion(), clients.resolve_embedding()
    embedder = (lambda: clients.embedding_client(vectors)) if vectors else None
    return enrich.run(store, completion(at), embedder, at.model or "", vectors.model if vectors else None, max_input_tokens=at.max_input_tokens, limit=a.limit, now=now)


if __name__ == "__main__":
    sys.exit(main())
