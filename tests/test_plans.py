"""Ingestion, enrichment, evaluation and maintenance end to end, without a network."""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threatlake import __main__ as cli
from threatlake import clients
from threatlake.functions import text as X
from threatlake.functions import udfs as U
from threatlake.operators import merge
from threatlake.operators import metrics as M
from threatlake.operators import store as store_module
from threatlake.operators.similar import Cell
from threatlake.operators.store import Store
from threatlake.plans import api, enrich, evaluate, ingest, load, maintain
from threatlake.sources import feeds, fetch, gold

RSS = """<rss><channel>
<item><title>One</title><link>https://f.example/1</link><description>Operators used T1566.001 to send bait to everyone. More text.</description></item>
<item><title>Again</title><link>https://f.example/1b</link><description>Operators used T1566.001  to send bait to everyone. More text.</description></item>
<item><title>No link</title></item>
<item><title>Two</title><link>https://f.example/2</link><description>short</description></item></channel></rss>"""
PAGE = "<html><article>" + "A long body about T1078 and its use by the crew. " * 5 + "</article></html>"


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}")
    feed = spark.createDataFrame([("f1", "CISA feed", "https://f.example/rss", "rss", 360, True, True), ("f2", "Bad", "https://g.example/rss", "rss", 360, True, False)], "id string, name string, url string, kind string, poll_interval_minutes int, enabled boolean, fetch_articles boolean")
    s.upsert("feed", feed.select("*", *(F.lit(None).cast(t).alias(n) for n, t in (("etag", "string"), ("last_modified", "string"), ("last_polled_at", "timestamp")))), ["name"])
    s.append("attack_technique", spark.createDataFrame([("T1566.001", "a", "x"), ("T1078", "b", "y")], "technique_id string, name string, tactic string"))
    s.append("threat_actor", spark.createDataFrame([("a1", "Crew One", ["The Crew"], None, None, 0)], s.read("threat_actor").schema))
    return s


def bodies(spark):
    return spark.createDataFrame([("f1", RSS.encode(), "e1", None, "ok"), ("f2", b"<!DOCTYPE r><r/>", "e2", None, "ok")], "feed_id string, body binary, etag string, last_modified string, status string")


def test_ingest_is_idempotent_and_follows_thin_entries(spark, store):
    pages = spark.createDataFrame([("https://f.example/2", PAGE)], "url string, html string")
    assert ingest.poll(store, bodies(spark), "2024-01-01 00:00:00", pages)["stored"] == 2
    docs = {r.source_url: r for r in store.read("raw_document").collect()}
    assert docs["https://f.example/2"].clean_text.startswith("A long body")
    assert ingest.poll(store, bodies(spark), "2024-01-01 01:00:00", pages)["stored"] == 0
    feeds = {r.id: r for r in store.read("feed").collect()}
    assert feeds["f1"].etag == "e1" and feeds["f2"].etag == "e2"  # a body that doesn't parse isn't asked for again


def test_enrich_and_maintain(spark, store):
    ingest.poll(store, bodies(spark), "2024-01-01 00:00:00")
    done = enrich.run(store, clients.KeywordClient, clients.HashEmbedder, embedding_model="hash", now="2024-01-02 00:00:00")
    assert done == {"documents": 2, "reports": 2}
    # A run that broke off before its reports were written: the documents are pending again and children aren't doubled.
    before = store.read("report_technique").count()
    store.replace("report", store.read("report").limit(0))
    again = enrich.run(store, clients.KeywordClient, clients.HashEmbedder, embedding_model="hash", now="2024-01-02 00:00:01")
    assert again == done and store.read("report_technique").count() == before
    assert {r.technique_id for r in store.read("report_technique").collect()} == {"T1566.001"}
    assert store.read("enrichment_run").count() == 4
    assert enrich.pending(store.read("raw_document"), store.read("report")).count() == 0
    assert maintain.reembed(store, clients.HashEmbedder, "other", 64, dry_run=True) == 2
    assert maintain.reembed(store, clients.HashEmbedder, "other", 64) == 2
    assert {r.embedding_model for r in store.read("report").collect()} == {"other"}
    before = maintain.prune(store, "CISA")
    assert before["report"] == 2 and store.read("report").count() == 2
    maintain.prune(store, "CISA", apply=True, reset_poll_state=True)
    assert store.read("report").count() == store.read("raw_document").count() == 0
    assert store.read("feed").where("id = 'f1'").first().etag is None


def test_a_round_parses_each_body_once_and_leaves_nothing_behind(spark, store, tmp_path, monkeypatch):
    parsed = spark.sparkContext.accumulator(0)
    real = feeds.parse_bodies

    def counted(bodies):
        def tick(batches):
            for batch in batches:
                parsed.add(len(batch))
                yield batch

        return real(bodies.mapInPandas(tick, bodies.schema))

    monkeypatch.setattr(feeds, "parse_bodies", counted)
    assert ingest.poll(store, bodies(spark), "2024-01-01 00:00:00") == {"stored": 2, "deduped": 1, "fetched": 2}
    assert parsed.value == 2
    assert not any(store._fs.listStatus(store._path(f"{store.root}/{x}")) for x in ("_bodies", "_parsed") if store.exists(x))


def test_reembedding_goes_on_where_it_broke_off(spark, store, tmp_path):
    ingest.poll(store, bodies(spark), "2024-01-01 00:00:00")
    enrich.run(store, clients.KeywordClient, clients.HashEmbedder, embedding_model="hash", now="2024-01-02 00:00:00")
    assert not store._fs.listStatus(store._path(f"{store.root}/_attempts"))
    calls = tmp_path / "calls"
    calls.mkdir()

    def client(most: int):
        class Counting(clients.HashEmbedder):
            def embed(self, texts):
                if texts != ["width"]:
                    if len(list(calls.iterdir())) >= most:
                        raise RuntimeError("killed")
                    (calls / uuid.uuid4().hex).touch()
                return super().embed(texts)

        return Counting

    few = store.read("report")
    store.replace("report", few.unionByName(few.withColumns({c: F.concat(c, F.lit("x")) for c in ("id", "document_id", "summary")})))
    with pytest.raises(Exception, match="killed"):
        maintain.reembed(store, client(1), "other", 64, rows=1)
    assert {r.embedding_model for r in store.read("report").collect()} == {"hash"}
    before = len(list(calls.iterdir()))
    assert before == 1
    assert maintain.reembed(store, client(99), "other", 64, rows=1) == 4
    # Each part was asked for once: what the first run had made was kept.
    assert len(list(calls.iterdir())) <= 4
    assert {r.embedding_model for r in store.read("report").collect()} == {"other"}
    assert maintain.reembed(store, client(99), "other", 64, rows=1) == 0


def test_correlation_of_several_countries(spark):
    """Events of one, several, repeated and no countries against every pair."""
    import random
    from datetime import date, timedelta

    r, day = random.Random(6), date(2024, 1, 1)
    events = [(k, day + timedelta(r.randrange(60)), [r.choice("ABCD") for _ in range(k % 4)]) for k in range(80)]
    reports = sorted({(k, r.choice("ABCDE")) for k in range(60) for _ in range(3)})
    dates = {k: day + timedelta(r.randrange(60)) for k in range(60)}
    e = spark.createDataFrame(events, "event_id long, occurred_on date, countries array<string>")
    c = spark.createDataFrame([(k, dates[k], x) for k, x in reports], "report_id long, report_date date, country string")
    want = {(i, k) for i, at, own in events for k, x in reports if x in own and abs((dates[k] - at).days) <= 7}
    assert sorted((x.event_id, x.report_id) for x in api.correlated_pairs(e, c, 7).collect()) == sorted(want)
    days = (max(dates[k] for k, _ in reports) - min(dates[k] for k, _ in reports)).days + 1
    for x in api.correlate(e, c, 7).collect():
        at, own = next((a, o) for i, a, o in events if i == x.event_id)
        mine = [dates[k] for i, k in want if i == x.event_id]
        shared = len({k for k, y in reports if y in own})
        assert (x.n_before, x.n_after, x.baseline) == (sum(d < at for d in mine), sum(d >= at for d in mine), round(shared / days * 7, 6))


def test_store_versions(spark, tmp_path):
    """Appends write their rows alone, a stale rewrite is refused, and vacuum leaves the last version."""
    s = Store(spark, f"file://{tmp_path}/s")
    rows = spark.createDataFrame([("T1", "a", "x"), ("T2", "b", "y")], "technique_id string, name string, tactic string")
    assert s.append("attack_technique", rows) == 2
    first = s.read("attack_technique")
    assert s.insert_if_absent("attack_technique", rows.unionByName(spark.createDataFrame([("T3", "c", "z")], rows.schema)), ["name"]) == 1
    assert first.count() == 2 and s.read("attack_technique").count() == 3  # readers of a version aren't disturbed
    assert len(s._current("attack_technique")[1]) == 2
    since = s._current("attack_technique")[0]
    s.append("attack_technique", spark.createDataFrame([("T4", "d", "z")], rows.schema))
    with pytest.raises(store_module.ConcurrentUpdate):
        s.replace("attack_technique", rows, since)
    s.upsert("attack_technique", rows.withColumn("name", F.lit("new")), ["name"])
    assert s.vacuum("attack_technique") == 3  # the refused rewrite has left no folder
    assert sorted((r.technique_id, r.name) for r in s.read("attack_technique").collect()) == [("T1", "new"), ("T2", "new"), ("T3", "c"), ("T4", "d")]
    assert s.read("report").count() == 0


def test_reference_loader_and_alias_order(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/s")
    attack = {"objects": [{"type": "attack-pattern", "name": "n", "external_references": [{"source_name": "mitre-attack", "external_id": "T1"}], "kill_chain_phases": [{"kill_chain_name": "mitre-attack", "phase_name": "p"}]}]}
    galaxy = {"values": [{"value": "\tZulu ", "meta": {"synonyms": ["Shared", " Shared\t"]}}, {"value": "Alpha", "meta": {"synonyms": ["shared"]}}, {"value": "Zulu", "meta": {}}]}
    bodies = [spark.createDataFrame([(json.dumps(x),)], "body string") for x in (attack, galaxy)]
    for _ in range(2):
        assert load.load(s, *bodies) == {"techniques": 1, "actors": 2}
    actors = s.read("threat_actor")
    assert [(r.canonical_name, r.aliases, r.load_ordinal) for r in actors.orderBy("load_ordinal").collect()] == [("Zulu", ["Shared"], 0), ("Alpha", ["shared"], 1)]
    from threatlake.operators.guardrails import name_index

    index = {r.name_key: r.actor_id for r in name_index(actors).collect()}
    assert index["shared"] == index["zulu"]  # the entry loaded first wins


def test_ingest_round_fetches_once(spark, tmp_path):
    """The driver: due feeds are fetched, thin entries followed, and every address is asked for once."""
    log = tmp_path / "log"

    class Fake:
        def fetch(self, url, etag=None, last_modified=None, most=0):
            with log.open("a") as f:
                f.write(url + "\n")
            if "talos" in url:
                raise fetch.FetchError("status 500")
            if url.endswith("/article"):
                return fetch.Fetched(PAGE.encode(), url, None, None)
            return fetch.Fetched(RSS.replace("https://f.example/2", "https://www.cyber.gov.au/article").encode(), url, "e", None)

    s = Store(spark, f"file://{tmp_path}/s")
    done = ingest.run(s, "2024-01-01 00:00:00", Fake)
    asked = log.read_text().split()
    assert len(asked) == len({*asked}) == 5 and "https://www.cyber.gov.au/article" in asked
    assert done == {"stored": 6, "deduped": 3, "fetched": 4}
    assert s.read("raw_document").where("clean_text like 'A long body%'").count() == 1
    assert ingest.run(s, "2024-01-01 01:00:00", Fake)["fetched"] == 1  # only the one that failed is still due


def test_command_line(spark, store, capsys):
    root = store.root
    ingest.poll(store, bodies(spark), "2024-01-01 00:00:00")
    assert cli.main(["--store", root, "enrich", "--offline"], spark) == 0
    assert cli.main(["--store", root, "prune", "C%SA"], spark) == 0
    assert cli.main(["--store", root, "vacuum", "report"], spark) == 0
    assert cli.main(["--store", root, "doctor", "--offline"], spark) == 0
    said = capsys.readouterr().out
    assert "'reports': 2" in said and "reference data: ok" in said
    store.replace("attack_technique", store.read("attack_technique").limit(0))
    assert cli.main(["--store", root, "doctor", "--offline"], spark) == 1
    checks = maintain.endpoint_checks(spark, {"a": ("u", "m"), "b": ("v", "x")}, probe=lambda base: ["m"] if base == "u" else None)
    assert [r.status for r in checks.orderBy("check").collect()] == ["ok", "error"]


def test_embedding_batches_and_width(spark, store):
    class Picky(clients.HashEmbedder):
        def embed(self, texts):
            assert len(texts) <= enrich.EMBED_BATCH
            if any("bad" in t for t in texts):
                raise clients.ClientError("no")
            return super().embed(texts)

    rows = spark.createDataFrame([(f"{k:03d}", "bad" if k == 40 else f"t{k}") for k in range(100)], "document_id string, summary string").coalesce(1)
    assert enrich.embed(rows, Picky, 64).where("embedding is null").count() == enrich.EMBED_BATCH
    with pytest.raises(ValueError, match="vectors of 8"):
        maintain.reembed(store, lambda: clients.HashEmbedder(8), "m", 64)


def test_exact_text_rules(spark):
    names = ["ΣΑΣ", "Straße", "ﬁn", "ıI", "Ǆ", "ſ", "ẞ", "K", "ΌΣΟΣ"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(X.casefold(F.col("n")).alias("k")).collect()
    assert [r.k for r in got] == [n.casefold() for n in names]
    one = spark.createDataFrame([("\tT1078\n", "\thttps://a.example/x\u00a0")], "t string, u string").select(X.technique_key(F.col("t")).alias("t"), X.defang_ioc(F.lit("url"), F.col("u"))["value_defanged"].alias("u")).first()
    assert (one.t, one.u) == ("T1078", "hxxps://a[.]example/x") and U.inert("url", "\thttps://a.example/x\u00a0") == one.u
    body = '{"summary": "s", "confidence": "low"}'
    assert [U.parse_contract(x)[0] for x in (f"```json{body}```", f"```json\n{body}\n```", f"```\n{body}```", body)] == ["invalid_json", "ok", "ok", "ok"]
    null = spark.createDataFrame([("f", "rss", "u", "n", None)], "feed_id string, kind string, url string, name string, body binary")
    assert feeds.parse_bodies(null).first().error == "ValueError"


def test_names_find_the_best_of_all():
    import random
    from difflib import SequenceMatcher

    r = random.Random(8)
    names = ["".join(r.choices("abcd ", k=r.randrange(0, 14))) for _ in range(300)]
    for _ in range(100):
        name = "".join(r.choices("abcd ", k=r.randrange(0, 14)))
        ratios = [SequenceMatcher(None, n, name).ratio() for n in names]
        top = max(ratios)
        assert Cell(names, list(range(len(names)))).best(name) == ((ratios.index(top), top) if top else (-1, 0.0))


def test_attempts():
    good = json.dumps({"summary": "s", "confidence": "low"})
    client = clients.ScriptedClient(["no json", good])
    assert [a[1] for a in enrich.run_attempts(client, "s", "u", 10)] == ["invalid_json", "ok"]
    assert "refused (invalid_json)" in client.asked[1]
    assert [a[1] for a in enrich.run_attempts(clients.ScriptedClient(["x", "[]"]), "s", "u", 10)] == ["invalid_json", "schema_fail"]
    assert [a[1] for a in enrich.run_attempts(clients.ScriptedClient([clients.ClientError("down")]), "s", "u", 10)] == ["api_error"]


def test_merge(spark):
    def e(**more):
        return json.dumps({"summary": "s", "confidence": "high", "report_date": None, "actors": [], "techniques": [], "targets": [], "iocs": []} | more)

    one = e(actors=[{"name": "Crew", "attribution_confidence": "suspected"}], techniques=[{"technique_id": "T1078", "evidence_quote": "first"}], targets=[{"country": "AU", "sector": None}])
    two = e(confidence="low", report_date="2024-01-05", actors=[{"name": "CREW", "attribution_confidence": "likely"}], techniques=[{"technique_id": "T1078", "evidence_quote": "second"}], targets=[{"country": "AU", "sector": None}])
    rows = spark.createDataFrame([("d", 0, one), ("d", 1, two), ("single", 0, e(targets=[{"country": "NZ"}, {"country": "NZ"}]))], "document_id string, chunk int, j string")
    from threatlake.schemas import EXTRACTION

    found = rows.select("document_id", "chunk", F.from_json("j", EXTRACTION).alias("extraction"))
    lists = merge.merge_lists(found)
    assert [(r.name, r.attribution_confidence) for r in lists["actors"].collect()] == [("CREW", "likely")]
    assert [r.evidence_quote for r in lists["techniques"].collect()] == ["first"]
    assert sorted(r.country for r in lists["targets"].collect()) == ["AU", "NZ", "NZ"]  # a single chunk passes as it is
    scalars = {r.document_id: r for r in merge.merge_scalars(found).collect()}
    assert (scalars["d"].summary, str(scalars["d"].report_date), scalars["d"].confidence) == ("s s", "2024-01-05", "low")


@pytest.mark.parametrize(("tp", "fp", "fn", "p", "r", "f"), [(2, 0, 0, 1, 1, 1), (0, 1, 1, 0, 0, 0), (2, 1, 1, 2 / 3, 2 / 3, 2 / 3), (0, 0, 2, 0, 0, 0), (0, 3, 0, 0, 0, 0), (0, 0, 0, 1, 1, 1), (2, 0, 3, 1, 0.4, 4 / 7)])
def test_metrics(spark, tp, fp, fn, p, r, f):
    got = M.with_scores(spark.createDataFrame([(tp, fp, fn)], "tp long, fp long, fn long")).first()
    assert (got.precision, got.recall, got.f1) == pytest.approx((p, r, f))


def test_macro_and_rates(spark):
    counts = spark.createDataFrame([("a", 1, 0, 0), ("a", 0, 0, 0), ("a", 0, 1, 1), ("b", 0, 0, 0)], "field string, tp long, fp long, fn long")
    assert {r.field: r.macro_f1 for r in M.macro_f1(counts, "field").collect()} == {"a": 0.5, "b": None}
    rates = spark.createDataFrame([(0, 4), (0, 0), (3, 4)], "n long, d long").select(M.rate(F.col("n"), F.col("d")).alias("r")).collect()
    assert [r.r for r in rates] == [0.0, None, 0.75]


def test_evaluation(spark):
    actors = spark.createDataFrame([("a1", "Crew One", ["APT 2", "APT 28", "APT"], 0)], "id string, canonical_name string, aliases array<string>, load_ordinal long")
    techniques = spark.createDataFrame([("T1078",)], "technique_id string")
    docs = spark.createDataFrame([("d", "APT 28 used T1078, T9999 against US banks; apt.")], "doc string, text string")
    base = evaluate.baseline(docs, techniques, actors)
    assert sorted((r.field, r.item) for r in base.collect()) == [("actors", "Crew One"), ("countries", "US"), ("sectors", "financial services"), ("techniques", "T1078")]
    want = spark.createDataFrame([("d", "techniques", "T1078.001"), ("d", "actors", "Crew One")], "doc string, field string, item string")
    scores = evaluate.score(base, want)
    micro = {r.field: r.f1 for r in scores["micro"].collect()}
    assert micro["techniques"] == 0 and micro["techniques_parent"] == 1
    rates = evaluate.telemetry(spark.createDataFrame([("technique", True, True, None)], "kind string, quote_ok boolean, closed_world_ok boolean, resolved boolean"))
    card = evaluate.scorecard(scores, scores, rates, "Card")
    assert "## Guardrails" in card and "n/a" in card and "passed" in card


def test_evaluation_run(spark, tmp_path):
    fixture = {"id": "0001", "status": "annotated", "document": {"text_file": "0001-a.txt"}, "annotation": {"actors": [{"name": "APT 28"}], "techniques": [{"technique_id": "T1078", "explicit_in_text": False}], "targets": [{"country": "au", "sector": None}]}}
    (tmp_path / "gold").mkdir()
    (tmp_path / "gold" / "0001-a.json").write_text(json.dumps(fixture))
    (tmp_path / "gold" / "0001-a.txt").write_text("The crew APT 28 signed in with stolen accounts of Australian staff.")
    fixtures, _ = gold.load(spark, f"file://{tmp_path}/gold")
    actors = spark.createDataFrame([("a1", "Crew One", ["APT 28"], 0)], "id string, canonical_name string, aliases array<string>, load_ordinal long")
    techniques = spark.createDataFrame([("T1078",)], "technique_id string")
    answer = json.dumps({"summary": "s", "report_date": None, "confidence": "low", "actors": [{"name": "apt 28", "attribution_confidence": "likely"}], "techniques": [{"technique_id": "T1078", "evidence_quote": "signed in with stolen accounts"}], "targets": [{"country": "AU", "sector": None}, {"country": None, "sector": "Moon Mining"}], "iocs": []})
    good, bad = (lambda: clients.ScriptedClient([answer])), (lambda: clients.ScriptedClient(["prose", "prose"]))
    cards = evaluate.run(spark, fixtures, techniques, actors, {"one": (good, "org/m1"), "two": (bad, "m2")}, f"file://{tmp_path}/cards", resolve_gold=True)
    version = clients.prompt_version()
    assert sorted(cards) == sorted([f"one--org-m1--{version}.md", f"two--m2--{version}.md", f"cross-backend--{version}.md"])
    assert all((tmp_path / "cards" / n).read_text() == c for n, c in cards.items())
    one = cards[f"one--org-m1--{version}.md"]
    assert "| actors | 1.000 | 1.000 | 1.000 |" in one and "| quote_validity | 100.0% |" in one and "- none" in one
    assert "- 0001: invalid_json" in cards[f"two--m2--{version}.md"]
    assert "- 0001: invalid_json after 2 attempts: " in cards[f"two--m2--{version}.md"] and "| 0001 | invalid_json | 0.000 |" in cards[f"two--m2--{version}.md"]
    assert all(line in one for line in ("| backend | one |", "| model | org/m1 |", "| documents chunked | 0 of 1 |", "| gold documents | 1 |", "| failed_chunks | 0 |", "| 0001 | ok | 1.000 | 1.000 | 1.000 |"))
    assert "| sectors outside the vocabulary | 1 |" in one and "- sector outside the vocabulary: moon mining" in one
    both = cards[f"cross-backend--{version}.md"]
    assert "| techniques | 1.000 | 0.000 | 0.000 |" in both and "| implicit recall | 1.000 | 0.000 | n/a |" in both
    only = evaluate.run(spark, fixtures, techniques, actors, {}, f"file://{tmp_path}/cards")
    assert list(only) == [f"baseline--{version}.md"]


def test_documents_without_a_prediction_are_skipped(spark):
    """A document that was never asked about isn't scored; one that was and failed is all misses."""
    want = spark.createDataFrame([(d, "actors", "A") for d in ("asked", "failed", "never")], "doc string, field string, item string")
    got = spark.createDataFrame([("asked", "actors", "A")], "doc string, field string, item string")
    processed = spark.createDataFrame([("asked",), ("failed",)], "doc string")
    assert [(r.tp, r.fp, r.fn) for r in evaluate.score(got, want, processed)["micro"].collect()] == [(1, 0, 1)]
    assert [(r.tp, r.fp, r.fn) for r in evaluate.score(got, want)["micro"].collect()] == [(1, 0, 2)]


def test_chunks_and_prompt_files(spark, tmp_path):
    rows = [("a", None, 1, "ok"), ("b", 0, 1, "ok"), ("b", 1, 1, "schema_fail"), ("b", 1, 2, "schema_fail"), ("c", 0, 1, "api_error"), ("c", 1, 1, "api_error")]
    attempts = spark.createDataFrame(rows, "document_id string, chunk_index int, attempt int, status string").withColumn("error", F.lit("why  so"))
    assert evaluate.chunk_counts(attempts).first().asDict() == {"documents": 3, "chunked_documents": 2, "failed_chunks": 3}
    assert evaluate.failed_documents(attempts) == ["c: api_error after 2 attempts: why so"]
    (tmp_path / "one.md").write_text("x")
    first = clients.prompt_version(tmp_path)
    (tmp_path / "one.md").write_text("y")
    assert first != clients.prompt_version(tmp_path) and len(first) == 12
    assert clients.SYSTEM_PROMPT == (clients.PROMPTS / "extract_system.md").read_text()


def test_fixture_export(spark, tmp_path):
    names = spark.createDataFrame([("0007-x.json",), ("0009-y.txt",), ("notes.json",)], "name string")
    assert maintain.next_index(names) == 8 and maintain.next_index(names.limit(0)) == 1
    rows = spark.createDataFrame([(1, 9, "A Title", "https://x.example/1", "cisa", "see https://bad.example/p now")], "id long, score int, title string, source_url string, source_kind string, clean_text string")
    (name,) = maintain.export(rows, 8, f"file://{tmp_path}")
    assert name.startswith("0008-") and json.loads((tmp_path / f"{name}.json").read_text())["status"] == "placeholder"
    assert "hxxps" in (tmp_path / f"{name}.txt").read_text()


def test_second_backend():
    listed = {"data": [{"id": "nomic-embed"}, {"id": "small"}, "odd"]}
    assert clients.advertised("http://h", get=lambda u, h: listed if u == "http://h/v1/models" else None) == ["nomic-embed", "small"]
    assert clients.advertised("http://h", get=lambda u, h: {"data": 3}) is None and clients.advertised("http://h", get=lambda u, h: []) is None
    assert clients.discover_local(lambda root: None) is None
    found = clients.resolve_second({}, discover=lambda: ("http://l/v1", ["nomic-embed", "small"]))
    assert (found.model, found.max_input_tokens, found.source) == ("small", 6000, "local discovery")
    assert clients.resolve_second({"LLM_BASE_URL": "http://b", "EVAL_LOCAL_MODEL": "m"}).source == "LLM_BASE_URL"
    for env, probe in (({"EVAL_LOCAL_BASE_URL": "http://b"}, lambda *a: ["x-embed"]), ({}, None)):
        with pytest.raises(clients.ConfigError):
            clients.resolve_second(env, probe=probe, discover=lambda: None)
    assert clients.provider_hint("x {'message': 'no credit left'}") == "no credit left"
    assert clients.provider_hint("a\n b").startswith("a b (see the key") and len(clients.provider_hint("y " * 500)) < 200


def test_gold(spark, tmp_path):
    good = {"id": "0001", "status": "annotated", "document": {"text_file": "a.txt"}, "annotation": {"actors": [{"name": "Nobody"}], "techniques": [{"technique_id": "t1078", "explicit_in_text": True}], "targets": [{"country": "au", "sector": "banks"}]}}
    (tmp_path / "a.json").write_text(json.dumps(good))
    (tmp_path / "a.txt").write_text("text")
    (tmp_path / "b.json").write_text(json.dumps({"id": "0002", "status": "placeholder", "document": {"text_file": "missing.txt"}}))
    annotated, placeholders = gold.load(spark, f"file://{tmp_path}")
    assert annotated.count() == 1 and placeholders.first().text is None
    actors = spark.createDataFrame([("a1", "Crew", [], 0)], "id string, canonical_name string, aliases array<string>, load_ordinal long")
    problems = gold.defects(annotated, spark.createDataFrame([("T1566",)], "technique_id string"), actors)
    assert sorted(r.problem for r in problems.collect()) == ["unknown technique", "unresolvable actor"]
    for odd in ({"document": {"text": "inline"}}, {"annotation": {"targets": [{"country": None, "sector": None}]}}):
        (tmp_path / "c.json").write_text(json.dumps({"id": "0003", "status": "placeholder"} | odd))
        with pytest.raises(gold.GoldError):
            gold.load(spark, f"file://{tmp_path}")
    (tmp_path / "c.json").unlink()
    (tmp_path / "c.json").write_text(json.dumps(good))
    with pytest.raises(gold.GoldError, match="repeated"):
        gold.load(spark, f"file://{tmp_path}")


def lookup(*addresses):
    return lambda host, port, **_: [(0, 0, 0, "", (a, port)) for a in addresses]


def test_fetch():
    steps = [(302, {"Location": "https://b.example/y"}, []), (200, {"ETag": "e"}, [b"ab", b"c"])]
    client = fetch.Client(lambda u, h, a: steps.pop(0), lookup("8.8.8.8"), sleep=lambda s: None)
    assert client.fetch("https://a.example/x").body == b"abc"
    with pytest.raises(fetch.Blocked):
        fetch.Client(None, lookup("8.8.8.8", "10.0.0.1")).fetch("https://a.example/")
    with pytest.raises(fetch.Blocked):
        fetch.Client(None, lookup("8.8.8.8")).fetch("http://a.example/")
    with pytest.raises(fetch.TooLarge):
        fetch.capped([b"x" * 6, b"x" * 6], None, 10)
    with pytest.raises(fetch.TooLarge):
        fetch.capped([], 11, 10)
    loop = fetch.Client(lambda u, h, a: (302, {"Location": "/z"}, []), lookup("8.8.8.8"), sleep=lambda s: None)
    with pytest.raises(fetch.FetchError):
        loop.fetch("https://a.example/")
    same = fetch.Client(lambda u, h, a: (304, {}, []) if h.get("If-None-Match") == "e" else None, lookup("8.8.8.8"), sleep=lambda s: None)
    assert same.fetch("https://a.example/", etag="e").not_modified


def test_configuration():
    assert clients.provider_of("sk-ant-x") == "anthropic" and clients.provider_of("sk-x") == "openai" and clients.provider_of("x") is None
    assert clients.resolve_completion({"LLM_API_KEY": "sk-ant-x"}).max_input_tokens == 150_000
    with pytest.raises(clients.ConfigError):
        clients.resolve_completion({}, discover=lambda: None)
    local = clients.resolve_completion({}, discover=lambda: ("http://localhost:8000/v1", ["embed-x", "small"]))
    assert (local.base_url, local.model) == ("http://localhost:8000/v1", "small")
    assert clients.resolve_completion({}, probe=lambda: ["nomic-embed", "small"]).model == "small"
    assert clients.resolve_embedding({}) is None
    with pytest.warns(UserWarning):
        assert clients.positive_int({"MAX": "-1"}, "MAX", 5) == 5
    client = clients.HttpClient("https://x.example", "m", post=lambda u, b, h: {"data": [{"index": 1, "embedding": [2.0]}, {"index": 0, "embedding": [1.0]}]})
    assert client.embed(["a", "b"]) == [[1.0], [2.0]]
    with pytest.raises(clients.ClientError):
        client.complete("s", "u", max_tokens=1)


def test_search_guards(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0], "m"), (2, [0.0, 1.0], "m"), (3, None, None)], "report_id long, embedding array<float>, embedding_model string")
    assert [r.report_id for r in api.search(rows, [1.0, 0.1], "m", 2).collect()] == [1, 2]
    with pytest.raises(api.EmbeddingModelMismatch):
        api.search(rows, [1.0, 0.0], "other")
    with pytest.raises(api.SearchDisabled):
        api.search(rows, None, None)


def test_stream(spark, tmp_path):
    from threatlake.streaming import landing

    store = Store(spark, f"file://{tmp_path}/store")
    row = ("f", "https://x.example/1", "t", "<p>a</p>", "some text")
    landed = spark.createDataFrame([row, row], "feed_id string, source_url string, title string, raw_html string, clean_text string").withColumns({"fetched_at": F.lit("2024-01-01").cast("timestamp"), "published_at": F.lit(None).cast("timestamp")})
    landed.write.parquet(f"{tmp_path}/land/one")
    for _ in range(2):
        landing.sink(landing.documents(landing.read(spark, f"file://{tmp_path}/land/*")), store, f"{tmp_path}/cp").awaitTermination()
    assert store.read("raw_document").count() == 1


def test_attempts_go_back_in_small_batches(spark):
    """Many long chunks in one batch: answers are written by slices, each chunk's once and in order."""

    class Stub:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    n = 300
    batch = pa.RecordBatch.from_arrays([pa.array([str(k) for k in range(n)]), pa.array([None if k % 2 else k for k in range(n)], pa.int32()), pa.array([f"T1078 is used by {k}. " * 1000 for k in range(n)])], ["document_id", "chunk_index", "user"])
    out = list(enrich.complete(Stub(), clients.KeywordClient)(iter([batch])))
    assert len(out) > 4 and max(b.num_rows for b in out) < 100
    rows = [r for b in out for r in b.to_pylist()]
    assert [(r["document_id"], r["chunk_index"], r["status"]) for r in rows] == [(str(k), None if k % 2 else k, "ok") for k in range(n)]
