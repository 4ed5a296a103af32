"""Periodic runs, decontamination and the filter audit against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threatlake.llm import decontaminate, filter_audit, periodic_runs, queries

from . import brute

DATA = "/root/testdata/sf0.001"
CLASHING = ("runs", "row", "told", "body", "spans", "items", "spans_so_far", "hashes", "cls", "first", "own_id", "label_id", "part", "duplicate", "mask", "before", "good")


def clashing(df):
    return df.withColumns({c: F.lit("own") for c in CLASHING if c not in df.columns})


def periodic_rows(seed=5, n=60):
    r, out = random.Random(seed), []
    for i in range(n):
        w = [r.choice("abcde"[: r.randint(1, 5)]) for _ in range(r.randint(0, 120))]
        if w and r.random() < 0.7:
            a, p = r.randrange(len(w)), r.randint(1, 30)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        out.append((i if r.random() < 0.9 else None, r.choice([" ", "\n", "  "]).join(w)))
    return out + [(900, "same " * 3000), (901, " ".join(f"w{k % 700}" for k in range(2100)))]


@pytest.mark.parametrize(("least", "long_bytes", "lags"), [(12, 1 << 20, 4096), (12, 40, 7), (5, 40, 1000)])
def test_runs(docs, odd, least, long_bytes, lags):
    """Texts beyond long_bytes have their lags dealt to several tasks."""
    rows = periodic_rows() + odd
    got = periodic_runs.collapse_runs(clashing(docs(rows, clash=True)), least, long_bytes=long_bytes, lags=lags)
    assert got.filter("told = 'own' and row = 'own'").count() == len(rows)
    found = sorted(((x.doc_id, x.n_words, [tuple(r[c] for c in ("start", "length", "period")) for r in x.runs], x.text) for x in got.collect()), key=str)
    split = [(i, brute.WORD.findall(t or "")) for i, t in rows]
    assert found == sorted(((i, len(w), (own := brute.runs(w, least)), brute.collapse(w, own)) for i, w in split), key=str)
    assert sum(bool(x[2]) for x in found) > 20


def test_multiples_of_a_period_are_one_run():
    ids = np.array([0, 1] * 30 + [0, 0, 1] * 20, np.uint64)
    got = sorted(periodic_runs.lag_scan(ids, np.array([0, 120])))
    assert got == sorted((0, s, s + n, q) for s, n, q in brute.runs(ids.tolist())) and {x[3] for x in got} == {2, 3}


def test_no_documents(docs):
    none = docs([(1, "a")]).where("doc_id = 2")
    items = docs([(1, "a b")]).withColumnRenamed("doc_id", "item_id")
    assert periodic_runs.collapse_runs(none).collect() == []
    assert decontaminate.decontaminate(none, items).collect() == []
    assert [r.n_hit for r in decontaminate.decontaminate(docs([(1, "a b")]), items.where("item_id = 2")).collect()] == [0]
    labels = docs([(1, "a")]).selectExpr("doc_id", "1 as quality", "0 as toxic")
    assert filter_audit.audit(none.withColumn("lang", F.lit("x")), labels).collect() == []


def test_periodic_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    want = []
    for i, text in texts:
        w = brute.planted(i, text)
        own = brute.runs(w)
        s, n, q = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else (None, None, None)
        want.append((i, len(own), s, n, q, 1000 * n // q if own else None, brute.sha("".join(f"{a},{b},{c}\n" for a, b, c in own)), brute.sha(brute.collapse(w, own))))
    assert sorted(map(tuple, queries.op13_periodic_runs(spark, DATA).collect())) == sorted(want)
    assert sum(x[1] > 0 for x in want) > 10


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away into the woods today"), (2, "one TWO three"), (3, None), (4, " - ! "), (5, "été à la plage"), (None, "alpha beta gamma"),
    (6, "a a a a a a a a a a a a a a"), (6, "b c d"), (7, "the quick brown fox jumps over the lazy dog and"), (8, "solo"), (10, "x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11 x12 " * 3),
]


def leak_rows(seed=2, n=80):
    r, out = random.Random(seed), []
    own = [t for _, t in ITEMS if t]
    for i in range(n):
        w = r.choices(["own", "w", "a", "the", "one", "two"], k=r.randint(0, 30))
        for _ in range(r.randint(0, 2)):
            t = r.choice(own).split()
            a = r.randrange(len(t))
            at = r.randint(0, len(w))
            w[at:at] = t[a : a + r.randint(1, 14)]
        out.append((i if r.random() < 0.9 else i // 2, r.choice([" ", "\n", ", "]).join(w)))
    return out


@pytest.mark.parametrize(("window", "group_words"), [(10, None), (3, None), (10, 20), (4, 9)])
def test_leaks(docs, odd, spark, window, group_words):
    """Also through several groups of items, one pass each, and by pieces of items."""
    rows = leak_rows() + odd + [(300, "Bonjour, Été à LA plage! é"), (301, "ONE\x00two-three solo")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.decontaminate(clashing(docs(rows, clash=True)), items, window, group_words=group_words).collect()
    want = brute.leaks(rows, ITEMS, window)
    found = [(x.doc_id, x.n_words, sorted({k for s in x.spans for k in range(s.start, s.end)}), x["items"]) for x in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert all(x.n_hit == len({k for s in x.spans for k in range(s.start, s.end)}) and x.contaminated == (x.n_hit > 0) and x.spans_so_far == "own" for x in got)
    assert sum(bool(x[2]) for x in want) > 20


def test_pieces_lose_no_window(spark, docs):
    words = [f"w{k % 97}x{k}" for k in range(9000)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    rows = [(k, " ".join(["x", *words[k : k + 10], "y"])) for k in (0, 4086, 4087, 4090, 4095, 4096, 4097, 8190, 8192, 8990)]
    got = decontaminate.decontaminate(docs(rows), items, 10).collect()
    assert {(x.doc_id, x.n_hit, x.longest) for x in got} == {(k, 10, 10) for k, _ in rows}
    assert all(x.text == "" for x in got)


def test_spans_are_removed(docs, spark):
    items = spark.createDataFrame([(1, "secret test item of words")], "item_id long, text string")
    got = {x.doc_id: x.text for x in decontaminate.decontaminate(docs([(1, "Before: Secret TEST item, of words. After that more text of our own."), (2, "a secret test item of words")]), items, 5, max_coverage=0.5).collect()}
    assert got == {1: "Before: . After that more text of our own.", 2: ""}


@pytest.mark.parametrize("hash_bits", [64, 0, 3])
def test_audit(docs, spark, odd, hash_bits):
    """Few bits make hashes clash: only the full texts tell rows apart."""
    r = random.Random(4)
    long = " ".join(r.choices([f"v{k}" for k in range(500)], k=900))
    texts = [long, long[:-1] + "Z", long + " x", " ".join(f"u{k}" for k in range(120)), "A B C " * 40, "plain words", "50 % off", *[t for _, t in odd]]
    rows = [(r.choice([*range(60), None]), r.choice(texts), r.choice(["en", "de", None, ""])) for _ in range(200)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(40) for _ in range(r.randint(0, 2))] + [(None, 1, 1)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = filter_audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), hash_bits=hash_bits)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == brute.audit(rows, labels)


def test_refinement_drops_single_rows(docs):
    """Classes that are left hold two rows or more of equal length and equal blocks."""
    base = "x" * 5000
    rows = [(1, base), (2, base), (3, base[:-1] + "y"), (4, "y" + base[1:]), (5, base[:600] + "y" + base[601:]), (6, "short"), (7, "short"), (8, "alone")]
    scanned = filter_audit.scan(docs(rows), {"id": "doc_id"})
    keys = {x.id: x.key for x in scanned.collect()}
    assert {x.key for x in filter_audit.refine(scanned).collect()} == {keys[1], keys[6]}
    assert keys[1] == keys[2] and len({keys[k] for k in (1, 3, 4, 5)}) == 4
