"""The top-1 similarity join gives difflib's arg-max, ties by load order."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from threatlake.operators import guardrails as G
from threatlake.operators import similar

DATA = "/root/testdata/sf0.001"


def plain(name, listed):
    """listed: (name, id) in load order."""
    top, best = 0.0, None
    for n, i in listed:
        m = SequenceMatcher(None, n, name)
        if m.quick_ratio() > top and (got := m.ratio()) > top:
            top, best = got, i
    return best, top or None


def invented(seed, n):
    r = random.Random(seed)
    parts = ["apt", "volt", "panda", "bear", "kitten", "storm", "ty", "phoon", "lazar", "us", "28", "29", "é", "日本", "group ", "team-"]
    return ["".join(r.choices(parts, k=r.randint(1, 6))) for _ in range(n)]


@pytest.mark.parametrize(("cell_names", "cell_asked"), [(50_000, 20_000), (40, 25)])
def test_most_similar(spark, monkeypatch, cell_names, cell_asked):
    monkeypatch.setattr(similar, "CELL_NAMES", cell_names)
    monkeypatch.setattr(similar, "CELL_ASKED", cell_asked)
    listed = [(n, f"id{k}") for k, n in enumerate(dict.fromkeys(invented(1, 700)))]
    asked = [*invented(2, 80), "zzzz", "x" * 300, "apt" * 90, "q", "volt" * 60 + "panda"]
    index = spark.createDataFrame([(n, i, k) for k, (n, i) in enumerate(listed)], "name_key string, actor_id string, ordinal long").repartition(3)
    got = similar.most_similar(spark.createDataFrame([(n,) for n in asked], "name_key string"), index)
    assert {r.name_key: (r.actor_id, r.score) for r in got.collect()} == {n: plain(n, listed) for n in asked}


def test_no_names_or_nothing_asked(spark):
    index = spark.createDataFrame([("volt", "a", 0)], "name_key string, actor_id string, ordinal long")
    asked = spark.createDataFrame([("bolt",)], "name_key string")
    assert [tuple(r) for r in similar.most_similar(asked, index.where("ordinal > 0")).collect()] == [("bolt", None, None)]
    assert similar.most_similar(asked.limit(0), index).collect() == []


def test_whole_tables_names(spark):
    """Every name that the orders of a table misspell, against all suppliers."""
    s = spark.read.parquet(f"{DATA}/supplier.parquet").select("s_suppkey", "s_name")
    c = spark.read.parquet(f"{DATA}/customer.parquet").select("c_custkey", "c_name")
    listed = [(r.s_name.lower(), r.s_suppkey) for r in s.orderBy("s_suppkey").collect()]
    index = G.name_index(s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("canonical_name"), F.lit(None).cast("array<string>").alias("aliases"), F.col("s_suppkey").alias("load_ordinal")))
    got = G.resolve_actors(c.select("c_custkey", F.regexp_replace("c_name", "Customer", "Supler").alias("name")), index).collect()
    want = {r.c_custkey: plain(r.c_name.replace("Customer", "Supler").lower(), listed) for r in c.collect()}
    assert {r.c_custkey: (r.best_match_actor_id, r.best_match_score) for r in got if r.match != "exact"} == {k: want[k] for k in (r.c_custkey for r in got if r.match != "exact")}
    assert all(r.match == "fuzzy" and r.actor_id == want[r.c_custkey][0] for r in got if r.match != "exact" and want[r.c_custkey][1] > 0.9)
    assert len(got) == c.count()


def test_numbered_names_cost_few_comparisons(monkeypatch):
    """Names that differ in their numbers only: what one asked name costs doesn't follow the number of names."""
    asked = [*(f"s {k}" for k in range(7, 20_000, 900)), *(f"suplier#{k:09d}" for k in range(3, 20_000, 900)), "s 5", "zz"]
    calls = []

    class Counted(SequenceMatcher):
        def ratio(self):
            calls.append(1)
            return super().ratio()

    for form in ("sup {:09d}", "supplier#{:09d}"):
        names, ordinals = [form.format(k) for k in range(20_000)], [k * 3 for k in range(20_000)]
        monkeypatch.setattr(similar, "SequenceMatcher", Counted)
        scores, order = [0.0] * len(asked), [1 << 62] * len(asked)
        calls.clear()
        got = similar.Tree(names, ordinals).best(asked, scores, order)
        assert len(calls) < 40 * len(asked)
        monkeypatch.undo()
        cell = similar.Cell(names, ordinals)
        assert list(zip(got, scores, strict=True)) == [cell.best(n) for n in asked]


def test_trees_agree_with_cells_from_any_start():
    r = random.Random(3)
    names = list(dict.fromkeys(invented(5, 400)))
    asked = [n[:63] for n in invented(6, 30)] + ["q"]
    for length in {len(n) for n in names}:
        own = [n for n in names if len(n) == length]
        ordinals = r.sample(range(900), len(own))
        start = [(r.choice([0.0, 0.3, 0.5]), r.choice([1 << 62, 400])) for _ in asked]
        scores, order = [s for s, _ in start], [o for _, o in start]
        got = similar.Tree(own, ordinals).best(asked, scores, order)
        assert list(zip(got, scores, strict=True)) == [similar.Cell(own, ordinals).best(n, s, o) for n, (s, o) in zip(asked, start, strict=True)]
