"""The automaton finds what one alternation of all names finds, longest first."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from threatlake.operators.find_names import Automaton, find_names, leftmost_longest
from threatlake.plans import evaluate


def alternation(names):
    listed = sorted(names, key=lambda n: (-len(n), n))
    return "(?iu)(?<![\\p{L}\\p{N}_])(?:" + "|".join("\\Q" + n + "\\E" for n in listed) + ")(?![\\p{L}\\p{N}_])"


WORDS = ["APT", "28", "volt", "Typhoon", "é", "Éclair", "ß", "panda", "x_y", "日本", "a"]
GAPS = [" ", "-", "  ", "(", ")", ".", "!"]


def made(r, n):
    return "".join(r.choice(WORDS) + r.choice([*GAPS, ""]) for _ in range(n))


@pytest.mark.parametrize("shard_names", [None, 40])
def test_equals_the_alternation(spark, shard_names):
    r = random.Random(3)
    names = list({n for n in (made(r, r.randint(1, 4)).strip() for _ in range(150)) if n} | {"(volt)", "-a", "a)"})
    first = {}
    for n in names:
        first.setdefault(n.lower(), n)
    names = list(first.values())
    texts = [(k, r.choice([str.upper, str.lower, str])(made(r, 40)).replace("SS", "ß")) for k in range(150)] + [(900, None), (901, ""), (902, "volt")]
    docs = spark.createDataFrame(texts, "doc long, text string").repartition(3)
    got = find_names(docs, spark.createDataFrame([(n, n.lower()) for n in names], "name string, key string"), shard_names=shard_names)
    want = docs.select("doc", F.explode(F.regexp_extract_all("text", F.lit(alternation(names)), F.lit(0))).alias("key")).select("doc", F.lower("key").alias("key")).distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 100


def test_many_names_one_pass():
    names = [(f"actor {k % 300} of {k}", str(k)) for k in range(100_000)]
    built = Automaton(names)
    text = " ".join(f"noise actor {k % 300} of {k} and actor {k % 299}" for k in range(0, 100_000, 50))
    began = time.time()
    got = leftmost_longest(built.all(text))
    assert [key for _, _, key in got] == [str(k) for k in range(0, 100_000, 50)]
    assert time.time() - began < 5


def test_find_actors(spark):
    docs = spark.createDataFrame([("d", "Fancy  Bear and fancy bear, APT28; not APT281 nor 1234"), ("e", "the lazarus group")], "doc string, text string")
    actors = spark.createDataFrame([("1", "APT28", ["Fancy Bear", "1234"], 0), ("2", "Lazarus", ["Lazarus Group", "APT28"], 1), ("3", "Bear", None, 2)], "id string, canonical_name string, aliases array<string>, load_ordinal long")
    assert sorted(map(tuple, evaluate.find_actors(docs, actors).collect())) == [("d", "APT28"), ("d", "Bear"), ("e", "Lazarus")]
