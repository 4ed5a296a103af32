"""Quotes in a corpus: the pairs that the verdict alone would give over all texts and quotes."""

from __future__ import annotations

import random

import pytest

from threatlake.functions.udfs import canonical
from threatlake.operators import quotes


@pytest.mark.parametrize("filter_bits", [1 << 23, 1 << 12])
def test_equals_the_verdict_on_all_pairs(spark, monkeypatch, filter_bits):
    monkeypatch.setattr(quotes, "FILTER_BITS", filter_bits)
    r = random.Random(6)
    words = ["attack", "on", "the", "“energy”", "grid", "of", "été", "x" * 25, "a-b", "ﬁle", "wait…"]
    texts = [(k, r.choice([" ", "  ", "\n"]).join(r.choices(words, k=r.randint(0, 60)))) for k in range(120)] + [(500, None), (501, ""), (501, "")]
    asked = []
    for k in range(150):
        own = r.choice(texts[:120])[1].split()
        a, n = r.randrange(len(own) + 1), r.choice([1, 2, 3, 4, 6, 8, 9, 15])
        q = " ".join(own[a : a + n])
        asked.append((k, q[r.randint(0, 2) : len(q) - r.randint(0, 2)]))
    asked += [(900, None), (901, ""), (902, "never written in any of the texts at all, no")]
    got = quotes.quoted_in(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), spark.createDataFrame(asked, "item_id int, text string"))
    want = {(i, d) for i, q in asked for d, t in texts if q is not None and t is not None and len(canonical(q)) >= 20 and "..." not in canonical(q) and canonical(q) in canonical(t)}
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 100


def test_rows_follow_the_hits(spark):
    texts = spark.createDataFrame([(k, f"no quote in here at all, {k} times over and over again, " * 20) for k in range(200)] + [(999, "it said the grid of the north was down for two days")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "the grid of the north was down for two days")], "item_id int, text string")
    assert [tuple(x) for x in quotes.quoted_in(texts, asked).collect()] == [(1, 999)]
