"""Substring, line and SimHash deduplication against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threatlake.llm import line_dedup, simhash, substring_dedup
from threatlake.llm.graph import components

from . import brute


def shared_texts(seed=1, n=60):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(12)]
    passage = r.choices(words, k=60)
    out = []
    for i in range(n):
        own = r.choices(words, k=r.randint(0, 50))
        if r.random() < 0.5:
            a = r.randint(0, 40)
            own[len(own) // 2 : len(own) // 2] = passage[a : a + r.randint(5, 25)]
        out.append((i if r.random() < 0.9 else i // 2, r.choice([" ", "\n", "  "]).join(own)))
    return out


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize(("window", "blocks", "direct"), [(2, None, 4096), (5, 9, 4), (13, None, 4096), (13, 40, 4), (20, None, 4096), (50, None, 4096), (50, 17, 4)])
def test_substring(docs, odd, window, blocks, direct, monkeypatch):
    """Also through nodes, beyond the number of blocks that ask every shard by themselves."""
    monkeypatch.setattr(substring_dedup, "DIRECT_BLOCKS", direct)
    long = [f"l{k}" for k in range(120)]
    rows = shared_texts() + odd + [(200 + k, " ".join(["own", str(k), *long[a:b], "end"])) for k, (a, b) in enumerate([(0, 120), (10, 59), (10, 60), (0, 60), (40, 100), (3, 40), (0, 30), (90, 120), (0, 120)])]
    got = substring_dedup.remove_repeats(docs(rows, clash=True), window, layout="words", blocks_wanted=blocks)
    want = sorted(brute.substring(rows, window), key=str)
    assert found(got, "doc_id", "n_words", "n_removed", F.sha2("text", 256)) == want
    assert any(x[2] for x in want if (x[0] or 0) >= 200)
    assert "__x" in got.columns


def test_substring_levels_ask_only_survivors():
    """A level is asked by windows that passed the levels before it, and no repeat of a whole window fails to pass."""
    passage = [f"p{k}" for k in range(50)]
    texts = [" ".join(passage), " ".join(["x", *passage, "y"]), " ".join(passage[:30] + ["z"] * 30)]
    raw = [t.encode() for t in texts]
    w = substring_dedup.Windows(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 50)
    assert w.steps == [7, 13, 25, 50]
    told, alive = [], []
    for level in range(3):
        at = w.alive(told, 8)
        alive.append({int(w.doc[k]) for k in at})
        keys = substring_dedup._base_key(w.anchor(level)[at], 8)
        mine = {d: set(keys[w.doc[at] == d].tolist()) for d in alive[-1]}
        told.append(np.array(sorted({k for d in mine for k in mine[d] if sum(k in x for x in mine.values()) > 1}), np.uint64))
    assert alive[0] == {0, 1, 2} and {int(w.doc[k]) for k in w.alive(told, 8)} == {0, 1}


def test_substring_refuses_other_ids(spark):
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_substring_cut_keeps_form(docs):
    twice = " ".join(f"p{k}" for k in range(14))
    got = substring_dedup.remove_repeats(docs([(1, twice), (2, f"A\n\nb {twice}\nc  d")]), 13).where("doc_id = 2").first()
    assert (got.text, got.n_removed) == ("A\n\nb\nc  d", 14)


def test_substring_levels():
    assert substring_dedup.levels(13) == [7, 13] and substring_dedup.levels(50) == [7, 13, 25, 50] and substring_dedup.levels(4) == [4]


def test_empty_tables(docs):
    none = docs([])
    assert substring_dedup.remove_repeats(none).count() == 0
    assert line_dedup.drop_common_lines(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, -1])
def test_lines(docs, odd, broadcast_bytes):
    rows = odd + [(100 + k, f"Common Line\nown {k}\n  common line\t\n{'pair' if k % 2 else ''}") for k in range(9)] + shared_texts(2)
    for min_docs in (2, 5, 9, 10):
        got = line_dedup.drop_common_lines(docs(rows, clash=True), min_docs, broadcast_bytes=broadcast_bytes)
        assert found(got, "doc_id", "n_lines", "n_dropped", "text") == sorted(brute.lines(rows, min_docs), key=str)


def test_perfect_hash_is_minimal():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 5000):
        h, g = r.integers(0, 2**63, n, dtype=np.uint64), r.integers(0, 2**63, n, dtype=np.uint64)
        if n > 1:
            h[1] = h[0]  # keys that differ in their second half only
        mph = line_dedup.MinimalPerfectHash.build(h, g)
        assert sorted(mph.index(h, g).tolist()) == list(range(n))
        sizes, words, prints, counts = line_dedup.LineShard.build(h, g, np.arange(1, n + 1))
        shard = line_dedup.LineShard(sizes, words, prints, counts)
        assert shard.count(h, g).tolist() == list(range(1, n + 1))
        foreign = r.integers(0, 2**63, 1000, dtype=np.uint64)
        assert not shard.count(foreign, foreign).any()


@pytest.mark.parametrize(("size", "bits"), [(3, 3), (5, 7), (3, 0)])
def test_near_duplicates(docs, odd, size, bits):
    r = random.Random(3)
    rows, base = list(odd), [r.choices([f"t{k}" for k in range(300)], k=80) for _ in range(6)]
    for k in range(60):
        own = list(r.choice(base))
        for _ in range(r.randint(0, 4)):
            own[r.randrange(len(own))] = "changed"
        rows.append((1000 + k, " ".join(own)))
    got = simhash.near_duplicates(docs(rows, clash=True), size, bits)
    want = [(i, f - (1 << 64) if f >> 63 else f, c) for i, f, c in brute.near(rows, size, bits)]
    assert found(got, "doc_id", "fingerprint_bits", "component_id") == sorted(want, key=str)


@pytest.mark.parametrize(("bits", "most"), [(3, 20_000), (7, 40), (12, 30), (3, 5)])
def test_links_connect_what_brute_force_connects(spark, bits, most):
    r = np.random.default_rng(bits)
    values = set()
    for b in r.integers(0, 2**63, 30, dtype=np.uint64).tolist():
        for _ in range(40):
            x = b
            for k in r.choice(64, r.integers(0, 6), replace=False):
                x ^= 1 << int(k)
            values.add(x)
    u = np.array(sorted(values), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in u.view(np.int64)], "fp long")
    got = {x.node: x.root for x in components(simhash.links(df, bits, most)).collect()}
    group = np.arange(len(u))
    while True:
        new = np.array([group[np.bitwise_count(u ^ x) <= bits].min() for x in u])
        if (new == group).all():
            break
        group = new
    mine, theirs = {}, {}
    for g, x in zip(group.tolist(), u.view(np.int64).tolist(), strict=True):
        theirs.setdefault(g, set()).add(x)
        mine.setdefault(got.get(x, x), set()).add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_a_chain(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(chain).collect()} == {0}
