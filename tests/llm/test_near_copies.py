"""The pipeline's near copies against exact shingle sets."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from threatlake.llm import near_copies, simhash

from . import brute

TESTDATA = "/root/testdata"


def edited(words, n, rng):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.random()}"
    return " ".join(out)


@pytest.mark.parametrize(("small", "most"), [(16, 20_000), (2, 20_000), (3, 8)])
def test_similar_documents(docs, odd, monkeypatch, small, most):
    """With all buckets small, with hubs, and with buckets tried in parts."""
    monkeypatch.setattr(near_copies, "SMALL", small)
    monkeypatch.setattr(near_copies, "MOST", most)
    rng = random.Random(3)
    rows = [(i, t) for i, t in odd if i is not None]
    for base in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 300))]
        rows += [(1000 + base * 10 + k, edited(words, len(words) * k // 60, rng)) for k in range(5)]
    words = [f"w{rng.randrange(5000)}" for _ in range(200)]
    rows += [(5000 + k, edited(words, rng.randrange(12), rng)) for k in range(60)]
    got = simhash.similar_documents(docs([*rows, (None, "none but me"), (None, " \n")], clash=True)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == sorted(brute.similar(rows))
    assert sorted((r.component_id for r in got if r.doc_id is None), key=str) == [1, None]
    assert not simhash.similar_documents(docs([])).count()


def bands_of(texts):
    """(texts, BANDS) of the bands' keys."""
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    return np.concatenate([x.column("bands").flatten().to_numpy().reshape(-1, near_copies.BANDS) for x in near_copies._sketch(5)([batch])])


def thin_pairs(rng, want=3, crowded=6):
    """Pairs at 57 / 71 that share one band only, and sets similar to neither that crowd that band's bucket."""
    rows, found = [], 0
    while found < want:
        texts = []
        for _ in range(3000):
            words = [f"w{x}" for x in rng.choices(range(5000), k=68)]
            texts += [" ".join(words), " ".join([*(f"x{x}" for x in rng.choices(range(5000), k=7)), *words[7:]])]
        bands = bands_of(texts)
        same = bands[::2] == bands[1::2]
        for k in (same.sum(axis=1) == 1).nonzero()[0].tolist():
            words, band = texts[2 * k].split(), int(same[k].argmax())
            crowd = [" ".join([*words[at : at + 35], *(f"y{rng.randrange(10**6)}" for _ in range(12))]) for at in (rng.randrange(7, 34) for _ in range(1500))]
            crowd = [crowd[x] for x in (bands_of(crowd)[:, band] == bands[2 * k, band]).nonzero()[0][:24]]
            if len(crowd) >= crowded:
                found += 1
                rows += [texts[2 * k], texts[2 * k + 1], *crowd]
    return list(enumerate(dict.fromkeys(rows)))


@pytest.mark.parametrize("most", [20_000, 5, 2])
def test_links_do_not_hang_on_bucket_sizes(docs, monkeypatch, most):
    """Pairs that meet in a crowded bucket alone are linked whether it is tried whole or in parts."""
    monkeypatch.setattr(near_copies, "SMALL", 2)
    monkeypatch.setattr(near_copies, "MOST", most)
    rows = thin_pairs(random.Random(11))
    want = sorted(brute.similar(rows))
    assert sum(i != c for i, c in want) >= 3
    got = simhash.similar_documents(docs(rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == want


@pytest.mark.parametrize("most", [3, 7, 100])
def test_cells_hold_each_pair_once(spark, monkeypatch, most):
    """Pairs outside of the main component and pairs with it: all, once, in cells of bounded size."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(near_copies, "MOST", most)
    rows = spark.range(60).select(F.lit(5).cast("long").alias("key"), F.col("id").alias("cls"), F.when(F.col("id") < 40, 0).otherwise(F.col("id")).cast("long").alias("root"))
    rows = rows.select("*", F.lit(0).cast("long").alias("main"), F.lit(40).cast("long").alias("inside"), F.lit(60).cast("long").alias("sets"))
    cells = {}
    for r in near_copies._cells(rows).collect():
        cells.setdefault(r.key, []).append((r.cls, r.side))
    pairs = []
    for have in cells.values():
        every, left, right = sorted(c for c, s in have if s == 0), [c for c, s in have if s < 2], [c for c, s in have if s == 2]
        pairs += [(x, y) for k, x in enumerate(every) for y in every[k + 1 :]] + [tuple(sorted((x, y))) for x in left for y in right]
    assert sorted(pairs) == [(x, y) for x in range(60) for y in range(max(x + 1, 40), 60)]
    assert max(map(len, cells.values())) <= max(60 if most == 100 else 0, 6 * most)


def test_pruning_bounds_hold():
    """Pairs at the similarity pass the fingerprints; the chain check never contradicts the full one."""
    import numpy as np

    r = np.random.default_rng(5)
    lost = 0
    for n in [5, 8, 20, 60, 200, 900] * 30:
        common, only = r.integers(0, 2**63, n, dtype=np.uint64), r.integers(0, 2**63, n // 4, dtype=np.uint64)
        cut = r.integers(0, len(only) + 1)
        values = np.concatenate([common, only[:cut], common, only[cut:]])
        first = np.array([0, n + cut, len(values)])
        for lanes in (near_copies.NARROW, near_copies.WIDE):
            fp, bits = near_copies.fingerprints_of(values, first, lanes), near_copies.most_bits(0.8, lanes, n < near_copies.COARSE)
            ok = simhash.chained(fp[:1], fp[1:], bits)[0]
            assert ok == (np.bitwise_count(fp[0] ^ fp[1]).sum() <= bits)
            lost += not ok
    assert not lost


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_stage_is_exact(spark, sf):
    docs = spark.read.parquet(f"{TESTDATA}/{sf}/documents.parquet")
    kept = {i for i, c in brute.similar([(r.doc_id, r.text) for r in docs.collect()]) if i == c}
    assert {r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, "").collect()} == kept
