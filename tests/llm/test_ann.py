"""Neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from threatlake.llm.ann import Codebooks, search


def test_recall_and_exact_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.select("vec_id", "embedding").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    hit = n = 0
    got = {}
    for r in search(vectors, vectors.where("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for k in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[k]) ** 2).sum(axis=1))
        d[k] = np.inf
        want = ids[np.lexsort((ids, d))[:10]]
        own = sorted(got[ids[k]])
        assert [r for r, *_ in own] == list(range(1, 11))
        hit, n = hit + len({v for _, v, _ in own} & {*want.tolist()}), n + 10
        assert all(s == pytest.approx(d[np.flatnonzero(ids == v)[0]], abs=1e-12) for _, v, s in own)
    assert hit / n >= 0.9


def test_odd_vectors_and_ties(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [1.0, 0.1]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [5.0, 5.0]), (9, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("own"))
    got = [(r["rank"], r.vec_id) for r in search(table, table.where("vec_id in (0, 3, 4)")).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 2), (3, 8)]
    assert search(table.limit(0), table).count() == 0 and search(table, table.limit(0)).count() == 0


def test_double_vectors_keep_their_digits(spark):
    """Scores of double vectors are exact on the vectors as they are, not on rounded ones; the two sides may differ in type."""
    x = np.random.default_rng(5).normal(size=(300, 8)) * 1.2345678901234567
    doubles = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    for asked, y in ((doubles, x), (doubles.withColumn("embedding", F.col("embedding").cast("array<float>")), x.astype(np.float32).astype(np.float64))):
        got = sorted(map(tuple, search(doubles, asked.where("vec_id % 100 = 0")).collect()))
        want = []
        for k in range(0, 300, 100):
            d = np.sqrt(((x - y[k]) ** 2).sum(axis=1))
            d[k] = np.inf
            want += [(k, n + 1, int(v), d[v]) for n, v in enumerate(np.argsort(d)[:10])]
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert max(abs(g[3] - w[3]) for g, w in zip(got, want, strict=True)) < 1e-14


def test_query_blocks_agree(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    asked = vectors.where("vec_id % 50 = 0")
    one, many = (sorted(map(tuple, search(vectors, asked, query_block=b).collect())) for b in (4096, 3))
    assert one == many


@pytest.mark.parametrize("copies", [0, 1])
def test_batches_agree_and_clusters_stay_whole(spark, copies):
    """The same neighbours from small and large batches; with a third of the rows in one tight cluster none is lost."""
    r = np.random.default_rng(2)
    x = r.normal(size=(6000, 24))
    if copies:
        x[::3] = x[0] + 1e-3 * r.normal(size=x[::3].shape)
    x = x.astype(np.float32)
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    asked, got = table.where("vec_id % 100 = 0"), []
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for rows in (500, 100_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        got.append(sorted((q.query_id, q["rank"], q.vec_id) for q in search(table, asked).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = []
    for k in range(0, 6000, 100):
        d = ((x.astype(np.float64) - x[k]) ** 2).sum(axis=1)
        d[k] = np.inf
        want += [(k, n + 1, int(v)) for n, v in enumerate(np.lexsort((np.arange(6000), d))[:10])]
    assert got[0] == got[1]
    assert len({*got[0]} & {*want}) >= 0.99 * len(want)


def test_reconstruction_improves_with_the_beam():
    x = np.random.default_rng(1).normal(size=(400, 16)).astype(np.float32)
    books = Codebooks.fit(x)

    def error(beam):
        codes, norms, left = books.encode(x, beam)
        back = sum(books.words[m][codes[:, m]] for m in range(len(books.words)))
        assert np.allclose((back**2).sum(axis=1), norms, rtol=1e-3, atol=1e-3)
        assert np.allclose(((x - back) ** 2).sum(axis=1), left, rtol=1e-3, atol=1e-3)
        return ((x - back) ** 2).sum()

    assert error(4) <= error(1)
