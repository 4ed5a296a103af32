"""The inverted file gives the top k of the whole table and reads few vectors where they are clustered."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from threatlake.operators import vectors
from threatlake.plans import api


def clustered(n=6000, clusters=60, width=16):
    r = np.random.default_rng(4)
    centres = r.normal(size=(clusters, width))
    return centres[r.integers(clusters, size=n)] + 0.05 * r.normal(size=(n, width))


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    x = clustered()
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(7000, None), (7001, [0.0] * 16), (7002, [1.0, 2.0]), (7003, [None] + [1.0] * 15), (7004, x[5].tolist()), (7005, (2 * x[5]).tolist())]
    table = spark.createDataFrame(rows, "report_id long, embedding array<float>").repartition(3)
    folder = str(tmp_path_factory.mktemp("index"))
    vectors.build(table, folder)
    return table, folder, x


def test_same_top_k_and_a_tenth_read(spark, indexed):
    table, folder, x = indexed
    r = np.random.default_rng(7)
    read = []
    for q in [x[5], x[100] + 0.01 * r.normal(size=16), -x[7], 3 * x[2000]]:
        q = [float(v) for v in q]
        for k in (1, 10):
            got, n = vectors.search(spark, folder, q, k)
            assert [tuple(y) for y in got.collect()] == [tuple(y) for y in api.nearest(table, q, k).collect()]
            read.append(n)
    assert np.median(read) <= len(x) / 10


def test_far_queries_and_more_than_there_are(spark, indexed):
    table, folder, _ = indexed
    q = [1.0] * 16
    got, _ = vectors.search(spark, folder, q, 10)
    assert [tuple(y) for y in got.collect()] == [tuple(y) for y in api.nearest(table, q, 10).collect()]
    got, n = vectors.search(spark, folder, q, 9000)
    assert got.count() == api.nearest(table, q, 9000).count() and n >= got.count()
    assert [tuple(y) for y in vectors.search(spark, folder, [1.0, 1.0], 3)[0].collect()] == [tuple(y) for y in api.nearest(table, [1.0, 1.0], 3).collect()]
    assert vectors.search(spark, folder, [0.0] * 16, 3)[0].count() == 0


def test_whole_table(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(F.col("vec_id").alias("report_id"), "embedding")
    vectors.build(table, str(tmp_path / "i"))
    for q in table.where("report_id in (0, 17)").collect():
        assert [tuple(y) for y in vectors.search(spark, str(tmp_path / "i"), list(q.embedding), 10)[0].collect()] == [tuple(y) for y in api.nearest(table, list(q.embedding), 10).collect()]


def test_api_search_by_the_index(spark, indexed):
    table, folder, x = indexed
    report = table.withColumn("embedding_model", F.lit("m"))
    q = [float(v) for v in x[5]]
    assert api.search(report, q, "m", 5, index=folder).collect() == api.search(report, q, "m", 5).collect()
    with pytest.raises(api.EmbeddingModelMismatch):
        api.search(report, q, "other", 5, index=folder)


def test_no_vectors(spark, tmp_path):
    none = spark.createDataFrame([(1, None)], "report_id long, embedding array<float>")
    vectors.build(none, str(tmp_path / "n"))
    assert vectors.search(spark, str(tmp_path / "n"), [1.0], 3)[0].count() == 0
