"""The pipeline, stage by stage, and the queries with SQL."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from threatlake.llm.queries import ORACLES, QUERIES

from . import brute

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    last = None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        if name == "packing":
            assert out.agg({"length": "sum"}).first()[0] > 0
            assert out.select("doc_id").distinct().count() == docs.count()
            break
        assert out.columns == list(corpus_pipeline.COLUMNS)
        before, rows = {r.doc_id: r.text for r in docs.collect()}, out.collect()
        if name == "quality":
            assert all(not brute.quality(r.text)[-1] for r in rows)
        elif name == "line_dedup":
            assert {(r.doc_id, r.text) for r in rows} == {(i, t) for i, _, _, t in brute.lines(list(before.items()), 10)}
        elif name == "simhash":
            kept = {i for i, c in brute.similar(list(before.items())) if i == c}
            assert {r.doc_id for r in rows} == kept
        elif name == "substring_dedup":
            want = {i: s for i, _, _, s in brute.substring(list(before.items()), 13)}
            assert {r.doc_id: brute.sha(" ".join(brute.WORD.findall(r.text))) for r in rows} == want
        assert all(r.n_chars == len(r.text or "") for r in rows if name != "quality")
        docs = spark.createDataFrame(rows, out.schema)
        last = len(rows)
    assert last > 0


def test_odd_documents(spark, odd):
    rows = [(i, t, None, None, None) for i, t in odd] + [(900, "own text of this one document", "en", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    ids = {i for i, _ in odd} | {900}
    kept = {
        "quality": lambda i, t: not brute.quality(t)[-1],  # the model keeps all of these that pass the base rules
        "line_dedup": lambda i, t: True, "substring_dedup": lambda i, t: True,
    }
    wordless = sorted(i for i, t in odd if i is not None and not brute.WORD.search(t or ""))
    copies = {i for i, c in brute.similar([(i, t) for i, t in odd if i is not None]) if i != c}
    for name, stage in corpus_pipeline.STAGES:
        got = [r.doc_id for r in stage(spark, docs, DATA).select("doc_id").collect()]
        if name == "simhash":
            assert {*got} == ids - copies and wordless[0] in got and not {*wordless[1:]} & {*got}
        elif name == "packing":  # a long document has several pieces
            assert {*got} == ids
        else:
            assert sorted(got, key=str) == sorted((i for i, t, *_ in rows if kept[name](i, t)), key=str)
        assert stage(spark, docs.limit(0), DATA).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = QUERIES[name](spark, DATA)
    relation = con.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    got = sorted(tuple(r) for r in df.select(*columns).collect())
    assert got == sorted(relation.select(*columns).fetchall())
