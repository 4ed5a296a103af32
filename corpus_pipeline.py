"""A corpus pipeline of five stages, each one an operator of threatlake.llm.

A stage is (spark, docs, sf_dir) -> DataFrame. run() writes each stage's rows as
Parquet in the shared folder and reads them as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatlake.llm.common import materialize, release
from threatlake.llm.line_dedup import drop_common_lines
from threatlake.llm.packing import pack
from threatlake.llm.quality import judge, train
from threatlake.llm.simhash import similar_documents
from threatlake.llm.substring_dedup import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of documents; n_chars follows the text."""
    return df.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts have fewer than ten words and go; repeated rows and null
    ids are judged like others; no documents, no rows. Other columns than those of documents aren't returned.
    """
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs.select(*COLUMNS), model).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents or more share.

    Every document stays, if without text; null text comes back empty; repeated rows
    count as documents of their own; no documents, no rows.
    """
    return _documents(drop_common_lines(docs.select(*COLUMNS), min_docs=10))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near copies.

    Texts without words, null included, are copies of each other. Rows that repeat
    a kept doc_id all stay; rows of null doc_id stay; no documents, no rows.
    """
    found = similar_documents(docs, shingle_words=5, similarity=0.8)
    gone = found.where("doc_id > component_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words that an earlier document has.

    Null text comes back empty; rows of null doc_id neither lose words nor cost others any; rows
    that repeat a doc_id are judged alike; no documents, no rows.
    """
    return _documents(remove_repeats(docs.select(*COLUMNS), window=13))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 2048 tokens.

    Null text is one piece, the end id; null and repeated ids are documents like others; no documents, no rows.
    """
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=1, window=2048)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("simhash", simhash_dedup), ("substring_dedup", substring_dedup), ("packing", packing)]

#: SQL can't express the classifier's verdict or the packing plan; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
