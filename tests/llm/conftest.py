from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """make(rows, extra): documents of (doc_id, text) rows, with columns that clash with the operators' own names."""

    def make(rows, clash: bool = False):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        if clash:
            for name in ("n_words", "n_lines", "kept", "__x", "shard", "h", "fp", "key", "ids", "a", "blk", "root", "__blk", "__id"):
                df = df.withColumn(name, F.lit("own"))
        return df

    return make


#: Nulls, empty and blank texts, ties, repeated rows, long words and other letters.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "two words"), (None, None), (5, "É É é\n\nÉ É é\r\n x"),
    (6, "w" * 5000), (7, "日本語 テスト a"), (8, "a b c d e f g h i j k l m n o p"), (9, "a b c d e f g h i j k l m n o p"), (9, "a b c d e f g h i j k l m n o p"),
    (-3, "a  b\tc d e f g h i j k l m"), (2**62, "x y"), (10, "\n".join(["Line one", " line ONE ", "other"] * 4)), (11, "\x00 \x1c \x85"),
]


@pytest.fixture(scope="session")
def odd():
    return ODD
