"""Which texts of a corpus hold which quotes: anchors, a bounded filter of their keys, then the verdict.

Every quote has one anchor that any text with the quote holds as a whole: six
consecutive inner words, those with most characters as the rarest; of short quotes one inner
word; of quotes of one or two words, which may lie inside longer words, the first characters.
A text's keys are compared with a bit array of all anchors' keys inside the task, so
rows are made for texts with a hit only and follow the hits, not the words.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.udfs import canonical

RUN = 6
#: Bits of the array of anchors' keys, at most; more anchors let more texts pass to the verdict, none is lost.
FILTER_BITS = 1 << 23
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(RUN)], np.uint64)
KINDS = ("run", "word", "start")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _crc(parts: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(p.encode()) for p in parts), np.uint64, len(parts))


def text_keys(words: list[str], text: str, kind: str) -> np.ndarray:
    """The keys of one kind that a canonical text has, in order."""
    if kind == "start":
        n = X.MIN_QUOTE_CHARS
        return _mixed(_crc([text[k : k + n] for k in range(len(text) - n + 1)]) + np.uint64(3))
    h = _crc(words)
    if kind == "word":
        return _mixed(h + np.uint64(2))
    if len(h) < RUN:
        return np.zeros(0, np.uint64)
    last = len(h) - RUN + 1
    return _mixed(sum((h[k : k + last] * _FACTORS[k] for k in range(RUN)), np.zeros(last, np.uint64)))


def anchor(quote: str) -> tuple[str, int] | None:
    """The kind and key of a canonical quote's anchor; None if the quote is too short to count."""
    if len(quote) < X.MIN_QUOTE_CHARS:
        return None
    words = quote.split(" ")
    if len(words) < 3:
        return "start", int(text_keys([], quote[: X.MIN_QUOTE_CHARS], "start")[0])
    inner = words[1:-1]
    if len(inner) < RUN:
        return "word", int(text_keys([max(inner, key=len)], "", "word")[0])
    sizes = [sum(map(len, inner[k : k + RUN])) for k in range(len(inner) - RUN + 1)]
    at = sizes.index(max(sizes))
    return "run", int(text_keys(inner[at : at + RUN], "", "run")[0])


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def quoted_in(texts: DataFrame, quotes: DataFrame, doc: str = "doc_id", text: str = "text", quote_id: str = "item_id", quote: str = "text") -> DataFrame:
    """(quote id, doc) of each quote that stands in a text by evidence_verdict(), both made canonical.

    Null texts and quotes and quotes that are too short never match; repeated rows give one pair.
    """
    id_type = quotes.schema[quote_id].dataType.simpleString()
    doc_type = texts.schema[doc].dataType.simpleString()

    def anchors(batches):
        for batch in batches:
            ids, said, kinds, keys = [], [], [], []
            for i, q in zip(batch.column("id"), batch.column("q").to_pylist(), strict=True):
                q = canonical(q)
                if q is not None and (got := anchor(q)):
                    ids.append(i.as_py())
                    said.append(q)
                    kinds.append(got[0])
                    keys.append(_signed(got[1]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("id").type), pa.array(said, pa.string()), pa.array(kinds, pa.string()), pa.array(keys, pa.int64())], names=["id", "q", "kind", "key"])

    asked = quotes.select(F.col(quote_id).alias("id"), F.col(quote).alias("q")).mapInArrow(anchors, f"id {id_type}, q string, kind string, key long")
    counted = {r.kind: r.n for r in asked.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    bits = max(1 << 12, min(FILTER_BITS, 1 << (16 * sum(counted.values())).bit_length()))
    slot = F.col("key").bitwiseAND(bits - 1)
    table = np.zeros(bits >> 6, np.uint64)
    places = asked.select(F.shiftright(slot, 6).alias("word"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    for r in places.toLocalIterator():
        table[r.word] = r.mask & ((1 << 64) - 1)
    shared = texts.sparkSession.sparkContext.broadcast(table)
    kinds = [k for k in KINDS if k in counted]

    def look(batches):
        held = shared.value
        for batch in batches:
            docs, hays, found = [], [], []
            for d, t in zip(batch.column("doc"), batch.column("text").to_pylist(), strict=True):
                t = canonical(t)
                words = t.split(" ") if t else []
                keys = np.concatenate([np.zeros(0, np.uint64), *(text_keys(words, t, k) for k in kinds)]) if t else np.zeros(0, np.uint64)
                at = keys & np.uint64(bits - 1)
                keys = np.unique(keys[(held[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1])
                if len(keys):
                    docs.append(d.as_py())
                    hays.append(t)
                    found.append(keys.view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(docs, batch.schema.field("doc").type), pa.array(hays, pa.string()), pa.array(found, pa.list_(pa.int64()))], names=["doc", "hay", "keys"])

    hits = texts.select(F.col(doc).alias("doc"), F.col(text).alias("text")).mapInArrow(look, f"doc {doc_type}, hay string, keys array<long>")
    both = hits.select("doc", "hay", F.explode("keys").alias("key")).join(asked.select("id", "q", "key"), "key")
    return both.where(X.evidence_verdict(F.col("hay"), F.col("q")).isNull()).select(F.col("id").alias(quote_id), F.col("doc").alias(doc)).distinct()
