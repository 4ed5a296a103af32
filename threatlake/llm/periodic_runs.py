"""Periodic runs of words, found by comparing a document with itself at every lag.

A run of period q is a stretch of words in which words q apart are identical,
that no neighbouring word extends, of at least max(min_length, 2 * q) words; q is
its smallest period. At lag q the word-id array is compared with itself shifted
by q, and runs are the long stretches of equal places.

1. At every lag up to n / 2 all documents of a block are compared at once. A
   stretch that is long enough holds four neighbouring places of every
   quarter-stretch grid, so the shift is compared on that grid first, and only
   a document with four equal neighbours there is compared place by place.
2. A stretch of a multiple of a run's period is the same stretch of words (two
   periods of a stretch that holds both have their greatest common divisor as a
   period), so of equal stretches the one of smallest lag is the run.
3. Blocks of documents need no shuffle. Long documents are taken apart: one row
   for each range of lags goes to a task of its own, and the stretches that the
   ranges find meet again by document, smallest lag first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, kept_fields, map_columns, materialize, unused
from .kernel import U64, Words, blocks, combine, find_words, mix, range_hash, text_buffer

#: Bytes of a text beyond which its lags are dealt to several tasks; lags of a range at least, ranges of a text at most.
LONG_BYTES = 48 << 10
LAGS, RANGES = 4096, 8
#: Long stretches that a document keeps to know its multiples by.
KNOWN = 8
NEW = "n_words long, runs array<struct<start:long,length:long,period:long>>, `{text}` string"


def word_ids(buffer: np.ndarray, words: Words, salt: bool = True) -> np.ndarray:
    """A 64-bit id of each word; with salt, words of different documents differ."""
    ids = range_hash(buffer, words.start, words.end)
    return combine(ids, mix(words.doc().astype(U64) + U64(1)), 7) if salt and len(ids) else ids


def lag_scan(ids: np.ndarray, first: np.ndarray, min_length: int = 12, lags: tuple[int, int] | None = None) -> list[tuple[int, int, int, int]]:
    """(document, start, end, lag) of each stretch, that of the smallest lag where several lags have it.

    Documents lie end to end, the longest first, first[d] .. first[d + 1] is one.
    lags: from and up to (not with) which lag; all by default.
    """
    sizes = np.diff(first)
    found: dict[tuple[int, int, int], int] = {}
    known: dict[int, list[tuple[int, int, int]]] = {}
    live = len(sizes)
    low, high = lags or (1, int(sizes[0]) // 2 + 1 if live else 1)
    for q in range(low, high):
        while live and sizes[live - 1] < max(min_length, 2 * q):
            live -= 1
        if not live:
            break
        shortest, end = max(q, min_length - q), int(first[live])
        step = max(1, shortest // 4)
        need = min(4, shortest // step)
        hits = np.flatnonzero(ids[: end - q : step] == ids[q:end:step])
        if len(hits) < need:
            continue
        at = hits[: len(hits) - need + 1]
        at = at[hits[need - 1 :] - at == need - 1]
        if not len(at):
            continue
        doc = np.searchsorted(first, at * step, "right") - 1
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(doc) > 0)) + 1
        done = -1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(at)], strict=True):
            d = int(doc[lo])
            if d == done:
                continue
            begin = int(first[d])
            a, b = int(at[lo]) * step - begin, (int(at[hi - 1]) + need - 1) * step + q - begin
            if any(s <= a and b < e and (q % k == 0 or k <= (need - 1) * step + 1) for s, e, k in known.get(d, ())):
                continue  # a longer name for a run that is found
            done = d
            same = np.zeros(int(sizes[d]) - q + 2, np.int8)
            same[1:-1] = ids[begin : int(first[d + 1]) - q] == ids[begin + q : int(first[d + 1])]
            edge = np.flatnonzero(np.diff(same))
            for s, e in edge.reshape(-1, 2).tolist():
                if e - s >= shortest and (d, s, e + q) not in found:
                    found[d, s, e + q] = q
                    known[d] = sorted([*known.get(d, ()), (s, e + q, q)], key=lambda x: x[0] - x[1])[:KNOWN]
    return [(*key, q) for key, q in found.items()]


def block_runs(buffer: np.ndarray, offsets: np.ndarray, min_length: int) -> tuple[Words, list[list[tuple[int, int, int]]]]:
    """The words of a block, and each document's runs (start, length, period) by start, then period."""
    words = find_words(buffer, offsets)
    ids, n = word_ids(buffer, words), np.diff(words.first)
    order = np.argsort(-n, kind="stable")
    first = np.concatenate([[0], np.cumsum(n[order])])
    moved = ids[np.repeat(words.first[:-1][order] - first[:-1], n[order]) + np.arange(len(ids))]
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(n))]
    for d, s, e, q in lag_scan(moved, first, min_length):
        runs[order[d]].append((s, e - s, q))
    for own in runs:
        own.sort(key=lambda r: (r[0], r[2]))
    return words, runs


def collapsed(raw: bytes, start: list[int], end: list[int], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by one space, without those that a run contains after its first period."""
    gone = np.zeros(len(start) + 1, np.int64)
    for s, length, q in runs:
        gone[s + q] += 1
        gone[s + length] -= 1
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
    return b" ".join([raw[start[k] : end[k]] for k in kept]).decode()


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _columns(n: list[int], runs: list[list[tuple[int, int, int]]], texts: list[str]) -> list[pa.Array]:
    flat = np.array([r for own in runs for r in own], np.int64).reshape(-1, 3)
    ends = np.cumsum([0, *map(len, runs)], dtype=np.int32)
    items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN))
    return [pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), items), pa.array(texts, pa.string())]


def _block_columns(col: pa.Array, runs_of) -> list[pa.Array]:
    """runs_of(buffer, offsets, first row) gives words and runs of a block."""
    buffer, offsets = text_buffer(col)
    n, all_runs, texts = [], [], []
    for lo, _, b, o in blocks(buffer, offsets):
        words, runs = runs_of(b, o, lo)
        raw, first = b.tobytes(), words.first.tolist()
        for d, own in enumerate(runs):
            x, y = first[d], first[d + 1]
            texts.append(collapsed(raw, words.start[x:y].tolist(), words.end[x:y].tolist(), own))
            n.append(y - x)
        all_runs += runs
    return _columns(n, all_runs, texts)


def collapse_runs(docs: DataFrame, min_length: int = 12, text: str = "text", long_bytes: int = LONG_BYTES, lags: int = LAGS) -> DataFrame:
    """docs with n_words, runs (start, length, period of each, by start, then period) and the text collapsed.

    Words are maximal runs of characters other than space and 0x09-0x0D, told
    apart by a 64-bit hash and numbered from 0. Of each run the first period
    stays; other words stay, all joined by one space. Null, empty and blank
    texts have no words and come back empty. Rows are told apart by place, so
    null and repeated ids do no harm. Columns named n_words or runs are replaced;
    others pass through. No documents, no rows. A long text is one row of
    the tasks that its ranges of lags go to, so it must fit a task.
    """
    size = F.octet_length(F.coalesce(text, F.lit("")))
    short = map_columns(docs.where(size <= long_bytes), lambda: lambda batch: _block_columns(column(batch, text), lambda b, o, _: block_runs(b, o, min_length)), NEW.format(text=text))
    return short.unionByName(_long_runs(docs.where(size > long_bytes), min_length, text, lags))


def _long_runs(docs: DataFrame, min_length: int, text: str, lags: int) -> DataFrame:
    row, body, told = unused(docs, "row"), unused(docs, "body"), unused(docs, "told")
    held = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "long-texts")

    def deal(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                buffer, offsets = text_buffer(column(batch, text).slice(k, 1))
                words = find_words(buffer, offsets)
                ids = word_ids(buffer, words, salt=False)
                last = len(ids) // 2 + 1
                width = max(lags, -(-last // RANGES))
                for low in range(1, last, width):
                    yield pa.RecordBatch.from_arrays([column(batch, row).slice(k, 1), pa.array([low], pa.int64()), pa.array([min(last, low + width)], pa.int64()), pa.array([ids.tobytes()], pa.binary())], names=["row", "low", "high", "ids"])

    def scan(batches):
        for batch in batches:
            for own, low, high, ids in zip(*(column(batch, c) for c in ("row", "low", "high", "ids")), strict=True):
                words = np.frombuffer(ids.as_buffer(), U64)
                got = np.array(lag_scan(words, np.array([0, len(words)]), min_length, (low.as_py(), high.as_py())), np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), own.as_py())), *(pa.array(got[:, c]) for c in (1, 2, 3))], names=["row", "start", "end", "period"])

    ranges = held.select(row, text).mapInArrow(deal, "row long, low long, high long, ids binary").repartition("row", "low")
    runs = ranges.mapInArrow(scan, "row long, start long, end long, period long").groupBy("row", "start", "end").agg(F.min("period").alias("period"))
    by_row = runs.groupBy(F.col("row").alias(row)).agg(F.sort_array(F.collect_list(F.struct("start", "period", (F.col("end") - F.col("start")).alias("length")))).alias("runs"))

    made = T._parse_datatype_string(NEW.format(text=text))
    fields = kept_fields(docs.schema, made)
    got = held.select(*(f"`{f.name}`" for f in fields), F.col(text).alias(body), row).join(by_row.withColumnRenamed("runs", told), row, "left")

    def finish():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            found = column(batch, told).to_pylist()
            return _block_columns(column(batch, body), lambda b, o, lo: (find_words(b, o), [[(r["start"], r["length"], r["period"]) for r in own or ()] for own in found[lo : lo + len(o) - 1]]))

        return step

    return map_columns(got, finish, made).drop(row, body, told)


def planted(doc_id, text, white: str = "[^\\x20\\x09-\\x0D]+"):
    """text (a Column), in a tenth of the documents with words that repeat periodically from some word on.

    With h = crc32 of the decimal doc_id and g = floor(h / 10), where h % 10 = 0
    word i >= a = g % n becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).
    Null ids and texts without words are left alone.
    """
    h = F.crc32(F.col(doc_id).cast("string"))
    g = F.floor(h / 10).cast("long")

    def rewrite(words):
        n = F.size(words).cast("long")
        a = g % F.greatest(n, F.lit(1))
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        bound = F.transform(F.array(F.struct(words.alias("w"), a.alias("a"), p.alias("p"))), lambda s: F.transform(s["w"], lambda x, i: F.when(i < s["a"], x).otherwise(F.get(s["w"], (s["a"] + (i - s["a"]) % s["p"]).cast("int")))))
        return F.array_join(F.flatten(bound), " ")

    words = F.regexp_extract_all(F.col(text), F.lit(white), F.lit(0))
    changed = F.get(F.transform(F.array(words), rewrite), 0)
    return F.when(h % 10 == 0, changed).otherwise(F.col(text))
