"""Packing token sequences into fixed windows by best-fit decreasing.

Documents longer than a window are first cut into full windows, which are
sequences of their own. The rest pieces are packed by best-fit decreasing, which
looks at lengths only: pieces are counted by length (a histogram of at most
window - 1 rows), the plan is made from the counts with a segment tree over
remaining capacity, and pieces find their place by their number within their
length. The plan's runs, bounded by the window and not by the data, are the only
thing that is broadcast.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import text_blocks
from .common import block_count, column, give_back, materialize


class CapacityTree:
    """A segment tree over remaining capacity: open[c] windows have c tokens left."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = np.zeros(2 * self.size, np.int64).tolist()

    def add(self, capacity: int, count: int) -> None:
        at = self.size + capacity
        while at:
            self.open[at] += count
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least `least` that an open window has."""
        at = self.size + least
        if self.open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


@dataclass
class Run:
    """Pieces first .. first + count - 1 of a length go `each` a window, from window `window` on, at `offset`."""

    length: int
    first: int
    count: int
    each: int
    window: int
    offset: int


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Best-fit decreasing over {length: pieces}: the runs, and the windows used.

    Windows of equal remaining capacity are alike, so they are kept as runs of
    consecutive numbers and a step places a whole run of equal pieces. The plan
    is that of placing the pieces one by one.
    """
    tree, opened, out, windows = CapacityTree(capacity), {}, [], 0
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"no piece of {length} tokens fits")
        left, first = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                each = capacity // length
                start, have, room = windows, -(-left // each), capacity
                windows += have
            else:
                start, have = opened[room].pop()
                tree.add(room, -have)
                each = room // length
            full = min(have, left // each)
            rest = left - full * each if full < have else 0
            rest = min(rest, each - 1) if full < have else 0
            for count, per, at in ((full, each, start), (1 if rest else 0, rest, start + full)):
                if count:
                    out.append(Run(length, first, count * per, per, at, capacity - room))
                    first += count * per
                    left -= count * per
                    remains = room - per * length
                    if remains:
                        opened.setdefault(remains, []).append((at, count))
                        tree.add(remains, count)
            used = full + (1 if rest else 0)
            if used < have:
                opened.setdefault(room, []).append((start + used, have - used))
                tree.add(room, have - used)
    return out, windows


def byte_level_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Token bytes to id of a byte-level BPE tokenizer file, and its added tokens' text to id.

    A file whose ids byte ranks alone can't give is refused: with a normaliser, a
    prefix space, added tokens that take neighbouring space, or merges in another order than their ids.
    """
    import json

    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    model, split = data["model"], data["pre_tokenizer"] or {}
    if model["type"] != "BPE" or split.get("type") != "ByteLevel":
        raise ValueError("not a byte-level BPE tokenizer")
    if data["normalizer"] or split["add_prefix_space"] or not split.get("use_regex", True) or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")):
        raise ValueError("the tokenizer changes texts before its merges, or doesn't merge by rank")
    if any(t[k] for t in data["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("an added token takes its neighbourhood into account")
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"]["".join(m)] for m in merges]
    if any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
        raise ValueError("merges aren't in the order of their ids")
    # Byte-level files write printable bytes as themselves and the others from U+0100 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    added = {t["content"]: t["id"] for t in data["added_tokens"]}
    return {bytes(of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}, added


def _pieces(ids: np.ndarray, window: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, CRC-32 of the little-endian unsigned ids) of full windows and the rest."""
    for start in range(0, len(ids), window):
        own = ids[start : start + window]
        yield start, len(own), zlib.crc32(own.astype("<u4").tobytes())


def tokenize(docs: DataFrame, tokenizer: str, pattern: str, end_id: int, window: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece: doc_id, doc_tokens, start, length, ids_crc32.

    Ids are those that the tokenizer file's own library gives without adding
    special tokens, with end_id after each document: an added token's string inside a
    text has that token's id. The file's merges run in tiktoken, which gives the
    same ids in a quarter of the time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(byte_level_ranks(tokenizer))

    def run(batches):
        import tiktoken

        coder = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=shared.value[0], special_tokens=shared.value[1])
        for batch in batches:
            rows, at = [], 0
            names = column(batch, "doc_id").to_pylist()
            for texts in text_blocks(column(batch, "text")):
                for t in texts:
                    ids = np.append(coder.encode_to_numpy(t, allowed_special="all"), np.uint32(end_id))
                    rows += [(names[at], len(ids), *piece) for piece in _pieces(ids, window)]
                    at += 1
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "doc_tokens", "start", "length", "ids_crc32"])
            give_back()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, doc_tokens long, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, pattern: str, end_id: int = 1, window: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece with its sequence_id and offset there.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and sequence_tokens, the length that the sequence is stored with: its own if
    that is a power of two, the window otherwise. Offsets of a sequence
    are gapless from 0. Null text is empty: one piece, the end id. Null and
    repeated doc_ids are documents like others; no documents, no rows.
    """
    slices = block_count(docs, 1 << 20, least=32, most=1 << 16)
    pieces = tokenize(docs, tokenizer, pattern, end_id, window, doc_id, text)
    # A slice spreads each length over many groups, so that a common length has no hot one.
    order = ("doc_id", "start", "ids_crc32", "doc_tokens")
    pieces = materialize(pieces.withColumn("slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int")), "pieces")

    counts = pieces.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = materialize(counts.withColumn("before", before), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = histogram.pop(window, 0)
    runs, _ = plan(histogram, window)

    place = docs.sparkSession.sparkContext.broadcast(_lookup(runs))
    numbered = pieces.join(counts.select("length", "slice", "before"), ["length", "slice"])
    nth = F.row_number().over(Window.partitionBy("length", "slice").orderBy(*order)) - 1 + F.col("before")

    def run(batches):
        starts, base = place.value
        for batch in batches:
            length, nth = (column(batch, c).to_numpy().astype(np.int64) for c in ("length", "nth"))
            whole = length == window
            row = np.searchsorted(starts[:, 0] * (1 << 44) + starts[:, 1], length * (1 << 44) + nth, "right") - 1 if len(starts) else np.zeros(len(length), np.int64)
            safe = np.where(whole, 0, row)
            own = base[safe] if len(base) else np.zeros((len(length), 4), np.int64)
            inside = nth - own[:, 3]
            each = np.maximum(own[:, 0], 1)
            sequence = np.where(whole, nth, full + own[:, 1] + inside // each)
            offset = np.where(whole, 0, own[:, 2] + inside % each * length)
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), pa.array(sequence), pa.array(offset)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    placed = numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", nth.alias("nth")).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    used = F.sum("length").over(Window.partitionBy("sequence_id"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return placed.withColumn("used", used).withColumn("sequence_tokens", F.when(power, F.col("used")).otherwise(F.lit(window).cast("long"))).drop("used")


def _lookup(runs: list[Run]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (length, first), and each run's (each, window, offset, first)."""
    runs = sorted(runs, key=lambda r: (r.length, r.first))
    starts = np.array([(r.length, r.first) for r in runs], np.int64).reshape(-1, 2)
    return starts, np.array([(r.each, r.window, r.offset, r.first) for r in runs], np.int64).reshape(-1, 4)
