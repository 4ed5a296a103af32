"""Dropping lines that many documents share, through a sharded minimal perfect hash.

1. Each batch of documents counts its own distinct line keys; (hash, count)
   rows are added up by hash, so a line that every document has costs one row a batch.
2. A shard builds a minimal perfect hash over all its distinct line hashes:
   cascaded bit arrays whose ranks index an array of fingerprints and one of
   counts, as narrow as the largest count allows.
3. Documents hash their lines again and probe the arrays; lines whose count
   reaches the threshold go. No line is joined, and one index serves any threshold.

If all shards together are within a checked size they are broadcast. Beyond it
blocks of documents send each distinct hash once to its shard and the shard
returns those that go, so nothing grows on the driver or in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, block_count, blocked, column, give_back, kept_fields, map_columns, materialize, put_back, set_aside
from .kernel import U64, blocks, combine, mix, pack, text_buffer, unpack

WHITE = b" \t\n\x0b\x0c\r"
#: A-Z to a-z; other letters keep their case.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
FINGERPRINT_BYTES = 6
#: Parquet bytes of documents for each shard and each block.
SHARD_INPUT = 8 << 20


class MinimalPerfectHash:
    """Cascaded bit arrays over distinct 128-bit keys (h, g).

    A key that meets no other in a level's bit array sets its bit there; the
    rest go to the next level. A key's index is the rank of its bit, so the
    indexes are exactly 0 .. n - 1.
    """

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.rank = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.rank[1:])

    @staticmethod
    def _slot(h, g, level: int, size: int):
        return (combine(h, g, 100 + level) % U64(size)).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray, g: np.ndarray) -> MinimalPerfectHash:
        sizes, arrays, level = [], [], 0
        while len(h):
            size = max(64, -(-(len(h) * 3 // 2) // 64) * 64)
            slot = cls._slot(h, g, level, size)
            alone = np.bincount(slot, minlength=size) == 1
            arrays.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            rest = ~alone[slot]
            h, g, level = h[rest], g[rest], level + 1
        return cls(sizes, np.concatenate(arrays) if arrays else np.zeros(0, "<u8"))

    def index(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """The index of each key, -1 for those that no level holds; a foreign key may get any."""
        out, todo, base = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
        for level, size in enumerate(self.sizes):
            slot = self._slot(h[todo], g[todo], level, size) + base
            word, bit = slot >> 6, (slot & 63).astype(U64)
            has = (self.words[word] >> bit) & U64(1) == 1
            below = self.words[word[has]] & ((U64(1) << bit[has]) - U64(1))
            out[todo[has]] = self.rank[word[has]] + np.bitwise_count(below)
            todo, base = todo[~has], base + size
        return out


class LineShard:
    """Fingerprint and count arrays under a minimal perfect hash."""

    def __init__(self, sizes: list[int], words: bytes, prints: bytes, counts: bytes):
        self.hash = MinimalPerfectHash(sizes, np.frombuffer(words, "<u8"))
        self.prints = unpack(prints, FINGERPRINT_BYTES)
        self.counts = unpack(counts, len(counts) // max(1, len(self.prints)) or 1).astype(np.int64)

    @staticmethod
    def build(h: np.ndarray, g: np.ndarray, counts: np.ndarray) -> tuple[list[int], bytes, bytes, bytes]:
        mph = MinimalPerfectHash.build(h, g)
        at = mph.index(h, g)
        prints, by = np.zeros(len(h), U64), np.zeros(len(h), U64)
        prints[at], by[at] = mix(g), counts
        width = (int(counts.max()).bit_length() + 7) // 8 if len(h) else 1
        return mph.sizes, mph.words.tobytes(), pack(prints, FINGERPRINT_BYTES), pack(by, width)

    def count(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """How many documents have each key; 0 where the fingerprint differs."""
        if not len(self.prints) or not len(h):
            return np.zeros(len(h), np.int64)
        at = self.hash.index(h, g)
        mask = U64((1 << (8 * FINGERPRINT_BYTES)) - 1)
        same = (at >= 0) & (self.prints[at] == (mix(g) & mask))
        return np.where(same, self.counts[at], 0)


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return (mix(h ^ U64(77)) % U64(shards)).astype(np.int64)


def hash_lines(texts: list[bytes], min_chars: int) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text; then of the lines with a long enough key: document, line number, and two 64-bit hashes."""
    lines = [t.split(b"\n") for t in texts]
    digest, at, doc, line = xxhash.xxh3_128_digest, [], [], []
    for d, own in enumerate(lines):
        for k, x in enumerate(own):
            key = x.strip(WHITE).translate(LOWER)
            if key and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars):
                at.append(digest(key))
                doc.append(d)
                line.append(k)
    both = np.frombuffer(b"".join(at), "<u8").reshape(-1, 2)
    return lines, np.array(doc, np.int64), np.array(line, np.int64), both[:, 0].astype(U64), both[:, 1].astype(U64)


def _distinct(h, g, extra=None):
    """Order that sorts by key (and extra), and where each run of an equal key begins."""
    order = np.lexsort((g, h) if extra is None else (extra, g, h))
    a, b = h[order], g[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


def _texts(col: pa.Array):
    buffer, offsets = text_buffer(col)
    for lo, hi, b, o in blocks(buffer, offsets):
        raw = b.tobytes()
        yield lo, hi, [raw[x:y] for x, y in zip(o[:-1].tolist(), o[1:].tolist(), strict=True)]


def build_index(docs: DataFrame, min_chars: int = 1, text: str = "text", shards: int | None = None) -> DataFrame:
    """The shards: shard int, sizes array<long>, words, prints, counts binary, of every distinct line key and the documents (rows) that have it."""
    shards = shards or block_count(docs, SHARD_INPUT)

    def partial(batches):
        for batch in batches:
            for _, _, texts in _texts(column(batch, "text")):
                _, doc, _, h, g = hash_lines(texts, min_chars)
                order, _ = _distinct(h, g, doc)
                h, g, doc = h[order], g[order], doc[order]
                once = np.ones(len(h), bool)
                once[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
                h, g = h[once], g[once]
                order, begin = _distinct(h, g)
                h, g, n = h[order][begin], g[order][begin], np.diff(np.append(begin, len(h)))
                yield pa.RecordBatch.from_arrays([pa.array(_shard(h, shards).astype(np.int32)), pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(n)], names=["shard", "h", "g", "n"])
            give_back()

    def total(table: pa.Table) -> pa.Table:
        h, g, n = (column(table, c).to_numpy() for c in ("h", "g", "n"))
        sizes, words, prints, by = LineShard.build(h.view(U64), g.view(U64), n)
        return pa.table({"shard": table.column("shard")[:1], "sizes": pa.array([sizes], pa.list_(pa.int64())), "words": pa.array([words]), "prints": pa.array([prints]), "counts": pa.array([by])})

    counted = docs.select(F.col(text).alias("text")).mapInArrow(partial, "shard int, h long, g long, n long").groupBy("shard", "h", "g").agg(F.sum("n").alias("n"))
    return materialize(counted.groupBy("shard").applyInArrow(total, "shard int, sizes array<long>, words binary, prints binary, counts binary"), "line-index")


def _rewrite(texts: list[bytes], dropped_of, min_chars: int):
    """(text, lines, dropped) of each text; dropped_of tells which hashes go."""
    lines, doc, line, h, g = hash_lines(texts, min_chars)
    gone = dropped_of(h, g)
    per: dict[int, set] = {}
    for d, k in zip(doc[gone].tolist(), line[gone].tolist(), strict=True):
        per.setdefault(d, set()).add(k)
    for d, own in enumerate(lines):
        out = per.get(d)
        yield (texts[d] if not out else b"\n".join(x for k, x in enumerate(own) if k not in out)), len(own), len(out or ())


def _outputs(col: pa.Array, dropped_of, min_chars: int) -> list[pa.Array]:
    rows = [row for _, _, texts in _texts(col) for row in _rewrite(texts, dropped_of, min_chars)]
    text, n, gone = zip(*rows, strict=True) if rows else ((), (), ())
    return [pa.array([x.decode("utf-8", "replace") for x in text], pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())]


NEW = "`{text}` string, n_lines long, n_dropped long"


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """docs with the text's common lines dropped, and n_lines, n_dropped (long).

    A line's key is the line without white space at its ends and with A-Z in
    lower case. A key of at least min_chars code points that at least min_docs
    rows have loses all its lines, in every row. Other lines stay as they are,
    joined by newlines. Null or empty text is one empty line, and comes back
    empty. Rows are told apart by place, so null or repeated ids do no harm.
    Columns named n_lines or n_dropped are replaced; others pass through.
    """
    index = build_index(docs, min_chars, text)
    size = index.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("words") + F.length("prints") + F.length("counts")), F.lit(0)).alias("b")).first()
    if size.b <= broadcast_bytes:
        return _probe_broadcast(docs, index, min_docs, min_chars, text)
    return _probe_routed(docs, index, min_docs, min_chars, text)


def _probe_broadcast(docs: DataFrame, index: DataFrame, min_docs: int, min_chars: int, text: str) -> DataFrame:
    shards = block_count(docs, SHARD_INPUT)
    rows = {r.shard: (list(r.sizes), bytes(r.words), bytes(r.prints), bytes(r.counts)) for r in index.where(F.length("prints") > 0).toLocalIterator()}
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def start():
        held = {s: LineShard(*r) for s, r in shared.value.items()}

        def dropped(h, g):
            shard = _shard(h, shards)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            out = np.zeros(len(h), bool)
            for s in np.flatnonzero(np.diff(cut)).tolist():
                own = order[cut[s] : cut[s + 1]]
                if s in held:
                    out[own] = held[s].count(h[own], g[own]) >= min_docs
            return out

        return lambda batch: _outputs(column(batch, text), dropped, min_chars)

    return map_columns(docs, start, NEW.format(text=text))


def _probe_routed(docs: DataFrame, index: DataFrame, min_docs: int, min_chars: int, text: str) -> DataFrame:
    docs, aside = set_aside(docs, "__blk")
    text = {old: new for new, old in aside.items()}.get(text, text)
    shards, count = block_count(docs, SHARD_INPUT), block_count(docs, SHARD_INPUT)
    held = blocked(docs, count, *docs.columns)

    def ask(table: pa.Table) -> pa.Table:
        parts = [hash_lines(texts, min_chars)[3:] for _, _, texts in _texts(column(table, text))]
        h, g = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, begin = _distinct(h, g)
        h, g = h[order][begin], g[order][begin]
        blk = np.full(len(h), table.column("__blk")[0].as_py(), np.int32)
        return pa.table({"shard": pa.array(_shard(h, shards).astype(np.int32)), "blk": pa.array(blk), "h": pa.array(h.view(np.int64)), "g": pa.array(g.view(np.int64))})

    def answer(asked: pa.Table, own: pa.Table) -> pa.Table:
        blk, h, g = (column(asked, c).to_numpy() for c in ("blk", "h", "g"))
        often = np.zeros(len(h), bool)
        if own.num_rows:
            shard = LineShard(*(own.column(c)[0].as_py() for c in ("sizes", "words", "prints", "counts")))
            often = shard.count(h.view(U64), g.view(U64)) >= min_docs
        return pa.table({"__blk": pa.array(blk[often].astype(np.int32)), "h": pa.array(h[often]), "g": pa.array(g[often])})

    made = _schema(text)
    fields = kept_fields(docs.schema, made)
    names, new_names = [f.name for f in fields], made.names

    def finish(own: pa.Table, told: pa.Table) -> pa.Table:
        h, g = (column(told, c).to_numpy().view(U64) for c in ("h", "g"))
        gone = {*zip(h.tolist(), g.tolist(), strict=True)}
        new = _outputs(column(own, text), lambda a, b: np.fromiter((k in gone for k in zip(a.tolist(), b.tolist(), strict=True)), bool, len(a)), min_chars)
        return pa.table([column(own, n) for n in names] + new, names=names + new_names)

    asked = held.groupBy("__blk").applyInArrow(ask, "shard int, blk int, h long, g long")
    told = asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(answer, "__blk int, h long, g long")
    return put_back(held.groupBy("__blk").cogroup(told.groupBy("__blk")).applyInArrow(finish, T.StructType(fields + list(made.fields))), aside)


def _schema(text: str):
    return T._parse_datatype_string(NEW.format(text=text))
