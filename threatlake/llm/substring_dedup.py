"""Removing passages that an earlier document has, by level-wise doubling.

Windows of a base length (7 words for a window of 13) are compared first. Only
those that another document repeats are extended to twice that length (at most
the window asked for), and so on until the window is reached or no candidate
survives: every level below the window is asked in turn (7, 13 and 25 words for
a window of 50), and only by the windows that passed the levels before. There a
document compares one window of every run that a full window can hold: the one
of smallest hash (a minimiser), which any two copies of a full window share, so
no repeat is lost and, at 7 of 13, a quarter of the windows stand for all.

Documents are dealt into blocks once and that exchange is reused by every level.
A block sends each distinct hash once to the shard of the hash, packed in arrays,
however many of its documents have it; so a passage that a third of all documents
share costs one entry a block. Shards answer with the hashes that survive. Blocks
and shards follow the input, each of about the same size. Beyond DIRECT_BLOCKS,
where a packet for each block and shard would hold few hashes, the exchange goes
by way of nodes: a node merges the packets of about sqrt(blocks) blocks for
about sqrt(shards) shards, asks each shard once and deals out its answer.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import block_count, blocked, column, give_back, kept_fields, put_back, set_aside
from .kernel import U64, Words, blocks, find_words, member, pack, range_hash, text_buffer, unpack, widen, window_hash, window_valid

#: Parquet bytes of documents for each block and each shard.
BLOCK_INPUT = 4 << 20
#: Block numbers end here (256 TB of Parquet).
MOST_BLOCKS = 1 << 26
#: Blocks up to which each one asks every shard by itself.
DIRECT_BLOCKS = 4096
#: Bytes of a hash that travel besides its shard: at the base level, where a
#: false repeat only costs a candidate, and at the last, which decides.
BASE_BYTES = 5
NO_ID = np.iinfo(np.int64).min


def levels(window: int, base: int = 8) -> list[int]:
    """The doubling levels: at most `base` words at first, `window` at last."""
    out = [window]
    while out[-1] > base:
        out.append((out[-1] + 1) // 2)
    return out[::-1]


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> U64(44)) % U64(shards)).astype(np.int64)


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    """The part of a shard that a travelling hash belongs to."""
    return ((key >> U64(16)) % U64(parts)).astype(np.int64)


def _sliding(x: np.ndarray, size: int, op) -> np.ndarray:
    """op over each run of `size` items."""
    have = 1
    while have < size:
        step = min(have, size - have)
        x = op(x[: len(x) - step], x[step:]) if len(x) > step else x[:0]
        have += step
    return x


class Windows:
    """The words and the window hashes of one block of texts."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray, window: int, seed: int = 1):
        self.words: Words = find_words(buffer, offsets)
        w, self.window, self.steps = self.words, window, levels(window)
        self.base = self.steps[0]
        self.doc = w.doc()
        word = range_hash(buffer, w.start, w.end)
        self.hash_base = window_hash(word, self.base, seed)
        self.n = max(0, len(word) - window + 1)
        self.valid = window_valid(w.first, window, self.n)
        self.word = word

    def anchor(self, level: int) -> np.ndarray:
        """The anchor of each full window: the smallest hash of the level's windows in it."""
        h = self.hash_base
        for a, b in zip(self.steps[:level], self.steps[1:], strict=False):
            h = widen(h, a, b)
        return _sliding(h, self.window - self.steps[level] + 1, np.minimum)[: self.n]

    def alive(self, told: list[np.ndarray], shards: int) -> np.ndarray:
        """The full windows whose anchors of all levels answered so far survived."""
        at = np.flatnonzero(self.valid)
        for level, keys in enumerate(told):
            if len(at):
                at = at[member(_base_key(self.anchor(level)[at], shards), keys)]
        return at

    def extended(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of every full window, by doubling."""
        out = []
        for seed in (1, 2):
            h = self.hash_base if seed == 1 else window_hash(self.word, self.base, seed)
            for a, b in zip(self.steps, self.steps[1:], strict=False):
                h = widen(h, a, b, seed)
            out.append(h[: self.n])
        return out[0], out[1]


def _parts(table: pa.Table, text: str, window: int):
    buffer, offsets = text_buffer(column(table, text))
    for lo, hi, b, o in blocks(buffer, offsets):
        yield lo, hi, b, o, Windows(b, o, window)
    give_back()


def _ids(table: pa.Table) -> np.ndarray:
    return column(table, "__id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, most important first, and where each run of equal first keys (all but the last) begins."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys[:-1]])
    return order, np.flatnonzero(new)


def _columns(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, t) for n, t, c in zip(names, types, cols, strict=True)})


def _split(shard: np.ndarray, shards: int):
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cut)).tolist():
        yield s, order[cut[s] : cut[s + 1]]


def _base_asks(text: str, window: int, shards: int, level: int):
    """Of a block: the distinct anchors at a level of the windows alive, those of one document and those of several apart."""

    def ask(table: pa.Table, told: pa.Table | None) -> pa.Table:
        names, types = ["shard", "blk", "one", "many"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        if not table.num_rows or (level and not told.num_rows):
            return _columns(names, types, [])
        ids, hs, ds = _ids(table), [], []
        before = _told(told, level) if level else []
        for lo, _, _, _, w in _parts(table, text, window):
            at = w.alive(before, shards)
            h, d = w.anchor(level)[at], w.doc[at]
            keep = np.ones(len(h), bool)
            keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])  # neighbours share an anchor
            hs.append(h[keep])
            ds.append(ids[d[keep] + lo])
        h, d = np.concatenate(hs), np.concatenate(ds)
        h, d = h[d != NO_ID], d[d != NO_ID]
        order, begin = _runs(h, d)
        h, d = h[order], d[order]
        last = np.append(begin[1:], len(h)) - 1
        several = d[begin] != d[last] if len(begin) else np.zeros(0, bool)
        h = h[begin]
        rows = [(s, int(table.column("__blk")[0].as_py()), pack(h[own][~several[own]], BASE_BYTES), pack(h[own][several[own]], BASE_BYTES)) for s, own in _split(_shard(h, shards), shards)]
        return _columns(names, types, rows)

    return ask if level else lambda table: ask(table, None)


def _repeated(rows: list[dict]) -> tuple[list[np.ndarray], np.ndarray]:
    """Each packet's hashes of one document, and the sorted hashes that several documents have."""
    one = [unpack(r["one"], BASE_BYTES) for r in rows]
    many = np.unique(np.concatenate([unpack(r["many"], BASE_BYTES) for r in rows]))
    seen, count = np.unique(np.concatenate(one), return_counts=True)
    return one, np.union1d(seen[count > 1], many)


def _base_answers(sender: str, to: str):
    """Of a shard: to each sender, those of its hashes that several documents have."""

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        one, again = _repeated(rows)
        out = []
        for r, own in zip(rows, one, strict=True):
            hit = np.concatenate([own[member(own, again)], unpack(r["many"], BASE_BYTES)])
            if len(hit):
                out.append((r[sender], r["shard"], pack(hit, BASE_BYTES)))
        return _columns([to, "shard", "keys"], [pa.int32(), pa.int32(), pa.binary()], out)

    return answer


def _base_up(parts: int):
    """Of a node: its blocks' distinct hashes, for each part of the shard."""

    def up(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        one, again = _repeated(rows)
        single = np.setdiff1d(np.concatenate(one), again)
        h, several = np.concatenate([single, again]), np.repeat([False, True], [len(single), len(again)])
        out = [(rows[0]["shard"], p, rows[0]["node"], pack(h[own][~several[own]], BASE_BYTES), pack(h[own][several[own]], BASE_BYTES)) for p, own in _split(_part(h, parts), parts)]
        return _columns(["shard", "part", "node", "one", "many"], [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()], out)

    return up


def _base_down(table: pa.Table, got: pa.Table) -> pa.Table:
    """Of a node: to each of its blocks, those of its hashes that survive."""
    alive = np.sort(np.concatenate([np.zeros(0, U64), *(unpack(k, BASE_BYTES) for k in got.column("keys").to_pylist())]))
    out = []
    for r in table.to_pylist():
        own = np.concatenate([unpack(r["one"], BASE_BYTES), unpack(r["many"], BASE_BYTES)])
        hit = own[member(own, alive)]
        if len(hit):
            out.append((r["blk"], r["shard"], pack(hit, BASE_BYTES)))
    return _columns(["__blk", "shard", "keys"], [pa.int32(), pa.int32(), pa.binary()], out)


def _told(told: pa.Table, levels_asked: int) -> list[np.ndarray]:
    """For each level asked, the sorted (shard, low bytes) that shards answered."""
    got = [[np.zeros(0, U64)] for _ in range(levels_asked)]
    for level, s, k in zip(*(told.column(c).to_pylist() for c in ("level", "shard", "keys")), strict=True):
        got[level].append(unpack(k, BASE_BYTES) | U64(s << (8 * BASE_BYTES)))
    return [np.sort(np.concatenate(x)) for x in got]


def _base_key(h: np.ndarray, shards: int) -> np.ndarray:
    return (h & U64((1 << (8 * BASE_BYTES)) - 1)) | (_shard(h, shards).astype(U64) << U64(8 * BASE_BYTES))


def _candidates(table: pa.Table, text: str, window: int, shards: int, told: list[np.ndarray]):
    """(part, window number, row, hash, second hash) of the windows whose anchors survived every level."""
    for lo, hi, b, o, w in _parts(table, text, window):
        at = w.alive(told, shards)
        if len(at):
            h, g = w.extended()
            yield (lo, hi, b, o, w), at, w.doc[at] + lo, h[at], g[at]
        else:
            yield (lo, hi, b, o, w), at, at, np.zeros(0, U64), np.zeros(0, U64)


FULL = "h binary, g binary, ids binary, base long, width int"
_FULL_NAMES, _FULL_TYPES = ["h", "g", "ids", "base", "width"], [pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32()]


def _full_packet(h: np.ndarray, g: np.ndarray, d: np.ndarray) -> tuple:
    base = int(d.min())
    off = (d - base).astype(U64)
    width = max(1, (int(off.max()).bit_length() + 7) // 8)
    return pack(h, 8), pack(g, 2), pack(off, width), base, width


def _full_read(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Hashes, second hashes and ids of packets, and each packet's size."""
    h = np.concatenate([unpack(r["h"], 8) for r in rows])
    g = np.concatenate([unpack(r["g"], 2) for r in rows])
    d = np.concatenate([unpack(r["ids"], r["width"]).astype(np.int64) + r["base"] for r in rows])
    return h, g, d, [len(r["h"]) // 8 for r in rows]


def _full_asks(text: str, window: int, shards: int, asked: int):
    """Of a block: its distinct candidate windows, each with the smallest doc_id that has it here."""

    def ask(table: pa.Table, told: pa.Table) -> pa.Table:
        names, types = ["shard", "blk", *_FULL_NAMES], [pa.int32(), pa.int32(), *_FULL_TYPES]
        if not table.num_rows or not told.num_rows:
            return _columns(names, types, [])
        ids = _ids(table)
        got = [(h, g, ids[row]) for _, at, row, h, g in _candidates(table, text, window, shards, _told(told, asked))]
        h, g, d = (np.concatenate(x) for x in zip(*got, strict=True))
        h, g, d = (x[d != NO_ID] for x in (h, g, d))
        order, begin = _runs(h, g, d)
        h, g, d = (x[order][begin] for x in (h, g, d))
        blk = int(table.column("__blk")[0].as_py())
        return _columns(names, types, [(s, blk, *_full_packet(h[own], g[own], d[own])) for s, own in _split(_shard(g, shards), shards)])

    return ask


def _least(h: np.ndarray, g: np.ndarray, d: np.ndarray) -> np.ndarray:
    """For each window the smallest id that has it."""
    order, begin = _runs(h, g, d)
    least = np.empty(len(h), np.int64)
    if len(h):
        least[order] = np.repeat(d[order][begin], np.diff(np.append(begin, len(h))))
    return least


def _full_answers(sender: str, to: str):
    """Of a shard: to each sender, those of its windows that a smaller doc_id elsewhere has."""

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        h, g, d, sizes = _full_read(rows)
        return _lost_rows(rows, sender, to, h, g, _least(h, g, d) < d, sizes)

    return answer


def _lost_rows(rows: list[dict], sender: str, to: str, h: np.ndarray, g: np.ndarray, lost: np.ndarray, sizes: list[int]) -> pa.Table:
    out, at = [], 0
    for r, n in zip(rows, sizes, strict=True):
        own = lost[at : at + n]
        if own.any():
            out.append((r[sender], r["shard"], pack(h[at : at + n][own], 8), pack(g[at : at + n][own], 2)))
        at += n
    return _columns([to, "shard", "h", "g"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()], out)


def _full_up(parts: int):
    """Of a node: its blocks' distinct windows with the smallest id, for each part of the shard."""

    def up(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        h, g, d, _ = _full_read(rows)
        order, begin = _runs(h, g, d)
        h, g, d = (x[order][begin] for x in (h, g, d))
        out = [(rows[0]["shard"], p, rows[0]["node"], *_full_packet(h[own], g[own], d[own])) for p, own in _split(_part(h, parts), parts)]
        return _columns(["shard", "part", "node", *_FULL_NAMES], [pa.int32(), pa.int32(), pa.int32(), *_FULL_TYPES], out)

    return up


def _full_down(table: pa.Table, got: pa.Table) -> pa.Table:
    """Of a node: to each of its blocks, the windows that a smaller id here or elsewhere has."""
    rows = table.to_pylist()
    if not rows:
        return _lost_rows([], "blk", "__blk", np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, bool), [])
    h, g, d, sizes = _full_read(rows)
    lost = _least(h, g, d) < d
    if got.num_rows:
        lost_h, lost_g = (np.concatenate([unpack(x, width) for x in got.column(c).to_pylist()]) for c, width in (("h", 8), ("g", 2)))
        lost |= _in_pairs(h, g, lost_h, lost_g)
    return _lost_rows(rows, "blk", "__blk", h, g, lost, sizes)


def _exchange(asked: DataFrame, lanes: int, parts: int, packet: str, answers, up, down, answer: str) -> DataFrame:
    """The shards' answers, by block, to what blocks asked; by way of nodes if shards have parts."""
    if parts == 1:
        return asked.groupBy("shard").applyInArrow(answers("blk", "__blk"), f"__blk int, shard int, {answer}")
    nodes = asked.withColumn("node", F.expr(f"int(blk div {lanes})")).groupBy("shard", "node")
    merged = nodes.applyInArrow(up(parts), f"shard int, part int, node int, {packet}")
    told = merged.groupBy("shard", "part").applyInArrow(answers("node", "node"), f"node int, shard int, {answer}")
    return nodes.cogroup(told.groupBy("shard", "node")).applyInArrow(down, f"__blk int, shard int, {answer}")


def _covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge)[:n] > 0


def _cut(text: bytes, end: list[int], gone: np.ndarray) -> bytes:
    """The text without its removed words; white space before a removed word goes with it."""
    out, at = [], 0
    for k in np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2).tolist():
        first, last = k[0], k[1] - 1
        out.append(text[at : end[first - 1] if first else 0])
        at = end[last]
    out.append(text[at:])
    return b"".join(out)


NEW = "`{text}` string, n_words long, n_removed long"


def remove_repeats(docs: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text", layout: str = "cut", blocks_wanted: int | None = None) -> DataFrame:
    """docs without the words that repeat a passage of an earlier document.

    A word goes if a window of `window` consecutive words of one document covers
    it and the same words also start, as a window, in a document of smaller
    doc_id; windows are judged on the input. Adds n_words and n_removed (long).
    With layout "cut", text loses the removed words and the white space before
    them and keeps its form; with "words" it is the kept words joined by one space.

    doc_id is of an integer type; others are refused. Blocks follow the input's
    size unless blocks_wanted names their number; results don't depend on it.

    Null or empty text has no words. Rows of null doc_id have no place in the
    order: they lose nothing and cost others nothing. Rows that repeat a doc_id
    are judged alike and never against each other. Columns named like
    the new ones are replaced, others pass through; an empty table stays empty.
    """
    if layout not in ("cut", "words"):
        raise ValueError("layout is cut or words")
    if window < 2:
        raise ValueError("a window has two words or more")
    docs, aside = set_aside(docs, "__blk", "__id")
    doc_id, text = ({old: new for new, old in aside.items()}.get(c, c) for c in (doc_id, text))
    if not isinstance(docs.select(doc_id).schema[0].dataType, T.IntegralType):
        raise ValueError(f"{doc_id} must be of an integer type")
    count = blocks_wanted or block_count(docs, BLOCK_INPUT, most=MOST_BLOCKS)
    # Shards of a node exchange are (lane, part); below, "shard" is the lane.
    shards = count if count <= DIRECT_BLOCKS else math.isqrt(count - 1) + 1
    parts = -(-count // shards)
    held = blocked(docs, count, doc_id, text).withColumn("__id", F.col(doc_id).cast("long"))
    dealt = held.groupBy("__blk")
    new = T._parse_datatype_string(NEW.format(text=text))
    fields = kept_fields(docs.schema, new)
    names = [f.name for f in fields]

    packet, told, asked_levels = "one binary, many binary", None, len(levels(window)) - 1 or 1
    for level in range(asked_levels):
        ask = _base_asks(text, window, shards, level)
        source = dealt.cogroup(told.groupBy("__blk")) if level else dealt
        asked = source.applyInArrow(ask, f"shard int, blk int, {packet}")
        answered = _exchange(asked, shards, parts, packet, _base_answers, _base_up, _base_down, "keys binary").withColumn("level", F.lit(level))
        told = told.unionByName(answered) if level else answered
    full = dealt.cogroup(told.groupBy("__blk")).applyInArrow(_full_asks(text, window, shards, asked_levels), f"shard int, blk int, {FULL}")
    lost = _exchange(full, shards, parts, FULL, _full_answers, _full_up, _full_down, "h binary, g binary")
    nothing = F.lit(None).cast("binary")

    def finish(table: pa.Table, got: pa.Table) -> pa.Table:
        gone_h, gone_g, gone_s = [], [], []
        for s, h, g in zip(got.column("shard").to_pylist(), got.column("h").to_pylist(), got.column("g").to_pylist(), strict=True):
            if h is not None:
                gone_h.append(unpack(h, 8))
                gone_g.append(unpack(g, 2))
                gone_s.append(np.full(len(gone_h[-1]), s, U64))
        alive_here = _told(got.filter(pc.is_valid(got.column("keys"))), asked_levels)
        lost_h = np.concatenate(gone_h) if gone_h else np.zeros(0, U64)
        lost_g = (np.concatenate(gone_g) | (np.concatenate(gone_s) << U64(16))) if gone_h else np.zeros(0, U64)
        ids = _ids(table) if table.num_rows else np.zeros(0, np.int64)
        parts = list(_candidates(table, text, window, shards, alive_here)) if table.num_rows else []
        h = np.concatenate([p[3] for p in parts]) if parts else np.zeros(0, U64)
        g = np.concatenate([p[4] for p in parts]) if parts else np.zeros(0, U64)
        row = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int64)
        mine = ids[row] if len(row) else np.zeros(0, np.int64)
        # Smallest doc_id here for each window, NO_ID left out; then those lost to other blocks.
        key = (g & U64(0xFFFF)) | (_shard(g, shards).astype(U64) << U64(16))
        order, begin = _runs(h, key, np.where(mine == NO_ID, np.iinfo(np.int64).max, mine))
        least = np.empty(len(h), np.int64)
        if len(h):
            least[order] = np.repeat(mine[order][begin], np.diff(np.append(begin, len(h))))
        gone = (least < mine) & (least != NO_ID)
        if len(lost_h):
            gone |= _in_pairs(h, key, lost_h, lost_g)
        gone &= mine != NO_ID
        texts, words, removed, at = [], [], [], 0
        for (lo, hi, b, o, w), starts, *_ in parts:
            covered = _covered(len(w.words.start), starts[gone[at : at + len(starts)]], window)
            at += len(starts)
            raw = b.tobytes()
            lost_words = np.add.reduceat(np.append(covered, False), np.minimum(w.words.first[:-1], len(covered))) if len(o) > 1 else []
            for d in range(hi - lo):
                f, e = int(w.words.first[d]), int(w.words.first[d + 1])
                own = raw[int(o[d]) : int(o[d + 1])]
                n_lost = int(lost_words[d]) if e > f else 0
                words.append(e - f)
                removed.append(n_lost)
                if n_lost:
                    mask = covered[f:e]
                    s, t = (w.words.start[f:e] - o[d]).tolist(), (w.words.end[f:e] - o[d]).tolist()
                    own = _cut(own, t, mask) if layout == "cut" else b" ".join(own[x:y] for x, y, m in zip(s, t, mask.tolist(), strict=True) if not m)
                elif layout == "words":
                    own = b" ".join(own.split())
                texts.append(own.decode("utf-8", "replace"))
        return pa.table([column(table, n) for n in names] + [pa.array(texts, pa.string()), pa.array(words, pa.int64()), pa.array(removed, pa.int64())], names=names + new.names)

    answers = told.select("*", nothing.alias("h"), nothing.alias("g")).unionByName(lost.select("*", nothing.alias("keys"), F.lit(0).alias("level")))
    return put_back(dealt.cogroup(answers.groupBy("__blk")).applyInArrow(finish, T.StructType(fields + list(new.fields))), aside)


def _in_pairs(h: np.ndarray, g: np.ndarray, set_h: np.ndarray, set_g: np.ndarray) -> np.ndarray:
    """Whether each pair (h, g) is in the set of pairs, sorted here."""
    order = np.lexsort((set_g, set_h))
    set_h, set_g = set_h[order], set_g[order]
    lo, hi = np.searchsorted(set_h, h), np.searchsorted(set_h, h, "right")
    out = np.zeros(len(h), bool)
    one = hi == lo + 1
    out[one] = set_g[lo[one]] == g[one]
    for k in np.flatnonzero(hi > lo + 1).tolist():
        out[k] = g[k] in set_g[lo[k] : hi[k]]
    return out
