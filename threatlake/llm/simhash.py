"""SimHash near-duplicate detection with pigeonring candidate filtering.

Documents become 64-bit SimHash fingerprints; equal fingerprints are collapsed
first, so copies cost one row. Two fingerprints at most `max_bits` apart, cut
into a ring of m segments, have a segment from which every chain of l segments
differs in at most l * max_bits / m bits (the pigeonring principle). The first
links of that chain give exact join keys: the start segment, whose budget is
below one bit and which is therefore equal, and the parts of the next segments
that its budget leaves untouched. The join condition then checks the whole
chain and at last the full Hamming distance, so only links leave the join.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, map_columns, materialize
from .graph import components
from .kernel import MASK64, combine

#: A-Z to a-z in UTF-8 bytes; other letters keep their case.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEED = 42


def fingerprint(text: bytes, shingle_words: int) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included.

    A bit is 1 if it is set in over half of the shingles' XXH64 hashes. A text
    of fewer words is one shingle; one without words has fingerprint zero.
    """
    words = text.translate(LOWER).split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle_words:
        hashes = np.array([digest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.empty(n, np.int64)
        starts[0], starts[1:] = 0, ends[:-1] + 1
        count = n - shingle_words + 1
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:count].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)), np.uint64, count)
    return lane_bits(hashes)


def lane_bits(hashes: np.ndarray) -> int:
    """64 bits, each set if it is in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[lo : lo + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def chained(a: np.ndarray, b: np.ndarray, max_bits: int, segments: int = 4) -> np.ndarray:
    """Whether the rows of two (rows, lanes) fingerprints differ in at most max_bits bits.

    The lanes are a ring of segments. By the pigeonring principle a pair within
    max_bits has a segment from which every chain stays within its share of
    them; pairs whose chains of one and two segments all exceed it go before the full check.
    """
    width = a.shape[1] // segments
    d = np.bitwise_count(a ^ b).reshape(len(a), segments, width).sum(axis=2, dtype=np.int64)
    chain = (d * segments <= max_bits) & ((d + np.roll(d, -1, axis=1)) * segments <= 2 * max_bits)
    ok = chain.any(axis=1)
    ok[ok] = d[ok].sum(axis=1) <= max_bits
    return ok


def with_fingerprints(docs: DataFrame, shingle_words: int = 5, text: str = "text") -> DataFrame:
    """docs and fingerprint_bits, a long; a null text counts as empty."""

    def start():
        def step(batch):
            rows = [fingerprint((x.as_buffer().to_pybytes() if x.is_valid else b""), shingle_words) for x in column(batch, text)]
            return [pa.array(np.array(rows, np.uint64).view(np.int64))]

        return step

    return map_columns(docs, start, "fingerprint_bits long")


def _segments(max_bits: int) -> int:
    """The ring's segments: a divisor of 64 above max_bits, so a chain's first segment is equal."""
    if not 0 <= max_bits < 16:
        raise ValueError("max_bits is from 0 to 15")
    return next(m for m in (4, 8, 16) if m > max_bits)


def _bits(fp: Column, at: int, width: int) -> Column:
    """`width` bits from bit `at`, around the ring."""
    return F.shiftrightunsigned(fp, at % 64).bitwiseAND(F.lit((1 << width) - 1))


def _choices(max_bits: int) -> tuple[int, int, list[tuple[int, ...]]]:
    """Parts of the segments after the first that give key bits, those segments, and which parts are equal."""
    m = _segments(max_bits)
    parts, after = {4: (2, 1), 8: (4, 2), 16: (4, 2)}[m]
    budget = (after + 1) * max_bits // m
    return parts, after, list(combinations(range(parts), max(0, parts - budget)))


def _key_count(max_bits: int) -> int:
    return _segments(max_bits) * len(_choices(max_bits)[2])


def join_keys(fp: Column, max_bits: int) -> Column:
    """Array of longs: fingerprints that are linked share at least one.

    Of a chain from segment i, segment i is equal, and the next ones together
    differ in few bits: cut into one part more than those bits, or a few more,
    some choice of parts is equal too. A key is (i, choice, those bits).
    """
    m = _segments(max_bits)
    width = 64 // m
    parts, after, choices = _choices(max_bits)
    size = width * after // parts
    keys = []
    for i in range(m):
        for c, chosen in enumerate(choices):
            key = F.lit(i * len(choices) + c).cast("long")
            key = F.shiftleft(key, width).bitwiseOR(_bits(fp, i * width, width))
            for p in chosen:
                key = F.shiftleft(key, size).bitwiseOR(_bits(fp, (i + 1) * width + p * size, size))
            keys.append(key)
    return F.array(*keys)


class Buckets:
    """Links inside buckets of equal keys, read in key order; emits only a spanning forest of each task's links.

    Rows are (key, start, fp, node). Two rows are linked if the chain from their
    key's start holds and their fp differ in at most max_bits bits. A bucket of up to SMALL rows is
    compared row against following row, all such buckets of a batch at once; a larger
    one is walked breadth first, so a dense group costs about one comparison a
    row. One of more than `most` rows is not held: it is dealt anew by finer keys.
    """

    SMALL = 48
    NAMES = ("key", "start", "fp", "node")

    def __init__(self, max_bits: int, most: int | None):
        self.max_bits, self.most, self.m = max_bits, most, _segments(max_bits)
        self.parent: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def linked(self, start: np.ndarray, fp: np.ndarray, to: np.ndarray) -> np.ndarray:
        """The chain from the key's own start, link by link, then the full distance."""
        width = 64 // self.m
        turn = (start * width).astype(np.uint64)
        d = fp ^ to
        d = (d >> turn) | (d << ((np.uint64(64) - turn) & np.uint64(63)))
        ok = np.ones(len(d), bool)
        for n in (1, 2, 3):
            ok &= np.bitwise_count(d & np.uint64((1 << (n * width)) - 1)) <= n * self.max_bits // self.m
        return ok & (np.bitwise_count(d) <= self.max_bits)

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.edges.append((a, b))

    def small(self, rows: list[np.ndarray]) -> None:
        key, start, fp, node = rows
        at = np.arange(len(key))
        for lag in range(1, self.SMALL):
            at = at[at + lag < len(key)]
            at = at[key[at] == key[at + lag]]
            if not len(at):
                return
            hit = at[self.linked(start[at], fp[at], fp[at + lag])]
            for a, b in zip(node[hit].tolist(), node[hit + lag].tolist(), strict=True):
                self.join(a, b)

    def large(self, rows: list[np.ndarray]) -> None:
        _, start, fp, node = rows
        left = np.unique(node, return_index=True)[1]
        while len(left):
            front, left = [int(left[0])], left[1:]
            while front and len(left):
                now = front.pop()
                hit = self.linked(start[left], fp[left], fp[now])
                for x in left[hit].tolist():
                    self.join(int(node[now]), int(node[x]))
                    front.append(x)
                left = left[~hit]

    def finer(self, key: int, fp: np.ndarray) -> list[np.ndarray]:
        """Keys of max_bits + 1 parts, of which linked rows share at least one."""
        n = self.max_bits + 1
        edge = [64 * k // n for k in range(n + 1)]
        keys = []
        for k in range(n):
            part = (fp >> np.uint64(edge[k])) & np.uint64((1 << (edge[k + 1] - edge[k])) - 1)
            keys.append(combine(np.full(len(fp), key & MASK64, np.uint64), part, 200 + k))
        return keys

    def run(self, batches):
        """Batches sorted by key -> edges (start -1, fp and node are the two nodes) and rows that are dealt anew."""
        held: list[np.ndarray] = []
        passing: int | None = None
        for batch in batches:
            new = [column(batch, c).to_numpy() for c in self.NAMES]
            new = [x.astype(np.int64) if k < 2 or k == 3 else x.view(np.uint64) for k, x in enumerate(new)]
            held = [np.concatenate(x) for x in zip(held, new, strict=True)] if held else new
            key = held[0]
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            if passing is not None and len(begin) == 1 and key[0] == passing:
                yield self._anew(held)  # the large bucket goes on
                held = []
                continue
            done = int(begin[-1]) if len(begin) else 0
            yield from self._buckets([x[:done] for x in held], passing)
            held = [x[done:] for x in held]
            if self.most is not None and len(held[0]) > self.most:
                passing = int(held[0][0])
                yield self._anew(held)
                held = []
        if held and len(held[0]):
            yield from self._buckets(held, passing)

    def _buckets(self, rows: list[np.ndarray], passing: int | None):
        key = rows[0]
        if not len(key):
            return
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        goes_on = key[begin] == passing if passing is not None else np.zeros(len(begin), bool)
        for at in np.flatnonzero((size > self.SMALL) | goes_on).tolist():
            own = [x[begin[at] : begin[at] + size[at]] for x in rows]
            if self.most is not None and (size[at] > self.most or goes_on[at]):
                yield self._anew(own)
            else:
                self.large(own)
        few = np.repeat((size <= self.SMALL) & ~goes_on, size)
        self.small([x[few] for x in rows])
        if self.edges:
            a, b = (np.array(x, np.int64) for x in zip(*self.edges, strict=True))
            self.edges = []
            yield self._batch([np.zeros(len(a), np.int64), np.full(len(a), -1), a, b])

    def _anew(self, rows: list[np.ndarray]):
        keys = self.finer(int(rows[0][0]), rows[2])
        return self._batch([np.concatenate(keys), *(np.tile(x, len(keys)) for x in rows[1:])])

    def _batch(self, rows: list[np.ndarray]):
        arrays = [pa.array(x.astype(np.int32) if n == "start" else x.view(np.int64)) for n, x in zip(self.NAMES, rows, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=list(self.NAMES))


def links(prints: DataFrame, max_bits: int, most: int = 20_000) -> DataFrame:
    """(a, b): enough links to connect what chains of links connect, of distinct long values fp.

    Linked values differ in at most max_bits bits. Buckets larger than `most`
    are dealt anew by finer keys, twice at the utmost; what is then still
    large is a dense ball, which the breadth-first walk passes quickly.
    """
    keys = F.transform(join_keys(F.col("fp"), max_bits), lambda k, i: F.struct(k.alias("key"), F.floor(i * F.lit(_segments(max_bits)) / F.lit(_key_count(max_bits))).cast("int").alias("start")))
    keyed = prints.select("fp", F.explode(keys).alias("k")).select("k.key", "k.start", "fp", F.col("fp").alias("node"))
    out = None
    for last in (False, False, True):

        def run(batches, most=None if last else most):
            yield from Buckets(max_bits, most).run(batches)

        found = keyed.select(*Buckets.NAMES).repartition("key").sortWithinPartitions("key", "fp", "node").mapInArrow(run, "key long, start int, fp long, node long")
        found = materialize(found, "links")
        edges = found.where("start < 0").select(F.col("fp").alias("a"), F.col("node").alias("b"))
        out = edges if out is None else out.unionByName(edges)
        keyed = found.where("start >= 0")
        if keyed.isEmpty():
            break
    return out


def similar_documents(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id and component_id, linked by shingle similarity instead of fingerprint bits.

    See `near_copies`, which holds this mode and states its cases.
    """
    from .near_copies import near_copies

    return near_copies(docs, shingle_words, similarity, doc_id, text)


def near_duplicates(docs: DataFrame, shingle_words: int = 5, max_bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, fingerprint_bits long, component_id.

    component_id is the smallest doc_id that chains of links reach, the
    document's own included. Null text counts as empty and has fingerprint
    zero, which links like any other. A null doc_id keeps its row and takes the
    component's smallest id (null only if the component has no other id).
    Repeated doc_ids keep their rows; an empty table gives an empty result;
    other columns are not read.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = materialize(with_fingerprints(texts, shingle_words).drop("text"), "fingerprints")
    classes = prints.groupBy(F.col("fingerprint_bits").alias("fp")).agg(F.min("doc_id").alias("first_id"))
    found = components(links(classes.select("fp"), max_bits))
    # A class's component is named by a fingerprint; the smallest id of its classes renames it.
    named = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = named.select("fp", "root").join(ids, "root").select(F.col("fp").alias("fingerprint_bits"), "component_id")
    return prints.join(of_class, "fingerprint_bits").select("doc_id", "fingerprint_bits", "component_id")
