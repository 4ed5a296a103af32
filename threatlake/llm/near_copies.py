"""Near copies by exact shingle similarity: wide SimHash fingerprints prune, exact sets decide.

A document is the set of its distinct word shingles (64-bit hashes); equal sets
are collapsed first. Two sets at a similarity of 0.8 differ in 0.15 of their SimHash bits
(`most_bits`), about 39 of 256: no segment of a fingerprint is then equal often enough
to be a join key. So buckets come from MinHash bands of the same shingles, and
inside a bucket fingerprints do what they are good at: a pair must pass the
pigeonring chains and the Hamming check of 256 bits, and in large buckets of 2,048
bits, before its sets are compared. Every link is confirmed by both sets, so
none is an estimate.

Buckets of up to SMALL sets try all pairs. In a larger one, mostly one group of
near copies, all are tried against its hub (the set nearest to the bucket's
majority fingerprint); then, with those links' components known, only pairs that are still in
different components are tried, by the wide fingerprint: the sets outside of the bucket's
main component with each other and with that component's.

A bucket of more than MOST sets does the same in parts. A slice of about MOST of its sets
chooses the hub, which the others meet by a join, so no task holds the bucket. For the second
round both sides, the main component's sets and the others, are cut into slices of about MOST
sets, and each pair of slices that has pairs to try is a cell of its own: the same pairs
are tried at every size, by tasks of bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, column, give_back, materialize, release
from .graph import components
from .kernel import U64, blocks, find_words, mix, range_hash, text_buffer, window_hash, window_valid
from .simhash import LOWER, chained, lane_bits

#: A pair at a similarity of 0.8 has no band in common once in 38,000.
BANDS, ROWS = 20, 4
#: 64-bit lanes of the two fingerprints; the narrow one is the beginning of the wide one.
NARROW, WIDE = 4, 32
#: Sets of a bucket that all try each other, and sets beyond which a bucket is tried in parts.
SMALL, MOST = 16, 20_000
#: Text bytes sketched at once: a quarter of other kernels', since the shingles' hashes and their order are held side by side.
SKETCH_BYTES = 512 << 10
#: Sets of fewer than FEW shingles are not pruned; up to COARSE, the share of differing bits still depends on the number's parity.
FEW, COARSE = 5, 64

_LOWER = np.frombuffer(LOWER, np.uint8)
_ODD = mix(np.arange(1, BANDS * ROWS + 4, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def most_bits(similarity: float, lanes: int, coarse: bool = True) -> int:
    """Differing bits that a pair of this similarity exceeds once in 100,000 (4.3 standard deviations).

    SimHash expects acos(2 s / (1 + s)) / pi of the bits to differ; the parity of fewer than COARSE shingles adds up to a twentieth.
    """
    p, n = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi) * (1.05 if coarse else 1.0), 64 * lanes
    return int(np.ceil(n * p + 4.3 * (n * p * (1 - p)) ** 0.5))


def shingle_sets(text: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(texts, values, first) of runs of texts: values[first[d] : first[d + 1]] are text d's distinct shingle hashes, ascending.

    A text of fewer words is one shingle; one without words has none. A null text counts as empty.
    """
    buffer, offsets = text_buffer(text)
    for lo, hi, raw, own in blocks(buffer, offsets, SKETCH_BYTES):
        raw = _LOWER[raw]
        words = find_words(raw, own)
        h = range_hash(raw, words.start, words.end)
        count = np.diff(words.first)
        g = window_hash(h, size)
        ok = window_valid(words.first, size, len(g))
        doc, value = [words.doc()[: len(g)][ok]], [g[ok]]
        for m in range(1, size):
            few = np.flatnonzero(count == m)
            if len(few):
                doc.append(few)
                value.append(window_hash(h, m)[words.first[few]])
        d, v = np.concatenate(doc), np.concatenate(value)
        order = np.lexsort((v, d))
        d, v = d[order], v[order]
        new = np.ones(len(v), bool)
        new[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
        d, v = d[new], v[new]
        yield hi - lo, v, np.searchsorted(d, np.arange(hi - lo + 1))


def _class_id(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set; zero for the empty one."""
    out = np.zeros(len(first) - 1, U64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        at = first[full]
        x = np.add.reduceat(mix(values ^ _ODD[-1]), at) * _ODD[-2]
        out[full] = mix(x ^ mix(np.add.reduceat(mix(values ^ _ODD[-3]), at) + np.diff(first)[full].astype(U64)))
    return out


def _sketch(size: int):
    """Batches of doc_id and text -> doc_id, cls, n, bands and the narrow lanes, a batch for each block of texts."""
    names = ["doc_id", "cls", "n", "bands", *(f"f{k}" for k in range(NARROW))]

    def run(batches):
        for batch in batches:
            at = 0
            for texts, values, first in shingle_sets(column(batch, "text"), size):
                count = np.diff(first)
                full = np.flatnonzero(count)
                keys = np.zeros((len(full), BANDS), U64)
                for k in range(BANDS * ROWS if len(full) else 0):
                    least = np.minimum.reduceat((values ^ _ODD[k - 1]) * _ODD[k], first[full])
                    band = k // ROWS
                    keys[:, band] = mix((keys[:, band] ^ least) * _ODD[k] + U64(band + 1))
                ends = np.concatenate([[0], np.cumsum(np.where(count > 0, BANDS, 0))]).astype(np.int32)
                lanes = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in fingerprints_of(values, first, NARROW).T]
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64)))
                ids = pa.array(_class_id(values, first).view(np.int64))
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id").slice(at, texts), ids, pa.array(count.astype(np.int64)), bands, *lanes], names=names)
                at += texts
            give_back()

    return run


def fingerprints_of(values: np.ndarray, first: np.ndarray, lanes: int) -> np.ndarray:
    """(sets, lanes) of 64-bit SimHash lanes of the sets' own hashes."""
    out = np.zeros((len(first) - 1, lanes), U64)
    for lane in range(lanes):
        own = mix(values ^ mix(np.full(1, lane + 1, U64)))
        out[:, lane] = [lane_bits(own[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    return out


def _stored(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))


def _wide(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in fingerprints_of(values, first, WIDE)], pa.binary())


class Pairs:
    """Candidate pairs inside buckets of equal keys, read in key order.

    Rows are (key, cls, node, n, fp) and, with `rest`, root, at, side and bands: then a bucket gives the pairs of side 0
    with each other and of sides 0 and 1 with side 2 that are in different components, each one in the first band
    that it shares; without it, small buckets give all pairs and large ones those with their hub. All pairs pass the
    size bound and the fingerprints.
    """

    def __init__(self, similarity: float, rest: bool):
        self.similarity, self.rest, self.lanes = similarity, rest, WIDE if rest else NARROW
        self.names = ["key", "cls", "node", "n", *(["root", "at", "side", "wide", "bands"] if rest else [f"f{k}" for k in range(NARROW)])]

    def read(self, batch) -> list[np.ndarray]:
        new = [column(batch, c) for c in self.names]
        if not self.rest:
            new = [x.to_numpy() for x in new]
            return [*new[:4], np.stack(new[4:], axis=1).view(U64)]
        wide = np.frombuffer(b"".join(new[7].to_pylist()), U64).reshape(-1, WIDE)
        return [*(x.to_numpy() for x in new[:4]), wide, *(x.to_numpy() for x in new[4:7]), new[8].flatten().to_numpy().reshape(-1, BANDS)]

    def run(self, batches):
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = self.read(batch)
            begin = int(np.searchsorted(new[0], new[0][-1]))  # of the last key
            if begin or (held and held[-1][0][-1] != new[0][0]):
                yield from self.buckets([np.concatenate(x) for x in zip(*held, [x[:begin] for x in new], strict=True)])
                held = []
            held.append([x[begin:] for x in new])
        if held:
            yield from self.buckets([np.concatenate(x) for x in zip(*held, strict=True)])

    def buckets(self, rows):
        begin, size = _starts(rows[0])
        if self.rest:
            for lo, n in zip(begin.tolist(), size.tolist(), strict=True):
                yield from self.cell([x[lo : lo + n] for x in rows])
            return
        few = np.flatnonzero(np.repeat(size <= SMALL, size))
        own, at = rows[0][few], np.arange(len(few))
        for lag in range(1, SMALL):
            at = at[at + lag < len(few)]
            at = at[own[at] == own[at + lag]]
            if not len(at):
                break
            yield from self.out(rows, few[at], few[at + lag])
        for lo, n in zip(begin[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
            hub = lo + _hub(rows[4][lo : lo + n])
            yield from self.out(rows, np.full(n - 1, hub), np.delete(np.arange(lo, lo + n), hub - lo))

    def cell(self, rows):
        """The pairs of one bucket, those of too different sizes skipped by order of size."""
        order = np.argsort(rows[3], kind="stable")
        rows = [x[order] for x in rows]
        n, side = rows[3], rows[7]
        every, left, right = (np.flatnonzero(x) for x in (side == 0, side < 2, side == 2))
        end = np.searchsorted(n[every], n[every] / self.similarity + 1e-6, side="right")
        for k, (x, z) in enumerate(zip(every.tolist(), end.tolist(), strict=True)):
            if z > k + 1:
                yield from self.out(rows, np.full(z - k - 1, x), every[k + 1 : z])
        begin = np.searchsorted(n[right], n[left] * self.similarity - 1e-6)
        end = np.searchsorted(n[right], n[left] / self.similarity + 1e-6, side="right")
        for x, y, z in zip(left.tolist(), begin.tolist(), end.tolist(), strict=True):
            if z > y:
                yield from self.out(rows, np.full(z - y, x), right[y:z])

    def out(self, rows, a, b):
        _, cls, node, n, fp, *rest = rows
        least = np.minimum(n[a], n[b])
        ok = least >= self.similarity * np.maximum(n[a], n[b]) - 1e-9
        if rest:
            root, at, _, bands = rest
            ok &= root[a] != root[b]
        a, b, least = a[ok], b[ok], least[ok]
        for lanes in dict.fromkeys((NARROW, self.lanes)):
            ok = least < FEW
            for coarse in (True, False):
                own = np.flatnonzero((least < COARSE) == coarse)
                ok[own] |= chained(fp[a[own], :lanes], fp[b[own], :lanes], most_bits(self.similarity, lanes, coarse))
            a, b, least = a[ok], b[ok], least[ok]
        if rest and len(a):
            first = ((bands[a] == bands[b]) & (np.arange(BANDS) < at[a][:, None])).any(axis=1)
            a, b = a[~first], b[~first]
        if len(a):
            turn = cls[a] > cls[b]
            a, b = np.where(turn, b, a), np.where(turn, a, b)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cls[a], cls[b], node[a], node[b])], names=["a", "b", "u", "v"])


class Hubs(Pairs):
    """One row for each bucket, its hub: key, and cls, node, n and the lanes with h_ before them."""

    def __init__(self):
        super().__init__(1, False)
        self.fields = ", ".join(f"{'' if c == 'key' else 'h_'}{c} long" for c in self.names)

    def buckets(self, rows):
        begin, size = _starts(rows[0])
        at = np.array([lo + _hub(rows[4][lo : lo + n]) for lo, n in zip(begin.tolist(), size.tolist(), strict=True)], np.int64)
        lanes = [np.ascontiguousarray(x).view(np.int64) for x in rows[4][at].T]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*(x[at] for x in rows[:4]), *lanes)], names=[x.split()[0] for x in self.fields.split(", ")])


def _starts(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and size of the runs of equal keys."""
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[: len(key)]
    return begin, np.diff(np.append(begin, len(key)))


def _hub(fp: np.ndarray) -> int:
    """The row nearest to the rows' majority fingerprint."""
    ones = np.zeros(64 * NARROW, np.int64)
    for k in range(0, len(fp), 8192):
        ones += np.unpackbits(fp[k : k + 8192].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    middle = np.packbits(2 * ones > len(fp), bitorder="little").view(U64)
    return int(np.bitwise_count(fp ^ middle).sum(axis=1).argmin())


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    """df, to be broadcast if its counted rows are few enough for that."""
    return F.broadcast(df) if row_bytes * df.count() <= BROADCAST_BYTES else df


def _tried(rows: DataFrame, pairs: Pairs) -> DataFrame:
    """(a, b, u, v): candidates of the rows' buckets."""

    def run(batches):
        yield from pairs.run(batches)
        give_back()

    return rows.select(*pairs.names).repartition("key").sortWithinPartitions("key", "cls").mapInArrow(run, "a long, b long, u long, v long")


def _with_hubs(rows: DataFrame, hot: DataFrame, similarity: float) -> DataFrame:
    """Candidates (a, b, u, v) of each row of a hot key with the key's hub, and of all other buckets.

    A slice of about MOST of the key's rows chooses the hub; one that chances to have none leaves its key to the second round.
    """
    pairs, hubs = Pairs(similarity, False), Hubs()
    few = _small(hot, 16)
    own = rows.select(*pairs.names).join(few, "key")

    def choose(batches):
        yield from hubs.run(batches)

    def meet(batches):
        for batch in batches:
            if batch.num_rows:
                other = pa.RecordBatch.from_arrays([batch.column(c if c == "key" else f"h_{c}") for c in pairs.names], names=pairs.names)
                both = [np.concatenate(x) for x in zip(pairs.read(batch), pairs.read(other), strict=True)]
                at = np.flatnonzero(both[1][: batch.num_rows] != both[1][batch.num_rows :])
                yield from pairs.out(both, at, at + batch.num_rows)

    slice_rows = own.where(F.pmod(F.xxhash64("cls"), "slices") == 0).select(*pairs.names).repartition("key").sortWithinPartitions("key", "cls")
    chosen = materialize(slice_rows.mapInArrow(choose, hubs.fields), "hubs")
    met = own.join(_small(chosen, 80), "key").drop("slices").mapInArrow(meet, "a long, b long, u long, v long")
    return _tried(rows.join(few, "key", "left_anti"), pairs).unionByName(met)


def _cells(rows: DataFrame) -> DataFrame:
    """rows with a key and a side for each cell that they take part in; `main` is the key's main component, `inside` its sets, `sets` all.

    Up to MOST sets the key is one cell; else each pair of slices with pairs to try is one.
    """
    inner = F.col("root") == F.col("main")
    others, mains = (F.greatest(F.lit(1), F.ceil(x / F.lit(MOST))) for x in (F.col("sets") - F.col("inside"), F.col("inside")))
    own = F.pmod(F.xxhash64("cls"), F.when(inner, mains).otherwise(others))

    def cell(kind: int, a, b, side):
        return F.struct(F.xxhash64("key", F.lit(kind), a, b).alias("key"), side.cast("int").alias("side"))

    def each(count, make):
        return F.transform(F.sequence(F.lit(0).cast("long"), count - 1), make)

    with_others = each(others, lambda k: cell(0, F.least(own, k), F.greatest(own, k), F.when(own == k, 0).when(own < k, 1).otherwise(2)))
    with_main = each(mains, lambda k: cell(1, own, k, F.lit(1)))
    of_main = each(others, lambda k: cell(1, k, own, F.lit(2)))
    whole = F.array(F.struct(F.col("key").alias("key"), F.when(inner, 2).otherwise(0).cast("int").alias("side")))
    cells = F.when(F.col("sets") <= MOST, whole).when(inner, of_main).otherwise(F.concat(with_others, with_main))
    return rows.withColumn("cell", F.explode(cells)).withColumns({"key": F.col("cell.key"), "side": F.col("cell.side")}).drop("cell")


def _of_classes(needed: DataFrame, texts: DataFrame, size: int, of, kind: str) -> DataFrame:
    """(cls, x) of the needed (doc_id, cls): x is of(values, first) of their texts, which are read again.

    The needed ids are broadcast if their number is known to be small; a join by id does it otherwise.
    """
    ids = needed.select("doc_id").distinct()
    if 16 * needed.count() <= BROADCAST_BYTES:
        ids = F.broadcast(ids)

    def run(batches):
        for batch in batches:
            at = 0
            for n, values, first in shingle_sets(column(batch, "text"), size):
                ids = pa.array(_class_id(values, first).view(np.int64))
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id").slice(at, n), ids, of(values, first)], names=["doc_id", "cls", "x"])
                at += n
            give_back()

    made = texts.join(ids, "doc_id", "left_semi").mapInArrow(run, T.StructType([texts.schema["doc_id"], *T._parse_datatype_string(f"cls long, x {kind}").fields]))
    out = materialize(made.join(needed, ["doc_id", "cls"], "left_semi").groupBy("cls").agg(F.first("x").alias("x")), "of-classes")
    release(needed)
    return out


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """(u, v) of the pairs whose sets are similar."""
    needed = materialize(pairs.select(F.col("u").alias("doc_id"), F.col("a").alias("cls")).union(pairs.select("v", "b")).distinct(), "needed")
    sets = _of_classes(needed, texts, size, _stored, "array<long>")
    left, right = (sets.select(F.col("cls").alias(c), F.col("x").alias(x)) for c, x in (("a", "xa"), ("b", "xb")))
    shared = F.size(F.array_intersect("xa", "xb"))
    similar = shared >= F.lit(similarity) * (F.size("xa") + F.size("xb") - shared)
    links = materialize(pairs.join(left, "a").join(right, "b").where(similar).select("u", "v"), "links")
    release(sets)
    return links


def near_copies(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id and component_id, by exact Jaccard similarity of shingle sets.

    component_id is the smallest doc_id that chains of links reach. Texts without
    words, null included, are copies of each other; a row of null doc_id takes the
    component of its set's class, null if no other row is in it; rows of one
    doc_id and set are one document; no documents, no rows; other columns are not
    read. `similarity` is at least 0.8, which the bands are made for.
    """
    if not 0.8 <= similarity <= 1:
        raise ValueError("similarity is from 0.8 to 1")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    lanes = [f"f{k}" for k in range(NARROW)]
    fields = ", ".join(f"{x} long" for x in lanes)
    sketched = T.StructType([texts.schema["doc_id"], *T._parse_datatype_string(f"cls long, n long, bands array<long>, {fields}").fields])
    prints = materialize(texts.mapInArrow(_sketch(shingle_words), sketched), "sketches")
    parts = [F.first(c).alias(c) for c in ("n", "bands", *lanes)]
    classes = materialize(prints.where("doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("node"), *parts), "classes")
    keyed = classes.select("*", F.posexplode("bands").alias("at", "key"))
    large = materialize(keyed.groupBy("key").count().where(F.col("count") > SMALL), "large")
    hot = materialize(large.where(F.col("count") > MOST).select("key", F.ceil(F.col("count") / F.lit(MOST)).alias("slices")), "hot")
    tried = _tried(keyed, Pairs(similarity, False)) if hot.isEmpty() else _with_hubs(keyed, hot, similarity)
    seen = materialize(tried.distinct(), "pairs")
    edges = _confirmed(seen, texts, shingle_words, similarity)
    found = components(edges, "u", "v")
    if not large.isEmpty():
        rest = keyed.select("key", "cls", "at", "node", "n", "bands").join(large.select("key"), "key", "left_semi").join(found, "node", "left")
        rest = materialize(rest.withColumn("root", F.coalesce("root", "node")), "rest")
        main = [F.max_by("root", F.struct("count", "root")).alias("main"), F.max("count").alias("inside"), F.sum("count").alias("sets")]
        mixed = rest.groupBy("key", "root").count().groupBy("key").agg(*main).where("inside < sets")
        every, rest = rest, materialize(rest.join(mixed, "key"), "mixed")
        wide = _of_classes(materialize(rest.select(F.col("node").alias("doc_id"), "cls").distinct(), "needed"), texts, shingle_words, _wide, "binary")
        cells = _cells(rest.join(wide.withColumnRenamed("x", "wide"), "cls"))
        more = materialize(_tried(cells, Pairs(similarity, True)).distinct().join(seen.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        release(every, rest, wide)
        if not more.isEmpty():
            found = components(edges.unionByName(_confirmed(more, texts, shingle_words, similarity)), "u", "v")
    same = prints.select("doc_id", "cls").join(classes.select("cls", "node"), "cls", "left").select("doc_id", "node")
    return same.join(found, "node", "left").select("doc_id", F.coalesce("root", "node").alias("component_id"))
