"""Approximate nearest neighbours by additive quantisation.

A vector is the sum of one codeword from each of M full-dimensional codebooks,
trained on residuals from a bounded sample, and found by beam search.
With the reconstruction's squared norm stored, the distance to a query is
|q|^2 - 2 * sum of M table look-ups + norm. Each block of candidates is scored for
a block of queries. Those that may be among the k nearest are reranked by their
exact distance on the original vectors, and blocks' winners are merged.

Which ones may be is decided by row, not by a number of rows a block: the stored
error of a row's reconstruction tells how far its distance can be from the looked-up
one, so a tight cluster of many rows is reranked as a whole and block sizes don't matter.
Beyond the residual's length the error is taken as random in direction (MARGIN standard
deviations); within it, where a query and its neighbours may have the same residual, by the triangle inequality.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, materialize

#: Vectors that codebooks are fitted on, at most, chosen by a hash of their id.
SAMPLE_ROWS = 8192
#: Queries that are matched with all rows in one pass; more queries take more passes.
QUERY_BLOCK = 4096
CODEBOOKS, CODEWORDS, BEAM = 32, 64, 4
#: Rows scored at once.
ROWS = 10_000
#: Standard deviations of the looked-up distance's error within which a row is reranked. The error is
#: the row's residual along the line to the query, of which a random direction takes 1 / sqrt(d).
MARGIN = 4.0


@dataclass
class Codebooks:
    words: np.ndarray  # (M, K, d) float32

    def __post_init__(self):
        m, k, d = self.words.shape
        flat = self.words.reshape(m * k, d)
        self.inner = (flat @ flat.T).reshape(m, k, m, k)
        self.norm = (flat**2).sum(axis=1).reshape(m, k)

    @classmethod
    def fit(cls, x: np.ndarray, seed: int = 11, rounds: int = 6) -> Codebooks:
        """Codebooks one after another by k-means on what earlier ones leave, then refitted together."""
        rng = np.random.default_rng(seed)
        x = x.astype(np.float32)
        k = min(CODEWORDS, max(1, len(x)))
        rest, words, codes = x.copy(), [], []
        for _ in range(CODEBOOKS):
            centre = rest[rng.choice(len(rest), k, replace=False)]
            for _ in range(rounds):
                near = _nearest(rest, centre)
                total = np.zeros_like(centre)
                np.add.at(total, near, rest)
                count = np.bincount(near, minlength=k)
                centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre).astype(np.float32)
            near = _nearest(rest, centre)
            rest = rest - centre[near]
            words.append(centre)
            codes.append(near)
        out = cls(np.stack(words))
        for _ in range(2):  # least squares over all codebooks, given beam-search codes
            got, *_ = out.encode(x)
            design = np.zeros((len(x), CODEBOOKS * k), np.float32)
            for m in range(CODEBOOKS):
                design[np.arange(len(x)), m * k + got[:, m].astype(np.int64)] = 1
            gram = design.T @ design + 0.5 * np.eye(CODEBOOKS * k, dtype=np.float32)
            base = out.words.reshape(CODEBOOKS * k, -1)
            out = cls((base + np.linalg.solve(gram, design.T @ (x - design @ base))).reshape(out.words.shape).astype(np.float32))
        return out

    def encode(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes (n, M) uint8 by beam search, the squared norms of the reconstructions, and of what they leave."""
        m_all, k, _ = self.words.shape
        n = len(x)
        codes = np.zeros((n, 1, 0), np.int64)
        cost = np.zeros((n, 1))
        norm = np.zeros((n, 1))
        dot = np.einsum("nd,mkd->nmk", x.astype(np.float32), self.words, optimize=True)
        for m in range(m_all):
            width = codes.shape[1]
            cross = np.zeros((n, width, k))
            for j in range(m):
                cross += self.inner[j][codes[:, :, j], m]
            new_norm = norm[:, :, None] + self.norm[m] + 2 * cross
            new_cost = cost[:, :, None] + self.norm[m] + 2 * cross - 2 * dot[:, m][:, None, :]
            flat = new_cost.reshape(n, -1)
            keep = min(beam, flat.shape[1])
            best = np.argpartition(flat, keep - 1, axis=1)[:, :keep] if keep < flat.shape[1] else np.tile(np.arange(keep), (n, 1))
            row = np.arange(n)[:, None]
            codes = np.concatenate([codes[row, best // k], (best % k)[:, :, None]], axis=2)
            cost, norm = flat[row, best], new_norm.reshape(n, -1)[row, best]
        top = cost.argmin(axis=1)
        at = np.arange(n)
        return codes[at, top].astype(np.uint8), norm[at, top], np.maximum((x.astype(np.float64) ** 2).sum(axis=1) + cost[at, top], 0)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(queries, M / 2, K * K) inner products with the sums of two codewords of neighbouring codebooks."""
        one = np.einsum("qd,mkd->qmk", queries.astype(np.float32), self.words, optimize=True)
        return (one[:, ::2, :, None] + one[:, 1::2, None, :]).reshape(len(queries), one.shape[1] // 2, -1)


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (-2 * x @ centre.T + (centre**2).sum(axis=1)).argmin(axis=1)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id long and embedding of vectors without null or non-finite components and not zero; array<double> stays, others are array<float>."""
    e = F.col(embedding)
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists(e, lambda v: v != 0)
    kind = vectors.schema[embedding].dataType
    kept = e if kind == T.ArrayType(T.DoubleType(), kind.containsNull) else e.cast("array<float>")
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), kept.alias("embedding")).where(F.col(vec_id).isNotNull() & e.isNotNull() & ~bad & some)


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    return pc.list_flatten(col).to_numpy(zero_copy_only=False).reshape(-1, d)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", margin: float = MARGIN, sample_rows: int = SAMPLE_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k nearest vectors found for each query: query_id, rank, vec_id, score.

    Nearness is Euclidean distance in double precision on the original vectors,
    ties to the smaller vec_id; a query's own vec_id is no candidate. Vectors that
    are null, zero, or hold null or non-finite components take no part, on either
    side; those of another length than the first query's neither.
    Repeated vec_ids are candidates of their own, but one query (the smallest vector). Every row is encoded and scored for
    every query, queries in blocks of fixed size; codebooks are fitted on
    at most sample_rows rows. No queries or no vectors, no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    asked = usable(queries, vec_id, embedding).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    first = asked.select(F.size("embedding").alias("d")).orderBy(F.col("vec_id")).first()
    if first is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = first.d
    rows, asked = rows.where(F.size("embedding") == d), asked.where(F.size("embedding") == d)
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit("sample")), "vec_id").limit(sample_rows).toArrow()
    books = Codebooks.fit(_matrix(column(sample, "embedding"), d)) if sample.num_rows else None
    if books is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(books.words)

    def encode(batches):
        own = Codebooks(shared.value)
        for batch in batches:
            x = _matrix(column(batch, "embedding"), d)
            parts = [own.encode(x[i : i + 2048]) for i in range(0, len(x), 2048)]
            if not parts:
                continue
            codes, norm, left = (np.concatenate(p) for p in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays([column(batch, "vec_id"), column(batch, "embedding"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(left)], names=["vec_id", "embedding", "codes", "norm", "left"])

    coded = materialize(rows.mapInArrow(encode, f"vec_id long, embedding {rows.schema['embedding'].dataType.simpleString()}, codes binary, norm double, left double"), "codes")

    # Only one block of queries at a time is on the driver.
    total = asked.count()
    pieces = -(-total // query_block)
    out = None
    for piece in range(pieces):
        part = asked if pieces == 1 else asked.where(F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(pieces)) == piece)
        block = part.toArrow()
        if not block.num_rows:
            continue
        found = _one_block(coded, column(block, "vec_id").to_numpy(), _matrix(column(block, "embedding"), d), shared, k, d, margin)
        if pieces > 1:
            found = materialize(found, "neighbours")
        out = found if out is None else out.unionByName(found)
    return out


def _one_block(coded: DataFrame, ids: np.ndarray, queries: np.ndarray, shared, k: int, d: int, margin: float) -> DataFrame:
    spark = coded.sparkSession
    held = spark.sparkContext.broadcast((ids, queries))

    def score(batches):
        ids, queries = held.value
        tables = Codebooks(shared.value).tables(queries)
        exact = queries.astype(np.float64)
        size = (exact**2).sum(axis=1)
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in ids]
        words = shared.value.shape[1]
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            own = column(batch, "vec_id").to_numpy()
            x = _matrix(column(batch, "embedding"), d).astype(np.float64)
            codes = np.frombuffer(b"".join(column(batch, "codes").to_pylist()), np.uint8).reshape(-1, CODEBOOKS)
            pairs = np.ascontiguousarray((codes[:, ::2].astype(np.int32) * words + codes[:, 1::2]).T)
            norm, left = column(batch, "norm").to_numpy(), column(batch, "left").to_numpy()
            spread = 2 * margin * np.sqrt(left / d)
            for q in range(len(ids)):
                dot = np.zeros(len(own), np.float32)
                for table, at in zip(tables[q], pairs, strict=True):
                    dot += table[at]
                near = np.maximum(size[q] + norm - 2 * dot, 0)
                root = np.sqrt(near)
                least = near + left - spread * root
                least[own == ids[q]] = np.inf
                seen = np.zeros(0, np.int64)
                if len(best[q][0]) < k:  # the first rows set the distance to beat
                    seen = np.argpartition(least, 4 * k)[: 4 * k] if len(least) > 4 * k else np.arange(len(least))
                    best[q] = _nearer(best[q], own, x, exact[q], seen[np.isfinite(least[seen])], k)
                limit = best[q][1][-1] ** 2 * (1 + 1e-9) if len(best[q][0]) == k else np.inf
                least[seen] = np.inf
                # Neighbours nearer than the residuals may share theirs with the query: there only the triangle inequality holds.
                close = (limit <= 4 * left) & (least < np.inf) & (root <= np.sqrt(limit) + np.sqrt(left) + 1e-6)
                least[close] = 0
                best[q] = _nearer(best[q], own, x, exact[q], np.flatnonzero((least <= limit) & (least < np.inf)), k)
        counts = [len(v) for v, _ in best]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, counts)), *(pa.array(np.concatenate([b[n] for b in best] or [np.zeros(0)]).astype(t)) for n, t in ((0, np.int64), (1, np.float64)))], names=["query_id", "vec_id", "score"])

    found = coded.mapInArrow(score, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearer(best: tuple[np.ndarray, np.ndarray], own: np.ndarray, x: np.ndarray, query: np.ndarray, pick: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest, by exact distance and then id, of the best so far and the picked rows."""
    if not len(pick):
        return best
    ids = np.concatenate([best[0], own[pick]])
    distance = np.concatenate([best[1], np.sqrt(((x[pick] - query) ** 2).sum(axis=1))])
    top = np.lexsort((ids, distance))[:k]
    return ids[top], distance[top]
