"""An inverted file beside a table of vectors: cells around centroids, and exact pruning of cells by the triangle inequality.

Vectors are scaled to length one, where cosine is 1 - d * d / 2 of the distance d. A
cell keeps its centroid c and radius r, the largest distance of its vectors from c, so
none of them is nearer to a query q than |c - q| - r. A search reads the cells of
the best bounds until it has k vectors and then those whose bound still allows a place
among them; the result is that of reading all. Centroids are fitted on a bounded sample,
every vector is dealt to a cell by Spark, and cells are Parquet partitions, so others aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

#: Vectors that centroids are fitted on, cells at most, and rounds of fitting.
SAMPLE, MOST_CELLS, ROUNDS = 20_000, 1024, 8
#: The cell of vectors of another width than the index's; they are read by every search.
OTHER = -1
#: Scores are rounded to six digits before they are compared.
ROUNDING = 1e-6


def fit(x: np.ndarray, cells: int, seed: int = 0) -> np.ndarray:
    """Centroids of unit vectors by a few rounds of means; a cell that is empty takes a vector far from its own."""
    r = np.random.default_rng(seed)
    centres = x[r.choice(len(x), min(cells, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = (x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        if empty := np.flatnonzero(n == 0).tolist():
            far = np.argsort(((x - centres[near]) ** 2).sum(1))[::-1]
            centres[empty] = x[far[: len(empty)]]
    return centres


def _unit(col: pa.Array, width: int) -> np.ndarray:
    x = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)
    return x / np.sqrt((x**2).sum(1))[:, None]


def build(vectors: DataFrame, folder: str, cells: int | None = None, key: str = "report_id", embedding: str = "embedding") -> None:
    """Writes the index of vectors (key, embedding) to a folder: cells and centroids. Vectors that no query has a cosine with, null and zero ones, are left out."""
    spark = vectors.sparkSession
    e = F.col(embedding)
    rows = vectors.select(F.col(key).alias("report_id"), e.alias("embedding")).where(F.col(key).isNotNull() & e.isNotNull() & X.cosine(e, e).isNotNull())
    widths = rows.groupBy(F.size("embedding").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    width, n = (widths.width, widths.n) if widths else (0, 0)
    sized = rows.where(F.size("embedding") == width)
    sample = sized.orderBy(F.xxhash64("report_id"), "report_id").limit(SAMPLE).toArrow()
    count = cells or max(1, min(MOST_CELLS, round(n**0.5)))
    centres = fit(_unit(sample.column("embedding").combine_chunks(), width), count) if n else np.zeros((0, 0))
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches):
        own = shared.value
        for batch in batches:
            x = _unit(batch.column("embedding"), width)
            cell = (x @ own.T - 0.5 * (own**2).sum(1)).argmax(1) if len(x) else np.zeros(0, np.int64)
            away = np.sqrt(((x - own[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column("report_id"), batch.column("embedding"), pa.array(cell.astype(np.int32)), pa.array(away)], names=["report_id", "embedding", "cell", "away"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    dealt = sized.mapInArrow(assign, f"{kinds}, cell int, away double") if n else sized.selectExpr("*", "0 as cell", "0D as away")
    other = rows.where(F.size("embedding") != width).select("*", F.lit(OTHER).alias("cell"), F.lit(2.0).alias("away"))
    # A cell's rows lie in a few files, however many tasks write.
    dealt.unionByName(other).repartition("cell", F.pmod(F.xxhash64("report_id"), F.lit(4))).write.mode("overwrite").partitionBy("cell").parquet(f"{folder}/cells")
    found = spark.read.parquet(f"{folder}/cells").groupBy("cell").agg(F.max("away").alias("radius"), F.count("*").alias("n")) if n else spark.createDataFrame([], "cell int, radius double, n long")
    at = spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(centres)], "cell int, centre array<double>")
    found.join(at, "cell", "left").select("cell", "centre", "radius", "n").coalesce(1).write.mode("overwrite").parquet(f"{folder}/centres")


def _bounds(centres: list, query: np.ndarray) -> list[tuple[float, int, int]]:
    """(highest cosine that a vector of the cell can have, cell, vectors), best first."""
    q = query / np.sqrt((query**2).sum())
    out = []
    for r in centres:
        if r.centre is not None and len(r.centre) != len(q):
            continue  # no cosine with vectors of another width
        least = 0.0 if r.centre is None else max(0.0, float(np.sqrt(((np.array(r.centre) - q) ** 2).sum())) - r.radius - 1e-9)
        out.append((1 - least * least / 2 if least < 2 else -1.0, r.cell, r.n))
    return sorted(out, key=lambda x: (-x[0], x[1]))


def search(spark: SparkSession, folder: str, query: list[float], k: int = 10) -> tuple[DataFrame, int]:
    """The k nearest by cosine (report_id, score), as nearest() of the whole table has them, and how many vectors were read for them."""
    q = np.array(query, np.float64)
    # Some thousand centroids at most.
    centres = spark.read.parquet(f"{folder}/centres").collect()
    table = None
    if centres:
        table = spark.read.parquet(f"{folder}/cells")
    if table is None or not np.isfinite(q).all() or not (q**2).sum():
        return spark.createDataFrame([], "report_id long, score double"), 0
    bounds = _bounds(centres, q)
    first, held = [], 0
    for bound, cell, n in bounds:
        if held >= k and cell != OTHER:
            continue
        first.append(cell)
        held += n if cell != OTHER else 0
    literal = F.array(*(F.lit(float(x)) for x in query))

    def top(cells: list[int]) -> DataFrame:
        scored = table.where(F.col("cell").isin(cells)).select("report_id", F.round(X.cosine(F.col("embedding"), literal), 6).alias("score"))
        return scored.where("score is not null").orderBy(F.desc("score"), "report_id").limit(k)

    best = [r.score for r in top(first).collect()]
    worst = best[-1] if len(best) == k else -2.0
    cells = sorted({*first, *(cell for bound, cell, _ in bounds if bound >= worst - ROUNDING)})
    return top(cells), sum(n for _, cell, n in bounds if cell in cells)
