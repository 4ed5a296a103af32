"""Spark helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a side that may be broadcast. Every caller measures the side first
#: and has another way for a larger one.
BROADCAST_BYTES = 48 << 20


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage: spark.checkpoint.dir.

    A local session without that setting (tests) gets a local folder; on a
    cluster executors would write to disks of their own, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="threatlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back.

    The copy is replicated by the file system, so losing an executor loses
    nothing, and what nondeterminism df has is fixed from here on. release() deletes it.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/threatlake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables of materialize() that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of df's size, from file sizes; nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def column_named(df: DataFrame, name: str) -> str | None:
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def kept_fields(schema: T.StructType, new: T.StructType) -> list[T.StructField]:
    """Fields of schema that new doesn't replace; names compare without case, as in Spark."""
    names = {f.name.lower() for f in new}
    return [f for f in schema if f.name.lower() not in names]


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that df doesn't have, in any case."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def set_aside(df: DataFrame, *own: str) -> tuple[DataFrame, dict[str, str]]:
    """df with other names for columns that are called like an operator's own, and those names (new to old) for put_back()."""
    aside = {}
    for c in df.columns:
        if c.lower() in own:
            new = unused(df, f"{c}_aside")
            df, aside = df.withColumnRenamed(c, new), aside | {new: c}
    return df, aside


def put_back(df: DataFrame, aside: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(aside) if aside else df


def give_back() -> None:
    """Returns freed memory to the system. A Python worker lives on between tasks and would keep the most that any of them took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def map_columns(df: DataFrame, fn: Callable[[], Callable[[pa.RecordBatch], list]], new: str | T.StructType) -> DataFrame:
    """df with the columns `new`, made batch by batch; they replace any of the same names.

    fn is called once in each task and returns the function of a record batch.
    """
    fields = T._parse_datatype_string(new) if isinstance(new, str) else new
    kept = kept_fields(df.schema, fields)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = fn()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names] + step(batch), names=names + fields.names)
            del batch
            give_back()

    return df.mapInArrow(run, T.StructType(kept + list(fields.fields)))


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    got = batch.column(batch.schema.get_field_index(name))
    return got.combine_chunks() if isinstance(got, pa.ChunkedArray) else got


def block_count(df: DataFrame, target: int, least: int = 8, most: int = 1 << 20) -> int:
    """How many blocks of about `target` bytes of Parquet the input makes.

    A join's estimate can be its sides' product, so the files that df reads bound it.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    files = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return max(least, min(most, -(-min(plan_bytes(df), files) // target)))


def blocked(docs: DataFrame, count: int, *keys: str) -> DataFrame:
    """docs with __blk, a number below count by a hash of the keys and the text."""
    return docs.withColumn("__blk", F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int"))
