"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEST_SCRATCH = "/tmp/linkflow-scratch"


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path below the shared folder in ``spark.checkpoint.dir``.

    Where that setting is missing or empty, a local master (driver and executors are one process)
    gets a local folder that goes with the process; on a cluster this is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"{TEST_SCRATCH}/{spark.sparkContext.applicationId}"
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/linkflow/{tag}-{uuid.uuid4().hex}"


#: Spark's switch for removing a query's shuffle files as soon as the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def save(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """Cuts the lineage: writes ``df`` as Parquet to the shared folder and reads it back.

    The shuffle files behind it are of no more use, so Spark is told to remove them at once. With
    ``by``, rows lie in one folder for each value of that column.
    """
    spark = df.sparkSession
    path, before = scratch(spark, tag), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def release(df: DataFrame, part: str = "") -> None:
    """Deletes a saved table (or one folder of it) that nothing will read again."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{df.saved_at}/{part}" if part else df.saved_at)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _trim() -> None:
    """Gives memory that Python and Arrow hold free back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def trimmed(run):
    """A function over a partition's batches that leaves no free memory behind in the reused worker."""

    def wrapped(batches):
        _trim()
        yield from run(batches)
        _trim()

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of the id written as text; a null id counts as the empty string (crc 0)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (multiply and xor-shift), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; hashing is as quick as looking up, so nothing is remembered."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` consecutive word hashes; the whole sequence if it is shorter."""
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = (out ^ h[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mix64(out + np.uint64(n))


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def slices(texts: pa.Array, rows: int = 256):
    """Splits a column into pieces of few rows, so that Python strings of few documents exist at once."""
    for i in range(0, len(texts), rows):
        yield i, texts.slice(i, rows)
