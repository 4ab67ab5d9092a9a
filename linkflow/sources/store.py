"""State snapshots and the monthly archive, as tables on any Hadoop file system.

URLs seen and candidates lie in buckets of their source, sorted, so that the joins of a run work bucket
by bucket: what is observed is dealt to the buckets, and the growing state is joined as it lies. The
next snapshot is dealt once, as its limits by source need it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from linkflow import schemas
from linkflow.operators.publish import write_text

TABLES = {"source_state": schemas.SOURCE_STATE, "seen": schemas.SEEN, "candidates": schemas.CANDIDATE_STATE, "validators": schemas.VALIDATORS}


#: Tables in buckets, and how many.
BUCKETED, BUCKETS = ("seen", "candidates"), 16
#: Spark's switch that lets tables that are dealt by the source join on source and URL as they lie.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def _table_name(path: str) -> str:
    return f"linkflow_{hashlib.md5(path.encode()).hexdigest()}"


def write_buckets(df: DataFrame, path: str) -> None:
    """Writes ``df(source_id, url, ...)`` in buckets of the source, each one file."""
    rows = df.repartition(BUCKETS, "source_id")
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    rows.write.mode("overwrite").format("parquet").bucketBy(BUCKETS, "source_id").sortBy("source_id", "url").option("path", path).saveAsTable(_table_name(path))


def read_buckets(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that ``write_buckets`` has written, in this session or another."""
    spark.conf.set(ALL_KEYS, "false")
    layout = f"USING parquet CLUSTERED BY (source_id) SORTED BY (source_id, url) INTO {BUCKETS} BUCKETS LOCATION '{path}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_table_name(path)} ({schema}) {layout}")
    return spark.table(_table_name(path))


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions: those whose last written table has been committed."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    out = []
    for s in fs.listStatus(at):
        name = s.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "source_state/_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def load_state(spark: SparkSession, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """The newest (or given) snapshot's tables, empty ones if there is none."""
    have = _versions(spark, path)
    v = version if version is not None else (have[-1] if have else None)
    if v is None or v not in have:
        return {t: spark.createDataFrame([], s) for t, s in TABLES.items()}
    # A snapshot of an earlier version has no validators.
    def read(t: str, schema: str) -> DataFrame:
        at = f"{path}/v={v}/{t}"
        if not _exists(spark, at):
            return spark.createDataFrame([], schema)
        # So has one whose tables are not in buckets: it is read as it is.
        return read_buckets(spark, at, schema) if _exists(spark, f"{path}/v={v}/buckets-{t}") else spark.read.schema(schema).parquet(at)

    return {t: read(t, s) for t, s in TABLES.items()}


def save_state(tables: dict[str, DataFrame], path: str, version: int) -> None:
    """Writes a snapshot beside the older ones; ``source_state`` goes last and completes it.

    Writing a version again replaces it, so a rerun after a crash does no harm.
    """
    for t in ("seen", "candidates", "validators", "source_state"):
        if t in BUCKETED:
            write_buckets(tables[t], f"{path}/v={version}/{t}")
            write_text(tables[t].sparkSession, f"{path}/v={version}/buckets-{t}", str(BUCKETS))
        elif t in tables:
            tables[t].write.mode("overwrite").parquet(f"{path}/v={version}/{t}")


def next_version(spark: SparkSession, path: str) -> int:
    """The number of the next snapshot: one more than the newest complete one."""
    return max(_versions(spark, path), default=0) + 1


def append_archive(articles: DataFrame, path: str, run_id: str) -> None:
    """Appends a run's articles by month; running it again replaces the run's own files."""
    rows = articles.withColumn("month", F.substring("collected_at", 1, 7)).withColumn("run_id", F.lit(run_id))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "run_id").json(path)


def read_archive(spark: SparkSession, path: str, month: str, schema: StructType) -> DataFrame:
    """A month's records in the order of runs; lines that are no JSON go. Other months are not read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/month={month}")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], StructType([*schema.fields, StructField("run_id", StringType())]))
    # Only this month's folder is listed. A version with leading zeros sorts as text.
    return spark.read.schema(StructType([*schema.fields, StructField("run_id", StringType())])).option("mode", "DROPMALFORMED").json(f"{path}/month={month}")
