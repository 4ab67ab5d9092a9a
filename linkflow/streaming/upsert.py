"""An idempotent upsert for ``foreachBatch``: a table in parts, with a transaction log by batch.

A batch rewrites only the parts that it touches, each into a folder of its own number, and then adds
one entry to the log, which names them. A reader takes every part in its newest logged form, so
folders of a batch that died before its entry are not seen. A batch whose number is in the log is
done: running it again changes nothing. Entries are created whole (written beside and renamed).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.operators.publish import write_text
from linkflow.sources import store

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class UpsertTable:
    """Rows of ``schema`` below ``path``, in parts by the text column ``part`` (which is not in ``schema``)."""

    def __init__(self, spark: SparkSession, path: str, schema: str, part: str = "part"):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part
        self.schema = spark.createDataFrame([], schema).schema

    def _entries(self) -> dict[int, list[str]]:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/log")
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return {}
        out = {}
        for s in fs.listStatus(at):
            name = s.getPath().getName()
            if name.endswith(".json"):
                raw = self.spark._jvm.org.apache.hadoop.fs.FileSystem.get(at.toUri(), self.spark._jsc.hadoopConfiguration()).open(s.getPath())
                try:
                    out[int(name[:-5])] = json.loads(bytes(raw.readAllBytes()).decode())
                finally:
                    raw.close()
        return out

    def _newest(self) -> dict[str, int]:
        newest: dict[str, int] = {}
        for batch, parts in sorted(self._entries().items()):
            newest |= dict.fromkeys(parts, batch)
        return newest

    def _folder(self, part: str, batch: int) -> str:
        return f"{self.path}/data/{part}/b={batch:012d}"

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """The rows of all (or the given) parts, with their part."""
        newest = self._newest()
        paths = [(p, self._folder(p, b)) for p, b in sorted(newest.items()) if parts is None or p in parts]
        if not paths:
            return self.spark.createDataFrame([], self.schema).withColumn(self.part, F.lit(""))
        rows = self.spark.read.schema(self.schema).parquet(*[at for _, at in paths])
        return rows.withColumn(self.part, F.regexp_extract(F.col("_metadata.file_path"), r"/data/([^/]+)/b=\d+/[^/]*$", 1))

    def apply(self, batch: DataFrame, batch_id: int, merge: Merge) -> bool:
        """Merges a batch (rows and their part) into the touched parts; False if the log has its number already.

        ``merge(old, new)`` gets the touched parts' rows and the batch's, both with their part, and
        gives the rows that these parts hold from now on.
        """
        if batch_id in self._entries():
            return False
        touched = sorted(r[0] for r in batch.select(self.part).distinct().collect())
        if touched:
            # The new rows are written once, in folders by part, and moved to their places.
            columns = [f.name for f in self.schema]
            staged = f"{self.path}/staged/b={batch_id:012d}"
            merge(self.read(touched), batch).select(*columns, self.part).write.mode("overwrite").partitionBy(self.part).parquet(staged)
            for part in touched:
                self._move(f"{staged}/{self.part}={part}", self._folder(part, batch_id))
            store.delete(self.spark, staged)
        write_text(self.spark, f"{self.path}/log/{batch_id:012d}.json", json.dumps(touched))
        return True

    def _move(self, source: str, target: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        at, to = path(source), path(target)
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.delete(to, True)
        fs.mkdirs(to.getParent())
        if fs.exists(at):
            if not fs.rename(at, to):
                raise OSError(f"cannot write {target}")
        else:
            # A part that has lost its last row.
            self.spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(target)


def newest_wins(keys: list[str], order: str) -> Merge:
    """Of rows with equal keys the one with the greatest ``order``; of equal ones, the batch's."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.withColumn("batch_side", F.lit(0)).unionByName(new.select(*old.columns).withColumn("batch_side", F.lit(1)))
        values = [c for c in old.columns if c not in keys]
        best = both.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(order, "batch_side")).alias("best"))
        return best.select(*keys, *[F.col(f"best.{c}").alias(c) for c in values])

    return merge
