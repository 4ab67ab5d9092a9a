"""The day's bundle as an upsert of a stream of published articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.functions.dates import beijing_date
from linkflow.operators import articles
from linkflow.streaming.upsert import UpsertTable


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def table(spark: SparkSession, path: str, schema: str) -> UpsertTable:
    """Articles of ``schema`` (which holds external_id and pos) by publishing day."""
    return UpsertTable(spark, path, schema, "day")


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """A day's articles after a batch: new ones win, each at the place of its first record (a day's ``pos``).

    ``pos`` of the batch counts on from the greatest of the day.
    """
    last = old.groupBy("day").agg(F.max("pos").alias("last"))
    new = new.join(last, "day", "left").withColumn("pos", F.col("pos") + F.coalesce(F.col("last") + 1, F.lit(0))).drop("last")
    both = old.unionByName(new.select(*old.columns)).where("coalesce(external_id, '') != ''")
    return articles.upsert(both, ["day", "external_id"], "pos").select(*old.columns)


def start(stream: DataFrame, path: str, checkpoint: str, collected_at: str = "collected_at"):
    """Upserts articles into their days' bundles; a batch that comes twice, or dies half-way, counts once."""
    schema = ddl(stream)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("day", beijing_date(F.to_timestamp(collected_at))).persist()
        try:
            table(batch.sparkSession, path, schema).apply(rows, batch_id, merge)
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
