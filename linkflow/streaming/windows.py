"""Counts by the publishing day as a stream: UTC+8 days over event time, updated by late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.functions.dates import beijing_date
from linkflow.streaming.upsert import UpsertTable, newest_wins

DAY = "day string, n long"


def day_counts(stream: DataFrame, ts: str = "ts") -> DataFrame:
    """``day, n`` of a stream of rows with a time. A day of UTC+8 starts at 16:00 UTC.

    There is no watermark: a row counts whenever it comes, and the state is one number a day.
    """
    # Days are cut from 1970-01-01T00:00 UTC on; the offset moves the cut to the publishing day's start.
    w = F.window(F.col(ts), "1 day", "1 day", "16 hours")
    return stream.groupBy(w).agg(F.count("*").alias("n")).select(beijing_date(F.col("window.start")).alias("day"), "n")


def start(stream: DataFrame, path: str, checkpoint: str, ts: str = "ts"):
    """Keeps the counts of all days in a table of one part a month; runs all available input."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("part", F.substring("day", 1, 7)).persist()
        try:
            # A count only grows, so the greater one is the newer one.
            table(batch.sparkSession, path).apply(rows, batch_id, newest_wins(["part", "day"], "n"))
        finally:
            rows.unpersist()

    return day_counts(stream, ts).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def table(spark, path: str) -> UpsertTable:
    return UpsertTable(spark, path, DAY)
