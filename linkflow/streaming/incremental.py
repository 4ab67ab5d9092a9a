"""The change detection as a stream: micro-batches against state in parts, and as a stateful operator.

The URLs seen are a table in parts by source (``upsert.UpsertTable``): a batch reads and rewrites the
parts of its own sources and no others, and a batch that is repeated changes nothing. Output is named
by the batch id, so a batch that died half-way replaces its own rows. ``diff.emitted`` over all rows
gives the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow import schemas
from linkflow.operators import diff
from linkflow.settings import Settings
from linkflow.streaming.lifecycle import bucket
from linkflow.streaming.upsert import UpsertTable

#: Parts of the URLs seen.
PARTS = 64


def seen_table(spark: SparkSession, state_path: str) -> UpsertTable:
    return UpsertTable(spark, f"{state_path}/seen", schemas.SEEN)


def process(batch: DataFrame, batch_id: int, state_path: str, out_path: str, settings: Settings | None = None) -> None:
    """One micro-batch of ``observed(source_id, url, title, published_at)``.

    A source that has no row in the table has its first batch, which is its baseline.
    """
    now = f"{batch_id:012d}"
    rows = batch.groupBy("source_id", "url").agg(F.max("title").alias("title"), F.max("published_at").alias("published_at"))
    rows = rows.withColumn("part", bucket("source_id", PARTS)).persist()

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        ready = old.select("source_id").distinct()
        emitted = diff.new_urls(new, old).join(ready, "source_id", "left_semi").drop("part")
        emitted.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        none = F.lit(None).cast("string")
        marked = new.select("source_id", "url", "title", "published_at", none.alias("content_status"), none.alias("content_sha256"), none.alias("content_fetched_at"))
        return diff.update_seen(old.drop("part"), marked, now, settings).withColumn("part", bucket("source_id", PARTS))

    try:
        seen_table(batch.sparkSession, state_path).apply(rows, batch_id, merge)
    finally:
        rows.unpersist()


def start(stream: DataFrame, state_path: str, out_path: str, checkpoint: str, settings: Settings | None = None):
    """Runs all available input; state survives restarts."""
    run = lambda b, i: process(b, i, state_path, out_path, settings)
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stateful(stream: DataFrame, limit: int = Settings.seen_cap) -> DataFrame:
    """The same rule inside the stateful operator: per source the URLs seen, kept in RocksDB.

    A source's first batch sets the baseline and emits nothing. The newest ``limit`` URLs of a source
    stay (ties by URL), as in the batch form; an evicted URL that comes again is new again. A queue in
    the order of arrival says which one goes, so the map is never read as a whole.
    """
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor
    from pyspark.sql.types import StructType

    # Types are read here: workers have no session.
    url_type, place_type, own_type = StructType.fromDDL("url string"), StructType.fromDDL("place long"), StructType.fromDDL("head long, tail long")

    class Seen(StatefulProcessor):
        def init(self, handle) -> None:
            self.known = handle.getMapState("known", url_type, place_type)
            self.queue = handle.getMapState("queue", place_type, url_type)
            self.ends = handle.getValueState("ends", own_type)

        def handleInputRows(self, key, rows, timers):
            first = not self.ends.exists()
            head, tail = (0, 0) if first else self.ends.get()
            urls = {u for pdf in rows for u in pdf["url"].dropna().unique()}
            # Of one batch's URLs the greatest is the first to go.
            new = [u for u in sorted(urls, reverse=True) if not self.known.containsKey((u,))]
            for url in new:
                self.known.updateValue((url,), (tail,))
                self.queue.updateValue((tail,), (url,))
                tail += 1
            while tail - head > limit:
                self.known.removeKey(self.queue.getValue((head,)))
                self.queue.removeKey((head,))
                head += 1
            self.ends.update((head, tail))
            out = [] if first else new
            yield pd.DataFrame({"source_id": [key[0]] * len(out), "url": out}, dtype=object)

        def close(self) -> None:
            pass

    return stream.groupBy("source_id").transformWithStateInPandas(Seen(), outputStructType="source_id string, url string", outputMode="Append", timeMode="None")


def all_output(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "false").parquet(out_path)
