"""What a source's access remembers, as a stream with state: failures in a row, the feed that works, the way that served it.

One value of state a source. ``diff.fail_streak`` and ``diff.resolved_feed`` over all attempts give
the same rows. In a query that keeps running, a feed that is forgotten gets a timer: when it goes
off, a row of the kind ``retry`` asks for discovery, unless another feed has worked meanwhile. A query
over all available input has no timers: with them it would go on with empty batches for ever.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.settings import Settings
from linkflow.streaming import state
from linkflow.streaming.upsert import UpsertTable

OUT = "source_id string, kind string, pos long, streak long, forget boolean, resolved string, method string"
#: How long a forgotten feed rests, in a query that keeps running.
RETRY_MS = 6 * 3600 * 1000


def attempts(stream: DataFrame, limit: int = Settings.feed_fail_streak, retry_ms: int | None = None) -> DataFrame:
    """``attempts(source_id, pos, ok, feed_url, method)`` in order of ``pos``, each with the state after it."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor
    from pyspark.sql.types import StructType

    names = [c.split()[0] for c in OUT.split(", ")]
    # Read here: workers have no session.
    own_type = StructType.fromDDL("streak long, resolved string, method string, pos long")

    class Access(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.own = handle.getValueState("own", own_type)

        def handleInputRows(self, key, rows, timers):
            parts = list(rows)
            pdf = (pd.concat(parts) if len(parts) > 1 else parts[0]).sort_values("pos")
            streak, resolved, method, pos = self.own.get() if self.own.exists() else (0, None, "", -1)
            out = []
            for r in pdf.itertuples(index=False):
                pos = int(r.pos)
                if r.ok:
                    streak, resolved, method = 0, r.feed_url, r.method
                else:
                    streak += 1
                forget = streak >= limit
                if streak == limit and retry_ms is not None:
                    self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + retry_ms)
                out.append((key[0], "attempt", pos, streak, forget, None if forget else resolved, method))
            self.own.update((streak, resolved, method, pos))
            yield pd.DataFrame(out, columns=names)

        def handleExpiredTimer(self, key, timers, expired):
            streak, _, method, pos = self.own.get()
            out = [(key[0], "retry", pos, streak, True, None, method)] if streak >= limit else []
            yield pd.DataFrame(out, columns=names)

        def close(self) -> None:
            pass

    return stream.groupBy("source_id").transformWithStateInPandas(Access(), outputStructType=OUT, outputMode="Append", timeMode="None" if retry_ms is None else "ProcessingTime")


def table(spark, path: str) -> UpsertTable:
    return UpsertTable(spark, path, OUT, "batch")


def start(stream: DataFrame, path: str, checkpoint: str, limit: int = Settings.feed_fail_streak):
    """Adds each batch's rows as a part of its own; a batch that is repeated adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch", F.lit(f"n{batch_id:012d}")).persist()
        try:
            table(batch.sparkSession, path).apply(rows, batch_id, lambda _, new: new)
        finally:
            rows.unpersist()

    return state.changes_into(attempts(stream, limit), write, checkpoint, "append")
