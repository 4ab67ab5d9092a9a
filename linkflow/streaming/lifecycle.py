"""The life of candidates as a stream with state: per source, which links its page has shown and when.

State of a source, in RocksDB: a map of its candidates by URL; a queue of (place, URL) in the order
of their last look, with the places of its two ends; whether its first look is over. A look appends
to the queue and leaves the URL's older entry behind; an entry counts only if it is the one that the
map names. So eviction takes from the front of the queue what it needs, in constant time a URL, and
never sorts or reads the whole map. State starts from the tables of a snapshot.

``diff.fold_candidates`` over all runs, and ``diff.update_candidates`` run by run, give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.settings import Settings
from linkflow.streaming import state
from linkflow.streaming.upsert import UpsertTable

_CANDIDATE = "title string, first_seen long, last_seen long, baseline boolean, selected boolean, last_selected long"
OUT = f"source_id string, url string, {_CANDIDATE}, evicted boolean"
#: Rows of a snapshot: candidates (kind c) and URLs of articles that were seen (kind s).
INITIAL = f"source_id string, kind string, url string, {_CANDIDATE}"


def initial_rows(candidates: DataFrame, seen: DataFrame, ready: DataFrame) -> DataFrame:
    """The state's tables as ``INITIAL``: ``candidates(source_id, url, ...)``, ``seen(source_id, url)``, ``ready(source_id)``."""
    names = [c.split()[0] for c in _CANDIDATE.split(", ")]
    none = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in _CANDIDATE.split(", ")]
    rows = candidates.select("source_id", F.lit("c").alias("kind"), "url", *names)
    rows = rows.unionByName(seen.select("source_id", F.lit("s").alias("kind"), "url", *none))
    return rows.unionByName(ready.select("source_id", F.lit("r").alias("kind"), F.lit("").alias("url"), *none))


def candidates(stream: DataFrame, limit: int = Settings.candidate_cap, initial: DataFrame | None = None) -> DataFrame:
    """``observed(source_id, run, url, title, selected)`` as the changes ``OUT`` of each batch.

    A row says how a candidate stands after the batch, or that it has left (``evicted``). A URL is
    baseline if its source's first look shows it, or if it was seen as an article before.
    """
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor
    from pyspark.sql.types import StructType

    # Types are read here: workers have no session.
    url_type, place_type, seen_type = StructType.fromDDL("url string"), StructType.fromDDL("place long"), StructType.fromDDL("at long")
    known_type, ends_type = StructType.fromDDL(f"place long, {_CANDIDATE}"), StructType.fromDDL("head long, tail long, size long, ready boolean")

    class Life(StatefulProcessor):
        def init(self, handle) -> None:
            self.known = handle.getMapState("known", url_type, known_type)
            self.seen = handle.getMapState("seen", url_type, seen_type)
            self.queue = handle.getMapState("queue", place_type, url_type)
            #: The queue's first and next place, the number of candidates, whether a first look is over.
            self.ends = handle.getValueState("ends", ends_type)

        def _push(self, url: str, values: tuple, tail: int) -> None:
            self.queue.updateValue((tail,), (url,))
            self.known.updateValue((url,), (tail, *values))

        def handleInitialState(self, key, rows, timers) -> None:
            held = rows[rows.kind == "c"].sort_values(["last_seen", "url"], ascending=[True, False])
            tail = 0
            for r in held.itertuples(index=False):
                last = None if pd.isna(r.last_selected) else int(r.last_selected)
                self._push(r.url, (r.title, int(r.first_seen), int(r.last_seen), bool(r.baseline), bool(r.selected), last), tail)
                tail += 1
            for url in rows[rows.kind == "s"].url:
                self.seen.updateValue((url,), (0,))
            self.ends.update((0, tail, tail, bool((rows.kind == "r").any() or tail)))

        def handleInputRows(self, key, rows, timers):
            parts = list(rows)
            pdf = pd.concat(parts) if len(parts) > 1 else parts[0]
            head, tail, size, ready = self.ends.get() if self.ends.exists() else (0, 0, 0, False)
            changed: dict[str, tuple | None] = {}
            for run, look in pdf.groupby("run"):
                # One row a URL: the last title, selected if any row says so; the greatest URL is first to go.
                look = look.sort_values("title").groupby("url").agg(title=("title", "last"), selected=("selected", "any")).sort_index(ascending=False)
                run = int(run)
                for url, title, selected in zip(look.index, look.title, look.selected, strict=True):
                    if self.known.containsKey((url,)):
                        _, old_title, first, _, baseline, chosen, last = self.known.getValue((url,))
                    else:
                        old_title, first, chosen, last = "", run, False, None
                        baseline = not ready or self.seen.containsKey((url,))
                        size += 1
                    values = (title or old_title, first, run, bool(baseline), bool(chosen or selected), run if selected else last)
                    self._push(url, values, tail)
                    tail += 1
                    changed[url] = values
                ready = True
                while size > limit:
                    (url,) = self.queue.getValue((head,))
                    if self.known.containsKey((url,)) and self.known.getValue((url,))[0] == head:
                        self.known.removeKey((url,))
                        size -= 1
                        changed[url] = None
                    self.queue.removeKey((head,))
                    head += 1
            # What is left behind at the front is of no more use.
            while head < tail:
                (url,) = self.queue.getValue((head,))
                if self.known.containsKey((url,)) and self.known.getValue((url,))[0] == head:
                    break
                self.queue.removeKey((head,))
                head += 1
            self.ends.update((head, tail, size, ready))
            none = ("", 0, 0, False, False, None)
            out = [(key[0], url, *(values or none), values is None) for url, values in changed.items()]
            pdf = pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])
            yield pdf.astype({"last_selected": "Int64"})

        def close(self) -> None:
            pass

    start = None if initial is None else initial.groupBy("source_id")
    return stream.groupBy("source_id").transformWithStateInPandas(Life(), outputStructType=OUT, outputMode="Update", timeMode="None", initialState=start)


#: Parts of the table that the changes are merged into.
BUCKETS = 16


def bucket(column: str = "source_id", n: int = BUCKETS):
    return F.concat(F.lit("s"), F.pmod(F.xxhash64(column), F.lit(n)).cast("string"))


def table(spark, path: str) -> UpsertTable:
    return UpsertTable(spark, path, f"{OUT}, batch long")


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """The candidates after a batch of changes: the newest row of each, without those that have left."""
    both = old.unionByName(new.select(*old.columns))
    values = [c for c in old.columns if c not in ("source_id", "url")]
    rows = both.groupBy("source_id", "url").agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return rows.select("source_id", "url", *[F.col(f"last.{c}").alias(c) for c in values]).where("NOT evicted")


def start(stream: DataFrame, path: str, checkpoint: str, limit: int = Settings.candidate_cap, initial: DataFrame | None = None):
    """Runs all available input into the table at ``path``; a batch that is repeated changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch", F.lit(batch_id).cast("long")).withColumn("part", bucket())
        # The batch is read once for its parts and once for its rows.
        rows.persist()
        try:
            table(batch.sparkSession, path).apply(rows, batch_id, merged)
        finally:
            rows.unpersist()

    return state.changes_into(candidates(stream, limit, initial), write, checkpoint)
