"""What is new: comparing observations with bounded per-source state.

Two forms that agree: ``step`` takes one run and the state before it (the incremental form, also
used per micro-batch), and ``emitted`` / ``fold_candidates`` work out all runs at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkflow.settings import Settings


def new_urls(observed: DataFrame, seen: DataFrame, keys: tuple[str, ...] = ("source_id", "url")) -> DataFrame:
    return observed.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def known_urls(seen: DataFrame, candidates: DataFrame) -> DataFrame:
    return seen.select("source_id", "url").union(candidates.select("source_id", "url")).distinct()


def not_baseline(articles: DataFrame, candidates: DataFrame) -> DataFrame:
    """Drops articles that the first look at a page had already listed."""
    return articles.join(candidates.where("baseline").select("source_id", "url").distinct(), ["source_id", "url"], "left_anti")


def emitted(observed: DataFrame, run: str = "run") -> DataFrame:
    """All runs at once: a URL is emitted in its first run, unless that is its source's first run.

    Two aggregates and one join on the source; no window over all of a source's observations.
    """
    first = observed.groupBy("source_id", "url").agg(F.min(run).alias("first_seen"))
    start = first.groupBy("source_id").agg(F.min("first_seen").alias("first_ok"))
    return first.join(start, "source_id").where("first_seen > first_ok").select("source_id", "url", F.col("first_seen").alias(run))


def fold_candidates(observed: DataFrame, run: str = "run") -> DataFrame:
    """Candidate state after all runs of ``observed(source_id, url, run, title, selected)``."""
    per = observed.groupBy("source_id", "url").agg(
        F.min(run).alias("first_seen"), F.max(run).alias("last_seen"), F.max_by("title", run).alias("title"), F.bool_or("selected").alias("selected"), F.max(F.when(F.col("selected"), F.col(run))).alias("last_selected")
    )
    start = per.groupBy("source_id").agg(F.min("first_seen").alias("first_ok"))
    return per.join(start, "source_id").withColumn("baseline", F.col("first_seen") == F.col("first_ok")).drop("first_ok")


def cap(state: DataFrame, order: str, limit: int, key: str = "source_id") -> DataFrame:
    """The newest rows of each key; ties by URL. Spark prunes by group before the shuffle."""
    w = Window.partitionBy(key).orderBy(F.desc(order), "url")
    return state.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= limit).drop("nth")


def update_candidates(state: DataFrame, observed: DataFrame, now: str, initialized: DataFrame, seen: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Candidate state after one page look: ``observed(source_id, url, title, selected, selector)``.

    A URL is baseline if its source's candidates were not initialised, or it was seen before.
    """
    s = settings or Settings()
    old = state.select(
        "source_id", "url",
        *[F.col(c).alias(f"old_{c}") for c in ("title", "first_seen", "last_seen", "baseline", "selected", "last_selected", "selector")]
    )
    rows = observed.join(old, ["source_id", "url"], "full_outer")
    rows = rows.join(initialized.select("source_id", F.lit(True).alias("ready")), "source_id", "left").join(
        seen.select("source_id", "url", F.lit(True).alias("was_seen")).distinct(), ["source_id", "url"], "left"
    )
    fresh = F.col("old_first_seen").isNull()
    now_seen = F.col("selected").isNotNull()
    chosen = F.coalesce("selected", F.lit(False))
    out = rows.select(
        "source_id", "url", F.coalesce(F.nullif("title", F.lit("")), "old_title").alias("title"),
        F.coalesce("old_first_seen", F.lit(now)).alias("first_seen"), F.when(now_seen, F.lit(now)).otherwise(F.col("old_last_seen")).alias("last_seen"),
        F.when(fresh, F.col("ready").isNull() | F.col("was_seen").isNotNull()).otherwise(F.col("old_baseline")).alias("baseline"), (chosen | F.coalesce("old_selected", F.lit(False))).alias("selected"),
        F.when(chosen, F.lit(now)).otherwise(F.col("old_last_selected")).alias("last_selected"), F.when(chosen, F.col("selector")).otherwise(F.col("old_selector")).alias("selector"),
    )
    return cap(out, "last_seen", s.candidate_cap)


def update_seen(
    seen: DataFrame, articles: DataFrame, now: str, settings: Settings | None = None, keys: tuple[str, ...] = ("source_id", "url")
) -> DataFrame:
    """Inserts new URLs and refreshes content columns of known ones.

    Both the observed and the final URL of a redirected article count as seen. Rows of equal ``keys``
    (the source, the URL and what else tells articles apart) are one article.
    """
    s = settings or Settings()
    rows = articles
    if "observed_url" in articles.columns:
        rows = articles.unionByName(articles.where("observed_url != url").withColumn("url", F.col("observed_url")))
    cols = ["title", "published_at", "content_status", "content_sha256", "content_fetched_at"]
    # The values of one row: one with content if there is any, the last read of those.
    best = F.max_by(F.struct(*cols), F.struct(F.col("content_status").isNotNull(), F.coalesce("content_fetched_at", F.lit("")), F.coalesce("title", F.lit(""))))
    rows = rows.groupBy(*keys).agg(best.alias("new")).select(*keys, *[F.col(f"new.{c}").alias(f"new_{c}") for c in cols])
    both = seen.join(rows, list(keys), "full_outer")
    out = both.select(
        *keys, F.coalesce("title", "new_title").alias("title"), F.coalesce("first_seen", F.lit(now)).alias("first_seen"),
        F.coalesce("published_at", "new_published_at").alias("published_at"), *[F.coalesce(f"new_{c}", c).alias(c) for c in cols[2:]]
    )
    return cap(out, "first_seen", s.seen_cap)


def step(observed: DataFrame, seen: DataFrame, state: DataFrame) -> DataFrame:
    """One run: new URLs of sources that have had their first run. ``state(source_id, baseline_initialized)``."""
    ready = state.where("baseline_initialized").select("source_id")
    return new_urls(observed, seen).join(ready, "source_id", "left_semi")


def fail_streak(attempts: DataFrame, run: str = "run", limit: int = Settings.feed_fail_streak) -> DataFrame:
    """Failures in a row up to each attempt of ``attempts(source_id, run, ok)``, and whether the feed is forgotten."""
    w = Window.partitionBy("source_id").orderBy(run)
    island = attempts.withColumn("island", F.sum(F.col("ok").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy("source_id", "island").orderBy(run).rowsBetween(Window.unboundedPreceding, 0)
    return island.withColumn("streak", F.sum((~F.col("ok")).cast("int")).over(own)).withColumn("forget", F.col("streak") >= limit).drop("island")


def resolved_feed(attempts: DataFrame, run: str = "run", limit: int = Settings.feed_fail_streak) -> DataFrame:
    """The remembered feed after each attempt of ``attempts(source_id, run, ok, feed_url)``, and the streak of failures.

    It is the last feed that worked; after ``limit`` failures in a row it is forgotten (null) until
    another works, so that discovery starts again.
    """
    w = Window.partitionBy("source_id").orderBy(run).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("ok"), F.col("feed_url")), ignorenulls=True).over(w)
    return fail_streak(attempts, run, limit).withColumn("resolved", F.when(~F.col("forget"), last))


def first_working(attempts: DataFrame) -> DataFrame:
    """The access cascade: the first level of each source that worked, or the joined errors."""
    ok = F.coalesce("error", F.lit("")) == ""
    notes = F.array_sort(F.collect_list(F.when(~ok, F.struct("level", "error"))))
    return attempts.groupBy("source_id").agg(
        F.min_by("method", F.when(ok, F.col("level"))).alias("method"),
        F.array_join(F.transform(notes, lambda x: x["error"]), "; ").alias("errors")
    )
