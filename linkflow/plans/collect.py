"""One run's look at all sources at once: the access cascade, level by level, as tables.

Every level takes the sources that no level before has served: the configured feed (1), the
remembered feed (2), feed discovery (3), and the home page with a scorer (4). A page that cannot be
scored fails closed: only where the settings allow the heuristic, a forced browser is tried last (5).
What comes from outside (loads, a model's answers) is saved by ``keep(df, name)`` before
it is used, so nothing is asked twice and a retry sees what the first try saw.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow import schemas
from linkflow.operators import classify, diff, pages, remote
from linkflow.settings import Settings
from linkflow.sources import feeds, fetch

Keep = Callable[[DataFrame, str], DataFrame]


def keeper(path: str) -> Keep:
    """Saves tables below a folder that driver and executors share."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")

    return keep


@dataclass
class World:
    """What stands between a plan and the outside."""

    options: fetch.Options
    served: dict | None = None
    ask: remote.Ask | None = None


@dataclass
class Collected:
    """``items`` to normalise, ``attempts`` of the cascade, ``observed`` candidates, feed memory, and answers."""

    items: DataFrame
    attempts: DataFrame
    observed: DataFrame
    feeds: DataFrame
    answers: list[DataFrame]
    validators: DataFrame


def _attempt(df: DataFrame, level: int, method: Column, transport: Column, feed_url: Column, error: Column) -> DataFrame:
    return df.select(
        "source_id", F.lit(level).alias("level"), method.cast("string").alias("method"), transport.cast("string").alias("transport"),
        feed_url.cast("string").alias("feed_url"), error.cast("string").alias("error")
    )


def served_by(attempts: DataFrame) -> DataFrame:
    return attempts.where("error IS NULL").select("source_id").distinct()


def with_state(sources: DataFrame, state: dict[str, DataFrame], settings: Settings) -> DataFrame:
    """The sources with their state: defaults for new ones, ``baseline`` for those without a first run, ``verify`` for TLS."""
    seen = state["seen"].select("source_id").distinct().withColumn("has_seen", F.lit(True))
    out = sources.withColumnRenamed("id", "source_id").join(state["source_state"], "source_id", "left").join(seen, "source_id", "left")
    for c, v in (
        ("baseline_initialized", False), ("candidates_initialized", False), ("resolved_feed_url", ""), ("feed_fail_streak", 0),
        ("method", ""), ("last_ok_at", ""), ("has_seen", False)
    ):
        out = out.withColumn(c, F.coalesce(c, F.lit(v)))
    out = out.withColumn("baseline", ~(F.col("baseline_initialized") | (F.col("last_ok_at") != "") | F.col("has_seen"))).drop("has_seen")
    return out.withColumn("verify", fetch.verified(F.col("home_url"), settings.ssl_insecure_hosts, F.col("ssl_verify")))


def _feed_items(entries: DataFrame, chosen: DataFrame) -> DataFrame:
    rows = entries.join(chosen.select("source_id", "feed_url").distinct(), ["source_id", "feed_url"], "left_semi")
    return rows.select(
        "source_id", F.col("feed_url").alias("base"), "url", "title", "summary", "content_html", "published_at", "author",
        F.lit("rss").alias("via"), F.col("pos").cast("long").alias("pos")
    )


def feed_levels(src: DataFrame, known: DataFrame, keep: Keep, world: World, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Levels 1 to 3, for sources that may have a feed: attempts, items and loads. ``known`` are the validators of earlier loads."""
    able = src.where(F.col("collect_mode").isin("auto", "rss"))
    none = F.lit(None)
    one, entries1, loads1 = feeds.scan(
        able.where("rss_url != ''").select("source_id", F.col("rss_url").alias("feed_url"), "verify"), keep, "configured", world.options,
        world.served, known, limit
    )
    attempts = _attempt(one, 1, F.lit("rss"), F.lit("http"), F.col("feed_url"), F.col("error"))
    left = able.join(served_by(attempts), "source_id", "left_anti")
    two, entries2, loads2 = feeds.scan(
        left.where("resolved_feed_url != ''").select("source_id", F.col("resolved_feed_url").alias("feed_url"), "verify"), keep,
        "remembered", world.options, world.served, known, limit
    )
    attempts = attempts.unionByName(_attempt(two, 2, F.lit("rss"), F.lit("http"), F.col("feed_url"), F.col("error")))
    left = able.join(served_by(attempts), "source_id", "left_anti")
    found, entries3, loads3 = feeds.discover(left.select("source_id", "home_url", "verify"), keep, world.options, world.served, limit)
    found = keep(left.select("source_id").join(found, "source_id", "left"), "discovered")
    attempts = attempts.unionByName(_attempt(found, 3, F.lit("rss"), F.lit("http"), F.col("feed_url"), F.when(F.col("feed_url").isNull(), "no_feed").otherwise(none)))
    items = _feed_items(entries1, one.where("error IS NULL")).unionByName(_feed_items(entries2, two.where("error IS NULL")))
    items = items.unionByName(_feed_items(entries3, found.where("feed_url IS NOT NULL")))
    return keep(attempts, "feed-attempts"), items, reduce(DataFrame.unionByName, (loads1, loads2, loads3))


def feed_memory(src: DataFrame, attempts: DataFrame, limit: int) -> DataFrame:
    """``source_id, resolved_feed_url, feed_fail_streak`` after a run's feed attempts.

    A remembered feed that fails counts one more; at ``limit`` it is forgotten. One that works, or is
    discovered, is remembered with no failures. Discovery serves this run even while the old feed
    still counts, and its feed replaces it.
    """
    at = lambda level, c: F.max(F.when(F.col("level") == level, F.col(c)))
    got = attempts.groupBy("source_id").agg(at(2, "feed_url").alias("tried"), at(2, "error").alias("failure"), at(3, "feed_url").alias("found"))
    rows = src.select("source_id", "resolved_feed_url", "feed_fail_streak").join(got, "source_id", "left")
    failed = F.col("tried").isNotNull() & F.col("failure").isNotNull()
    streak = F.when(F.col("found").isNotNull(), 0).when(failed, F.col("feed_fail_streak") + 1).when(F.col("tried").isNotNull(), 0).otherwise(F.col("feed_fail_streak"))
    forget = failed & F.col("found").isNull() & (F.col("feed_fail_streak") + 1 >= limit)
    url = F.when(F.col("found").isNotNull(), F.col("found")).when(forget, "").otherwise(F.col("resolved_feed_url"))
    return rows.select("source_id", url.alias("resolved_feed_url"), F.when(forget, 0).otherwise(streak).cast("int").alias("feed_fail_streak"))


def page_level(src: DataFrame, level: int, known: DataFrame, keep: Keep, world: World, settings: Settings) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The home pages of ``src(..., first, fallback)`` with a scorer: attempts, candidates with ``selected``, answers.

    Outcomes: the load's error, ``no_candidates``, ``no_llm_key`` and ``llm_error`` (these two fall
    back to the heuristic only if the settings allow it); a baseline, and a page that has nothing
    new, are successes without a pick.
    """
    save = lambda df, name: keep(df, f"level{level}-{name}")
    wanted = src.select(F.col("home_url").alias("url"), "first", "fallback", "always", "verify")
    loads = save(fetch.pages(wanted, save, world.options, world.served), "pages").select(
        F.col("url").alias("home_url"), "transport", "final_url", "body", F.col("error").alias("load_error")
    )
    looked = src.select(
        "source_id", "home_url", "allowed_hosts", "strip_query_keys",
        (F.col("baseline") | ~F.col("candidates_initialized")).alias("baseline_only")
    ).join(loads, "home_url")
    shown = looked.where("load_error IS NULL").withColumn("url", F.col("final_url")).withColumnRenamed("body", "html")
    found = pages.candidates(pages.links(shown), page_key="source_id", page_url="url", limit=settings.page_candidates, hosts="allowed_hosts", extra="strip_query_keys")
    found = save(found.select("source_id", "pos", "link_url", "title", "context", "transport", "baseline_only"), "candidates")
    eligible = save(found.where("NOT baseline_only").join(known.select("source_id", F.col("url").alias("link_url")), ["source_id", "link_url"], "left_anti"), "eligible")
    answers: list[DataFrame] = []
    name = F.when(F.col("transport") == "browser", "browser_llm").otherwise("llm")
    if world.ask is None:
        failed = eligible.select("source_id").distinct().withColumn("score_error", F.lit("no_llm_key"))
        picks = eligible.limit(0).withColumn("via", F.lit(""))
    else:
        text = pages.excerpts(shown.select("source_id", "html"), settings.llm_excerpt_chars)
        picks, said = remote.article_picks(eligible, world.ask, page_key="source_id", limit=settings.page_candidates, excerpts=text, keep=save)
        answers.append(said)
        failed = said.where("error IS NOT NULL").select(F.col("page").alias("source_id"), F.col("error").alias("score_error"))
        picks = picks.withColumn("via", name)
    if settings.allow_heuristic:
        plain = F.when(F.lit(level) > 4, "browser_heuristic").otherwise("heuristic")
        own = pages.heuristic_picks(eligible.join(failed, "source_id", "left_semi"), page_key="source_id", limit=settings.heuristic_picks).drop("pick")
        picks = picks.unionByName(own.withColumn("via", plain))
        failed = failed.withColumn("by_rule", F.lit(True))
    else:
        failed = failed.withColumn("by_rule", F.lit(False))
    picks = save(picks.select("source_id", "link_url", "via"), "picks")
    n = found.groupBy("source_id").agg(F.count("*").alias("n"))
    outcome = looked.join(n, "source_id", "left").join(failed, "source_id", "left")
    by_rule = F.coalesce("by_rule", F.lit(False))
    error = F.when(F.col("load_error").isNotNull(), F.col("load_error")).when(F.coalesce("n", F.lit(0)) == 0, "no_candidates").when(~by_rule, F.col("score_error"))
    method = F.when(by_rule, "browser_heuristic" if level > 4 else "heuristic").otherwise(name)
    attempts = save(_attempt(outcome, level, method, F.col("transport"), F.lit(None), error), "attempts")
    seen = found.join(picks, ["source_id", "link_url"], "left").select(
        "source_id", "pos", F.col("link_url").alias("url"), "title", F.col("via").isNotNull().alias("selected"),
        F.col("via").alias("selector")
    )
    return attempts, seen, answers


def collect(sources: DataFrame, state: dict[str, DataFrame], keep: Keep, world: World, settings: Settings) -> Collected:
    """Runs the cascade over all (enabled) sources."""
    src = keep(with_state(sources, state, settings), "sources")
    attempts, items, loads = feed_levels(src, state["validators"], keep, world, settings.feed_max_items)
    memory = feed_memory(src, attempts, settings.feed_fail_streak)
    known = keep(diff.known_urls(state["seen"], state["candidates"]), "known")
    able = F.col("browser_fallback") | F.lit(settings.browser_auto)
    left = src.join(served_by(attempts), "source_id", "left_anti")
    by_browser = F.col("collect_mode") == "browser_llm"
    four = left.withColumn("first", F.when(by_browser, "browser").otherwise("http")).withColumn("fallback", able & ~by_browser)
    # A source that is known to need a browser gets one after any failure, others after a sign of a wall.
    four = four.withColumn("always", F.col("browser_fallback"))
    tries, observed, answers = page_level(four, 4, known, keep, world, settings)
    # The last level forces a browser where one is allowed and was not what failed.
    used = tries.where("transport = 'browser'").select("source_id")
    five = left.join(served_by(tries), "source_id", "left_anti").where("browser_fallback").join(used, "source_id", "left_anti")
    five = five.where(F.lit(settings.allow_heuristic)).withColumn("first", F.lit("browser")).withColumns({"fallback": F.lit(False), "always": F.lit(False)})
    more, seen, said = page_level(five, 5, known, keep, world, settings)
    attempts = keep(reduce(DataFrame.unionByName, (attempts, tries, more)), "attempts")
    # What a level has seen counts only where that level served the source.
    good = attempts.where("error IS NULL AND level >= 4").select("source_id", "level")
    observed = observed.withColumn("level", F.lit(4)).unionByName(seen.withColumn("level", F.lit(5))).join(good, ["source_id", "level"], "left_semi").drop("level")
    observed = keep(observed, "observed")
    home = src.select("source_id", F.col("home_url").alias("base"))
    none = F.lit(None).cast("string")
    picked = observed.where("selected").join(home, "source_id").select(
        "source_id", "base", "url", "title", F.lit("").alias("summary"), none.alias("content_html"), F.lit("").alias("published_at"),
        F.lit("").alias("author"), F.col("selector").alias("via"), F.col("pos").cast("long").alias("pos")
    )
    items = keep(items.unionByName(picked).select(*[c.split()[0] for c in schemas.ITEM.split(", ")]), "items")
    return Collected(items, attempts, observed, memory, [*answers, *said], fetch.validators(state["validators"], loads))


def outcomes(src: DataFrame, attempts: DataFrame) -> DataFrame:
    """Per source how it was served (``ok, via, transport``), or the errors of all levels."""
    got = diff.first_working(attempts)
    how = F.min_by(F.struct("transport"), F.when(F.col("error").isNull(), F.col("level"))).alias("how")
    got = got.join(attempts.groupBy("source_id").agg(how), "source_id")
    rows = src.select("source_id", "baseline").join(got, "source_id", "left")
    ok = F.col("method").isNotNull()
    return rows.select(
        "source_id", "baseline", ok.alias("ok"), F.coalesce("method", F.lit("")).alias("via"),
        F.coalesce("how.transport", F.lit("")).alias("transport"), F.when(~ok, F.coalesce("errors", F.lit("not_tried"))).alias("error")
    )


def choose_by(ask: remote.Ask) -> classify.Scorer:
    """A model as a scorer of candidates."""
    return lambda eligible: remote.article_picks(eligible, ask)[0]
