"""The daily run from configuration to published documents, and the source commands.

``python -m linkflow.plans.daily run CONFIG STATE OUT [--served FILE]`` looks at all enabled sources
once and publishes; it ends with 1 if the settings are strict and a source failed.
``python -m linkflow.plans.daily sources list|validate|check CONFIG [ID...]`` shows a configuration,
checks its rules, or tries the sources. Settings come from ``LINKFLOW_*`` variables.
"""

from __future__ import annotations

import json
import sys
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from linkflow.operators import articles, diff, pages, publish, remote
from linkflow.plans import collect
from linkflow.plans.collect import Keep, World
from linkflow.settings import Settings
from linkflow.sources import config, feeds, fetch, store

#: Version of the producer, as bundles name it.
VERSION = "2"
_CONTENT = ("content_status", "content_sha256", "content_fetched_at")


def detect(items: DataFrame, src: DataFrame, state: dict[str, DataFrame], settings: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """All normalised articles of a run, once each per source, and those that are emitted.

    New is what the source's state has not seen; of pages, also what their first look did not list.
    A source's first run is its baseline and emits nothing.
    """
    rows = articles.normalize(items, src.withColumnRenamed("source_id", "id"), settings)
    rows = articles.upsert(rows, ["source_id", "external_id"], "pos")
    new = diff.new_urls(rows, state["seen"])
    new = new.where("via = 'rss'").unionByName(diff.not_baseline(new.where("via != 'rss'"), state["candidates"]).select(*new.columns))
    return rows, new.join(src.where("baseline").select("source_id"), "source_id", "left_anti")


def probed(new: DataFrame, src: DataFrame, keep: Keep, world: World, settings: Settings) -> DataFrame:
    """New articles that can be reached; gone ones go, redirects within the site are followed."""
    if not settings.probe_new_urls:
        return articles.apply_probe(new, new.limit(0), enabled=False).withColumn("observed_url", F.col("url"))
    asked = new.join(src.select("source_id", "verify"), "source_id").withColumn("transport", F.lit("probe"))
    answers = keep(fetch.load(asked, world.options, world.served), "probes")
    return articles.apply_probe(new, answers.select("url", F.col("status").alias("code"), "final_url"))


def with_content(new: DataFrame, src: DataFrame, now: str, keep: Keep, world: World, settings: Settings, answers: list[DataFrame]) -> DataFrame:
    """Articles with their content: the feed's own text, else the page by each transport in order. What a model said is added to ``answers``."""
    text = lambda df, column, to: pages.texts(df, column, settings.content_max_chars).withColumnRenamed("content", to).drop("method")
    rows = new.withColumn("source_html", F.col("content_html")).withColumn("source_summary", F.col("summary"))
    rows = keep(text(text(rows, "source_html", "rss_text"), "source_summary", "summary_text"), "texts")
    enough = max(settings.content_min_chars, settings.content_rss_min_chars)
    site = src.select("source_id", F.col("browser_fallback").alias("able"), "verify", "allowed_hosts")
    todo = rows.where(F.char_length("rss_text") < enough).join(site, "source_id")
    todo = todo.select(
        *articles.ARTICLE, "url", "home_url", "allowed_hosts", "title", "verify",
        F.posexplode(articles.transports(F.col("collect_mode"), F.col("able"))).alias("attempt", "transport")
    )
    attempts = None
    # The second transport is tried for what the first did not read; there are two at most.
    for turn in (0, 1):
        asked = todo.where(F.col("attempt") == turn)
        if attempts is not None:
            good = attempts.where((F.coalesce("error", F.lit("")) == "") & (F.char_length("text") >= settings.content_min_chars))
            asked = asked.join(good.select(*articles.ARTICLE), list(articles.ARTICLE), "left_anti")
        got = _read_pages(asked, f"content{turn}", keep, world, settings, answers)
        attempts = got if attempts is None else attempts.unionByName(got)
    return articles.enrich(rows, attempts, now, settings)


def _read_pages(asked: DataFrame, name: str, keep: Keep, world: World, settings: Settings, answers: list[DataFrame]) -> DataFrame:
    """One transport's loads of ``asked``, their text, and the blocks that a model picks where the text is weak."""
    loads = keep(fetch.load(asked, world.options, world.served), name)
    error = fetch.load_error(F.col("status"), F.col("body"), F.col("transport"), F.col("error"))
    # The key of one article of one source, for operators that take one column.
    asked = asked.withColumn("article", F.concat_ws(" ", "external_id", "source_id"))
    rows = asked.join(loads.select("url", "transport", "final_url", F.col("body").alias("html"), error.alias("load_error")), ["url", "transport"])
    moved = articles.redirect_error(F.col("final_url"), F.col("home_url"), F.col("allowed_hosts"))
    rows = rows.withColumn("error", F.coalesce("load_error", moved)).drop("load_error")
    rows = rows.withColumn("page", F.col("html")).withColumn("html", F.when(F.col("error").isNull(), F.col("html")).otherwise(""))
    read = keep(pages.texts(rows.drop("page"), "html", settings.content_max_chars).withColumnRenamed("content", "text"), f"{name}-texts")
    weak = (F.col("method") == "body") | (F.char_length("text") < settings.content_min_chars)
    picked = read.limit(0).select("article", F.lit("").alias("block_text"))
    if world.ask is not None:
        poor = read.where("error IS NULL").where(weak).select("article")
        blocks = keep(
            pages.blocks(rows.join(poor, "article", "left_semi").select("article", F.col("page").alias("html")), "article", settings),
            f"{name}-blocks"
        )
        chosen, said = remote.block_picks(
            blocks, read.select("article", "title"), world.ask, "article", settings.block_limit, keep=lambda df,
            n: keep(df, f"{name}-{n}")
        )
        answers.append(said)
        picked = articles.join_blocks(blocks, "article", chosen)
    both = read.join(picked, "article", "left").withColumn("asked_model", F.lit(world.ask is not None))
    return both.select(*articles.ARTICLE, "attempt", "transport", "final_url", "text", "method", "asked_model", "block_text", "error")


def next_state(
    state: dict[str, DataFrame], src: DataFrame, rows: DataFrame, emitted: DataFrame, got: collect.Collected, results: DataFrame, moved: DataFrame, now: str,
    settings: Settings
) -> dict[str, DataFrame]:
    """The state after a run; a failed source keeps its own but for the memory of its feed."""
    none = {c: F.lit(None).cast("string") for c in _CONTENT}
    keys = ["source_id", "url", "title", "published_at", *_CONTENT]
    seen = rows.withColumns(none).select(*keys, F.col("url").alias("observed_url")).unionByName(emitted.select(*keys, "observed_url"))
    # URLs that led to an article of which another observation was kept.
    seen = seen.unionByName(moved.withColumns({c: F.lit(None).cast("string") for c in keys if c not in moved.columns}).select(*keys, "observed_url"))
    ready = src.where("candidates_initialized AND NOT baseline").select("source_id")
    ok = results.where("ok").select("source_id", F.col("via").alias("new_method"), F.lit(True).alias("ok"))
    by_page = got.observed.select("source_id").distinct().withColumn("looked", F.lit(True))
    both = src.select(
        "source_id", "baseline_initialized", "candidates_initialized", "method", "last_ok_at"
    ).join(ok, "source_id", "left").join(by_page, "source_id", "left").join(got.feeds, "source_id", "left")
    good = F.coalesce("ok", F.lit(False))
    own = both.select(
        "source_id", (F.col("baseline_initialized") | good).alias("baseline_initialized"), (F.col("candidates_initialized") | F.coalesce("looked", F.lit(False))).alias("candidates_initialized"), "resolved_feed_url", "feed_fail_streak",
        F.when(good, F.col("new_method")).otherwise(F.col("method")).alias("method"), F.when(good, F.lit(now)).otherwise(F.col("last_ok_at")).alias("last_ok_at"),
    )
    others = state["source_state"].join(src.select("source_id"), "source_id", "left_anti")
    return {
        "seen": diff.update_seen(state["seen"], seen, now, settings),
        "candidates": diff.update_candidates(state["candidates"], got.observed.drop("pos"), now, ready, state["seen"], settings),
        "source_state": others.select(*own.columns).unionByName(own),
        "validators": got.validators,
    }


def publish_day(
    spark: SparkSession, day: DataFrame, date: str, now: str, out: str, source_id: str, producer: dict, facts: dict | None = None,
    merge: bool = True
) -> dict:
    """Writes a day's feed and bundle documents and returns the bundle's row of the index.

    ``day`` are the articles of one day, tens of rows, which are rendered on the driver. An existing
    bundle of the day is merged: its items stay unless new ones replace them, and its window widens.
    """
    # Places of a day's articles as numbers.
    items = publish.feed_items(day.withColumn("pos", F.row_number().over(Window.orderBy("pos")).cast("long")), now)
    summary = publish.summary(items).first().asDict()
    plain = lambda rows: [{k: v for k, v in r.asDict(recursive=True).items() if k != "pos"} for r in rows]
    ordered = plain(publish.sort_items(items).collect())
    feed = {
        "schema_version": publish.SCHEMA_VERSION, "date": date, "generated_at": now, "item_count": len(ordered),
        "kinds_included": ["publish"], "items": ordered,
        "summary": {k: summary[k] for k in ("by_kind", "by_via", "by_source", "by_content_status")}
    }
    for name in (date, "latest"):
        publish.write_text(spark, f"{out}/feed/{name}.json", json.dumps(feed, ensure_ascii=False, indent=2) + "\n")
    contract = publish.contract_items(items)
    start_of_day = datetime.fromisoformat(f"{date}T00:00:00+08:00").astimezone(UTC).isoformat()
    window = publish.window(contract, "published_at", start_of_day, now).first()
    start, end = window.start, window.end
    old = publish.read_text(spark, f"{out}/bundles/{date}.json") if merge else None
    if old is not None:
        before = json.loads(old).get("collect_window") or {}
        start, end = min(filter(None, (start, before.get("start"))), default=start), max(filter(None, (end, before.get("end"))), default=end)
        kept = publish.existing_items(spark, old, contract.drop("pos").schema)
        rows = plain(publish.merge_day(kept.select(*contract.columns), contract).collect())
    else:
        rows = plain(publish.sort_items(contract, "at").collect())
    hours = spark.range(1).select(publish.window_hours(F.lit(start), F.lit(end)).alias("hours")).first().hours
    # Sources and ways are counted of this feed, kinds and the total of the merged day.
    stats = {"total": len(rows), "by_kind": {"publish": len(rows)}, **{k: summary[k] for k in ("by_via", "by_source", "by_content_status")}}
    stats |= {"failed_lists": [f["id"] for f in (facts or {}).get("sources_failed", [])], **(facts or {})}
    text = publish.bundle_document(rows, date, source_id, start, end, hours, producer, stats)
    return {"date": date, "count": len(rows), "sha256": publish.write_text(spark, f"{out}/bundles/{date}.json", text), "window_end": end}


def rebuild_index(spark: SparkSession, out: str, source_id: str, now: str) -> dict:
    bundles = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(f"{out}/bundles").select("path", "content")
    doc = publish.index_document(publish.index_rows(bundles), source_id, now)
    publish.write_text(spark, f"{out}/bundles/index.json", json.dumps(doc, ensure_ascii=False, indent=2) + "\n")
    return doc


def run(
    spark: SparkSession, sources: DataFrame, state_path: str, out: str, now: str, world: World, settings: Settings | None = None,
    date: str | None = None, source_id: str = "linkflow"
) -> dict[str, DataFrame]:
    """One run over the enabled sources: collect, detect, probe, enrich, archive, save the state, publish.

    Gives ``results`` (one row a source), ``emitted`` articles and ``usage`` of the model. The
    archive is written before the state, so a crash between them is repaired by running again.
    """
    s = settings or Settings()
    version = store.next_version(spark, state_path)
    keep = collect.keeper(f"{state_path}/work/v={version}")
    # What the run before has kept for itself; its results may have been read until now.
    store.delete(spark, f"{state_path}/work/v={version - 1}")
    state = store.load_state(spark, state_path)
    enabled = config.enabled(sources)
    got = collect.collect(enabled, state, keep, world, s)
    src = collect.with_state(enabled, state, s)
    rows, new = detect(got.items, src, state, s)
    rows = keep(rows, "normalized")
    new, moved = articles.once_per_id(keep(probed(new.select(*rows.columns), src, keep, world, s), "probed"))
    new = keep(new, "new")
    asked: list[DataFrame] = []
    new = with_content(new.withColumn("collected_at", F.lit(now)), src, now, keep, world, s, asked)
    new = keep(new.withColumn("url_corrected", F.coalesce("url_corrected", F.lit(False))), "emitted")
    results, counted = observed_results(run_results(src, got, rows, new, state))
    results = keep(results, "results")
    store.append_archive(new.drop("observed_url"), f"{out}/archive", f"r{version:06d}")
    store.save_state(next_state(state, src, rows, new, got, results, moved, now, s), state_path, version)
    schema = new.drop("observed_url").schema
    archive = store.read_archive(spark, f"{out}/archive", now[:7], schema)
    # Runs of a day in order, each one's articles in theirs.
    place = F.concat_ws("-", "run_id", F.lpad(F.col("pos").cast("string"), 12, "0"))
    old = articles.first_of_day(archive.withColumn("pos", place).select(*schema.names), now[:10])
    day = articles.merge(old, new.drop("observed_url").withColumn("pos", F.lpad(F.col("pos").cast("string"), 12, "0")).select(*old.columns), "external_id", "pos")
    when = date or (datetime.fromisoformat(now) + timedelta(hours=8)).strftime("%Y-%m-%d")
    answers = spark.createDataFrame([], "error string, " + ", ".join(f"{u} long" for u in remote.USAGE))
    for more in [*got.answers, *asked]:
        answers = answers.unionByName(more.select(*answers.columns))
    usage = keep(remote.usage(answers), "usage")
    failed = results.where("NOT ok").orderBy("source_id").collect()
    facts = run_facts(counted.get, failed, usage.first().asDict(), s.llm_model)
    publish_day(spark, day, when, now, out, source_id, {"name": source_id, "version": VERSION, "run_id": f"r{version}", "commit": s.commit[:7]}, facts)
    rebuild_index(spark, out, source_id, now)
    return {"results": results, "emitted": new, "usage": usage}


def run_results(src: DataFrame, got: collect.Collected, rows: DataFrame, emitted: DataFrame, state: dict[str, DataFrame]) -> DataFrame:
    """One row a source: how it was served, and how many candidates, new candidates, articles and new articles it had."""
    old = state["candidates"].select("source_id", "url", F.lit(True).alias("old"))
    looked = got.observed.join(old, ["source_id", "url"], "left").groupBy("source_id").agg(
        F.count("*").alias("candidate_count"), F.count_if(F.col("old").isNull()).alias("candidate_new_count")
    )
    out = collect.outcomes(src, got.attempts).join(looked, "source_id", "left")
    for df, name in ((rows, "all_normalized"), (emitted, "new_articles")):
        out = out.join(df.groupBy("source_id").agg(F.count("*").alias(name)), "source_id", "left")
    return out.na.fill(0, ["candidate_count", "candidate_new_count", "all_normalized", "new_articles"])


def run_counters(results: DataFrame, emitted: DataFrame) -> DataFrame:
    """A run's counters: ``counter, label, n`` of ways, baselines, failures and content states."""
    part = lambda df, name, label: df.groupBy(label.alias("label")).agg(F.count("*").alias("n")).select(F.lit(name).alias("counter"), "label", "n")
    out = part(results.where("ok"), "via", F.col("via")).unionByName(part(results.where("ok AND baseline"), "baseline", F.lit("")))
    out = out.unionByName(part(results.where("NOT ok"), "failed", F.col("source_id")))
    return out.unionByName(part(emitted, "content_status", F.coalesce("content_status", F.lit("missing"))))


#: Ways by which a source can be served.
WAYS = ("rss", "llm", "browser_llm", "heuristic", "browser_heuristic")


def observed_results(results: DataFrame) -> tuple[DataFrame, Observation]:
    """``results`` with its counters as metrics, which are collected while the table is written: no second scan."""
    seen = Observation("run")
    ways = [F.count_if(F.col("ok") & (F.col("via") == w)).alias(f"via_{w}") for w in WAYS]
    return results.observe(seen, F.count_if("ok").alias("sources_ok"), F.count_if(F.col("ok") & F.col("baseline")).alias("baselines"), *ways), seen


def run_facts(counts: dict, failed: list, usage: dict, model: str) -> dict:
    """What a bundle says of its run: sources, baselines, ways, and what the model was asked and used."""
    via = {w: counts.get(f"via_{w}", 0) for w in WAYS}
    return {
        "sources_ok": counts.get("sources_ok", 0), "sources_failed": [{"id": r.source_id, "error": r.error} for r in failed], "baselines": counts.get("baselines", 0),
        "via_sources": {k: n for k, n in via.items() if n}, "llm_usage": {"model": model, **usage},
    }


def check(spark: SparkSession, sources: DataFrame, world: World | None = None, settings: Settings | None = None, **options: str) -> DataFrame:
    """A dry run: (id, url, transport, error, found, selected) of each source by its own mode.

    ``found`` counts a feed's entries, or a page's candidate links, of which the heuristic would
    select so many. Sources of the mode browser_llm are loaded by a browser, others by plain http with
    a browser where the page loader would try one.
    """
    s = settings or Settings()
    if world is None:
        world = World(fetch.Options(), served=_served(options.get("fixtures")))
    keep = lambda df, name: df.cache()
    asked = sources.withColumn("is_feed", F.col("collect_mode") == "rss").withColumn("url", F.when(F.col("is_feed"), F.col("rss_url")).otherwise(F.col("home_url")))
    asked = asked.withColumn("verify", fetch.verified(F.col("url"), s.ssl_insecure_hosts, F.col("ssl_verify")))
    outcomes, _, _ = feeds.scan(asked.where("is_feed").select(F.col("id").alias("source_id"), F.col("url").alias("feed_url"), "verify"), keep, "check", world.options, world.served, limit=s.feed_max_items)
    out = outcomes.select(F.col("source_id").alias("id"), F.col("feed_url").alias("url"), F.lit("http").alias("transport"), "error", F.col("entries").alias("found"), F.lit(0).cast("long").alias("selected"))
    browser = F.col("collect_mode") == "browser_llm"
    homes = asked.where("NOT is_feed")
    wanted = homes.select("url", F.when(browser, "browser").otherwise("http").alias("first"), (~browser & (F.col("browser_fallback") | F.lit(s.browser_auto))).alias("fallback"), F.col("browser_fallback").alias("always"), "verify")
    loads = keep(fetch.pages(wanted, keep, world.options, world.served), "pages")
    looked = homes.select("id", "url", "home_url", "allowed_hosts", "strip_query_keys").join(loads.select("url", "transport", "final_url", "body", F.col("error").alias("load_error")), "url")
    shown = looked.where("load_error IS NULL").select("id", F.col("final_url").alias("page"), "home_url", "allowed_hosts", "strip_query_keys", F.col("body").alias("html"))
    found = keep(pages.candidates(pages.links(shown), page_key="id", page_url="page", limit=s.page_candidates, hosts="allowed_hosts", extra="strip_query_keys").drop("html"), "candidates")
    n = found.groupBy("id").agg(F.count("*").alias("found"))
    picks = pages.heuristic_picks(found, page_key="id", limit=s.heuristic_picks).groupBy("id").agg(F.count("*").alias("selected"))
    both = looked.join(n, "id", "left").join(picks, "id", "left").na.fill(0, ["found", "selected"])
    error = F.coalesce("load_error", F.when(F.col("found") == 0, F.lit("no_candidates")))
    return out.unionByName(both.select("id", "url", "transport", error.alias("error"), "found", "selected"))


def _served(path: str | None) -> dict | None:
    if not path:
        return None
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def main(argv: list[str]) -> int:
    settings = Settings.from_env()
    if argv[:1] == ["run"] and len(argv) in (4, 6):
        spark = SparkSession.builder.appName("linkflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        world = World(fetch.Options.of(settings), _served(argv[5] if argv[4:5] == ["--served"] else None), remote.configured(settings))
        done = run(spark, config.strict(config.load(spark, argv[1])), argv[2], argv[3], datetime.now(UTC).isoformat(), world, settings)
        done["results"].show(1000, False)
        run_counters(done["results"], done["emitted"]).show(1000, False)
        done["usage"].show()
        return int(settings.strict and not done["results"].where("NOT ok").isEmpty())
    if argv[:1] != ["sources"] or len(argv) < 3 or argv[1] not in ("list", "validate", "check"):
        print(__doc__)
        return 2
    spark = SparkSession.builder.appName("linkflow").getOrCreate()
    sources = config.load(spark, argv[2])
    if argv[1] == "list":
        sources.select("id", "collect_mode", "enabled", "home_url").show(1000, False)
        return 0
    if argv[1] == "check":
        chosen, missing = config.select_ids(sources, argv[3:]) if argv[3:] else (config.enabled(sources), sources.select("id").limit(0))
        result = check(spark, chosen, World(fetch.Options.of(settings)), settings).cache()
        result.show(1000, False)
        missing.show(1000, False)
        return int(not missing.isEmpty() or not result.where("error IS NOT NULL").isEmpty())
    broken = config.validate(sources)
    config.mode_counts(sources).show()
    broken.show(1000, False)
    return int(not broken.isEmpty())


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
