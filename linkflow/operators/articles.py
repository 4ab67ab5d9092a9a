"""Articles: normalisation, keyed upserts, probing and content enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.functions import urls
from linkflow.functions.text import clean_text, n_chars, or_else, sha256
from linkflow.settings import Settings


#: What names an article: the URL's id alone would mix the sources that list it.
ARTICLE = ("source_id", "external_id")


def normalize(items: DataFrame, sources: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Feed entries or picked links as articles, with their source's columns.

    ``items(source_id, base, url, title, summary, content_html, published_at, author, via)`` join
    ``sources`` on the id. Entries without a usable URL, and links to the home page, go.
    """
    s = settings or Settings()
    dim = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), "home_url", "allowed_hosts", "strip_query_keys", "collect_mode")
    # The source dimension is configuration: Spark broadcasts it by its size.
    rows = items.join(dim, "source_id")
    canon = lambda u, base: urls.canonicalize(u, base=base, home=F.col("home_url"), allowed=F.col("allowed_hosts"), extra=F.col("strip_query_keys"))
    rows = rows.withColumnRenamed("url", "raw_url").withColumn("url", canon(F.col("raw_url"), or_else(F.col("base"), F.col("home_url")))).where("url != ''")
    rows = rows.withColumn("home", canon(F.col("home_url"), F.col("home_url"))).where("home = '' OR home != url")
    corrected = (F.coalesce("raw_url", F.lit("")) != "") & (urls.strip_tracking(F.col("raw_url")) != F.col("url"))
    return rows.select(
        urls.external_id(F.col("url")).alias("external_id"), "url", or_else(F.trim("title"), F.col("url")).alias("title"), or_else(F.col("author"), F.col("source_id")).alias("author"),
        F.coalesce("published_at", F.lit("")).alias("published_at"), "source_id", "via", "raw_url", corrected.alias("url_corrected"), F.substring("summary", 1, s.summary_chars).alias("summary"),
        F.substring("content_html", 1, s.content_html_chars).alias("content_html"), "source_name", "home_url", "collect_mode", *(["pos"] if "pos" in items.columns else []),
    )


def upsert(rows: DataFrame, key: str | list[str], pos: str, keep: list[str] | None = None) -> DataFrame:
    """One row per key: the values of the last occurrence at the place of the first (a keyed, ordered upsert)."""
    keys = [key] if isinstance(key, str) else key
    keep = keep or [c for c in rows.columns if c not in (*keys, pos)]
    out = rows.groupBy(*keys).agg(F.max_by(F.struct(*keep), F.col(pos)).alias("last"), F.min(pos).alias(pos))
    return out.select(*keys, *[F.col(f"last.{c}").alias(c) for c in keep], pos)


def merge(old: DataFrame, new: DataFrame, key: str, pos: str) -> DataFrame:
    """Upserts ``new`` over ``old`` (same columns): rows of ``new`` win, old ones keep their place.

    ``pos`` of the result is a struct (side, pos) that sorts old places before new ones.
    """
    both = old.withColumn("side", F.lit(0)).unionByName(new.withColumn("side", F.lit(1))).where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    both = both.withColumn("merge_place", F.struct("side", pos)).drop("side", pos)
    return upsert(both, key, "merge_place").withColumnRenamed("merge_place", pos)


def first_of_day(archive: DataFrame, day: str, pos: str = "pos") -> DataFrame:
    """The archive's articles of one UTC day, the first record of each."""
    key = or_else(F.col("external_id"), F.col("url"))
    rows = archive.where(F.substring("collected_at", 1, 10) == day).withColumn("key", key)
    keep = [c for c in rows.columns if c not in ("key", pos)]
    out = rows.groupBy("key").agg(F.min_by(F.struct(*keep), F.col(pos)).alias("first"), F.min(pos).alias(pos))
    return out.select(*[F.col(f"first.{c}").alias(c) for c in keep], pos)


def fetch_status(code: Column) -> Column:
    """What a probe's HTTP code says of an article."""
    return F.when(code.isin(404, 410), "not_found").when(code.isin(401, 403), "blocked").when((code >= 200) & (code < 400), "ok").otherwise("unknown")


def apply_probe(articles: DataFrame, probes: DataFrame, enabled: bool = True) -> DataFrame:
    """Drops articles that are gone and follows same-site redirects; ``probes(url, code, final_url)``."""
    if not enabled:
        return articles.withColumn("fetch_status", F.lit("skipped"))
    rows = articles.join(probes.withColumnRenamed("url", "probed"), F.col("url") == F.col("probed"), "left").drop("probed")
    rows = rows.withColumn("fetch_status", fetch_status(F.col("code"))).where("fetch_status != 'not_found'")
    final = urls.canonicalize(F.col("final_url"), home=F.col("url"))
    moved = (F.col("fetch_status") == "ok") & (F.coalesce("final_url", F.lit("")) != "") & (F.col("final_url") != F.col("url")) & (final != "")
    rows = rows.withColumn("observed_url", F.col("url")).withColumn("url_corrected", F.col("url_corrected") | F.coalesce(moved, F.lit(False)))
    rows = rows.withColumn("url", F.when(moved, final).otherwise(F.col("url")))
    return rows.withColumn("external_id", urls.external_id(F.col("url"))).drop("code", "final_url")


def once_per_id(articles: DataFrame, pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """Articles of a source that redirects have led to one URL become one: the last, at the first one's place.

    The second table ``source_id, url, observed_url`` holds every URL under which they were observed.
    """
    observed = articles.select("source_id", "url", "observed_url")
    return upsert(articles, list(ARTICLE), pos).select(*articles.columns), observed


def transports(collect_mode: Column, browser_fallback: Column) -> Column:
    return F.when(collect_mode == "browser_llm", F.array(F.lit("browser"))).when(browser_fallback, F.array(F.lit("http"), F.lit("browser"))).otherwise(F.array(F.lit("http")))


def enrich(articles: DataFrame, attempts: DataFrame, fetched_at: str, settings: Settings | None = None) -> DataFrame:
    """Adds content to articles; none is dropped.

    ``articles`` hold the extracted ``rss_text`` and ``summary_text``. ``attempts(source_id,
    external_id, attempt, transport, final_url, text, method, asked_model, block_text, error)`` are
    the page loads in order, with their extracted text. The feed's own text serves if it is long
    enough; else the first attempt with enough text; else what the feed has, as partial; else the
    article has failed. Two sources may have an article of one URL: each has its own attempts, as its
    own rules decide what may be loaded. Weak text is named a fallback only where no model was asked
    for better.
    """
    s = settings or Settings()
    full = n_chars(F.col("rss_text")) >= max(s.content_min_chars, s.content_rss_min_chars)
    weak = (F.col("method") == "body") | (n_chars(F.col("text")) < s.content_min_chars)
    picked = F.coalesce("block_text", F.lit("")) != ""
    text = F.when(weak & picked, F.col("block_text")).otherwise(F.col("text"))
    via = F.concat("transport", F.when(weak & picked, "_llm_blocks").when(weak & ~F.coalesce("asked_model", F.lit(False)), "_body_fallback").otherwise(""))
    tried = attempts.select(*ARTICLE, "attempt", "transport", "final_url", text.alias("text"), via.alias("via"), "error")
    short = (F.coalesce("error", F.lit("")) == "") & (n_chars(F.col("text")) < s.content_min_chars)
    tried = tried.withColumn("error", F.when(short, F.concat(F.lit("content_too_short:"), n_chars(F.col("text")).cast("string"))).otherwise(F.col("error")))
    bad = F.coalesce("error", F.lit("")) != ""
    notes = F.array_sort(F.collect_list(F.when(bad, F.struct("attempt", F.concat("transport", F.lit(":"), "error").alias("note")))))
    best = F.min_by(F.struct("text", "via", "final_url"), F.when(~bad, F.col("attempt"))).alias("best")
    got = tried.groupBy(*ARTICLE).agg(best, F.array_join(F.transform(notes, lambda x: x["note"]), "; ").alias("notes"))
    rows = articles.join(got, list(ARTICLE), "left")
    found = F.col("best.text").isNotNull()
    partial = or_else(F.col("rss_text"), F.col("summary_text"))
    pick = lambda a, b, c, d: F.when(full, a).when(found, b).when(partial != "", c).otherwise(d)
    content = pick(F.col("rss_text"), F.col("best.text"), partial, F.lit(""))
    out = rows.withColumn("content", content).withColumn("content_format", F.lit("text/plain"))
    out = out.withColumn("content_status", pick(F.lit("ok"), F.lit("ok"), F.lit("partial"), F.lit("failed")))
    out = out.withColumn("content_via", pick(F.lit("rss"), F.col("best.via"), F.lit("rss_summary"), F.lit("")))
    out = out.withColumn("content_source_url", pick(F.col("url"), F.col("best.final_url"), F.col("url"), F.col("url")))
    out = out.withColumn(
        "content_error",
        pick(F.lit(None).cast("string"), F.lit(None).cast("string"), F.substring("notes", 1, 500), F.substring(F.coalesce("notes", F.lit("")), 1, 500))
    )
    out = out.withColumn("content_chars", n_chars(F.col("content"))).withColumn("content_sha256", sha256(F.col("content")))
    return out.withColumn("content_fetched_at", F.lit(fetched_at)).drop("best", "notes", "rss_text", "summary_text", "content_html")


def join_blocks(blocks: DataFrame, key: str, selected: DataFrame) -> DataFrame:
    """Joins the selected blocks' distinct texts in the order they were selected, and cleans the whole; ``selected(key, nth, rank)``."""
    rows = selected.join(blocks.select(key, "rank", "text"), [key, "rank"])
    texts = F.transform(F.array_sort(F.collect_list(F.struct("nth", "text"))), lambda x: x["text"])
    # The blocks' references are decoded already: what is left are lines that repeat where blocks meet.
    return rows.groupBy(key).agg(clean_text(F.array_join(F.array_distinct(texts), "\n")).alias("block_text"))


def redirect_error(final_url: Column, home: Column, allowed: Column | None = None) -> Column:
    """Null if the page that was loaded is on an allowed host, else ``redirect_host:<host>``."""
    where = or_else(final_url)
    return F.when((where != "") & (urls.canonicalize(where, home=home, allowed=allowed) == ""), F.concat(F.lit("redirect_host:"), urls.host_of(where)))
