"""Feed entries of RSS and Atom documents, by Spark's XML functions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkflow.functions import urls
from linkflow.functions.dates import published
from linkflow.functions.text import or_else
from linkflow.operators import pages
from linkflow.settings import Settings
from linkflow.sources import fetch

_LINK = "struct<_VALUE:string,_href:string,_rel:string,_type:string>"
ENTRY = (
    f"title string, link array<{_LINK}>, guid string, id string, description string, summary string, `content:encoded` string, "
    "content array<struct<_VALUE:string,_type:string>>, pubDate string, published string, updated string, created string, "
    "author struct<_VALUE:string,name:string>, `dc:creator` string, `dc:date` string"
)
_ITEM = r"(?s)(<(?:item|entry)\b.*?</(?:item|entry)>)"


def _first(xs: Column) -> Column:
    return F.get(xs, F.lit(0))


def entry_link(e: Column) -> Column:
    """The entry's page: a typed alternate link, else any link that is no enclosure, else an http guid."""
    links = F.filter(F.coalesce(e["link"], F.expr(f"cast(array() as array<{_LINK}>)")), lambda x: F.lower(F.trim(F.coalesce(x["_rel"], F.lit("")))) != "self")
    url = lambda x: F.trim(or_else(x["_href"], x["_VALUE"]))
    rel = lambda x: F.lower(F.trim(F.coalesce(x["_rel"], F.lit(""))))
    kind = lambda x: F.lower(F.coalesce(x["_type"], F.lit("")))
    page = lambda x: (kind(x) == "") | kind(x).contains("html") | kind(x).startswith("text/")
    pick = lambda cond: url(_first(F.filter(links, lambda x: (url(x) != "") & cond(x))))
    guid = or_else(e["guid"], e["id"])
    return or_else(pick(lambda x: rel(x).isin("", "alternate") & page(x)), pick(lambda x: rel(x) != "enclosure"), F.when(urls.is_http_url(guid), guid))


def entry_content(e: Column) -> Column:
    """The longest body of an entry, the first of equals."""
    bodies = F.concat(
        F.transform(F.coalesce(e["content"], F.expr("cast(array() as array<struct<_VALUE:string,_type:string>>)")), lambda c: c["_VALUE"]),
        F.array(e["content:encoded"], e["description"], e["summary"])
    )
    return F.aggregate(bodies, F.lit(""), lambda best, x: F.when(F.char_length(F.coalesce(x, F.lit(""))) > F.char_length(best), x).otherwise(best))


def parse(feeds: DataFrame, body: str = "body", limit: int = Settings.feed_max_items) -> DataFrame:
    """``feeds`` plus one row per entry: (pos, url, title, summary, content_html, published_at, author).

    The document is cut into entries first, so one malformed entry costs itself only. The first
    ``limit`` entries count; those without a link go.
    """
    keep = [c for c in feeds.columns if c != body]
    items = feeds.select(*keep, F.posexplode(F.slice(F.regexp_extract_all(F.col(body), F.lit(_ITEM), F.lit(1)), 1, limit)).alias("pos", "item"))
    # Namespaces are not declared within a cut-out entry: the prefix stays part of the name.
    e = F.from_xml("item", F.lit(ENTRY), {"mode": "PERMISSIVE", "attributePrefix": "_", "valueTag": "_VALUE"})
    rows = items.select(*keep, "pos", e.alias("e")).where("e IS NOT NULL")
    e = F.col("e")
    summary = or_else(e["summary"], e["description"])
    out = rows.select(
        *keep, "pos", entry_link(e).alias("url"), F.trim(F.coalesce(e["title"], F.lit(""))).alias("title"),
        F.substring(summary, 1, Settings.summary_chars).alias("summary"), entry_content(e).alias("content_html"),
        published(e["pubDate"], e["published"], e["updated"], e["created"], e["dc:date"]).alias("published_at"),
        or_else(e["author"]["name"], e["author"]["_VALUE"], e["dc:creator"]).alias("author")
    )
    return out.where("url != ''")


def outcome(status: Column, body: Column, entries: Column) -> Column:
    """The error of a feed load, null if it worked; an empty feed has worked."""
    start = F.lower(F.substring(F.ltrim(F.coalesce(body, F.lit(""))), 1, 500))
    html = start.startswith("<!doctype html") | start.startswith("<html")
    feed = start.rlike(r"<(?:rss|feed|rdf:rdf|\?xml)")
    return F.when(status == 304, F.lit(None)).when(
        status >= 400, F.concat(F.lit("http_"), status.cast("string"))
    ).when(html, "not_a_feed_html").when((entries == 0) & ~feed, "parse_error")


# Where feeds usually are, below a site's origin or home page.
COMMON_PATHS = ("feed", "feed/", "rss", "rss.xml", "feed.xml", "atom.xml", "index.xml", "feeds/posts/default", "blog/feed", "?feed=rss2")


def feed_candidates(homes: DataFrame, linked: DataFrame) -> DataFrame:
    """URLs to try for each home page, in order, each once: its alternate links, then common paths.

    ``linked(home_url, pos, href)`` are the alternate links of the pages.
    """
    home = F.col("home_url")
    origin = F.concat(urls.scheme_of(home), F.lit("://"), urls.host_of(home), F.lit("/"))
    below = F.concat(F.regexp_replace(F.regexp_extract(home, r"^[^?#]*", 0), "/+$", ""), F.lit("/"))
    common = F.array(*[F.concat(base, F.lit(p)) for base in (origin, below) for p in COMMON_PATHS])
    guesses = homes.select("home_url", F.posexplode(common).alias("pos", "url")).withColumn("pos", F.col("pos") + 10_000)
    named = linked.select("home_url", urls.resolve_url(home, F.col("href")).alias("url"), "pos").where("url != ''")
    return named.select("home_url", "pos", "url").union(guesses.select("home_url", "pos", "url")).groupBy("home_url", "url").agg(F.min("pos").alias("pos"))


def discovered(probed: DataFrame, key: str = "home_url") -> DataFrame:
    """The feed of each key of ``probed(key, pos, url, error, entries)``: the first with entries, else the first valid."""
    good = probed.where("error IS NULL")
    w = Window.partitionBy(key).orderBy((F.col("entries") == 0).cast("int"), "pos")
    return good.withColumn("nth", F.row_number().over(w)).where("nth = 1").select(key, F.col("url").alias("feed_url"))


def scan(
    wanted: DataFrame, keep, name: str, options: fetch.Options | None = None, served: dict | None = None, known: DataFrame | None = None,
    limit: int = Settings.feed_max_items
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Loads ``wanted(source_id, feed_url[, verify])``, conditionally where ``known(url, etag, last_modified)`` has validators.

    Gives the outcome ``source_id, feed_url, error, entries`` of each (error null if it worked; not
    changed since the last load is an empty feed), the entries, at most ``limit`` of a feed, and the
    loads. ``keep(df, name)`` saves a table.
    """
    asked = wanted.withColumn("url", F.col("feed_url")).withColumn("kind", F.lit("feed"))
    if known is not None:
        asked = asked.join(known, "url", "left")
    loads = keep(fetch.scan(asked, options, served).drop("host", "kind"), name)
    answers = loads.withColumnRenamed("error", "load_error").withColumnRenamed("url", "feed_url")
    rows = wanted.select("source_id", "feed_url").join(answers, "feed_url")
    entries = keep(parse(rows.where("load_error IS NULL AND status < 400").select("source_id", "feed_url", "body"), limit=limit), f"{name}-entries")
    n = entries.groupBy("source_id", "feed_url").agg(F.count("*").alias("entries"))
    rows = rows.join(n, ["source_id", "feed_url"], "left").withColumn("entries", F.coalesce("entries", F.lit(0)))
    error = F.coalesce("load_error", outcome(F.col("status"), F.col("body"), F.col("entries")))
    return rows.select("source_id", "feed_url", error.alias("error"), "entries"), entries, loads


def _has_entries(body: str) -> bool:
    """Whether a document looks like a feed with entries; whether they count is for ``parse`` to say."""
    return re.search(r"<(item|entry)\b.*?</\1>", body, re.DOTALL) is not None


def discover(
    homes: DataFrame, keep, options: fetch.Options | None = None, served: dict | None = None, limit: int = Settings.feed_max_items
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Feed discovery for ``homes(source_id, home_url[, verify])``: (source_id, feed_url), the entries of its feed, and the loads.

    The home pages' alternate links and the usual places are tried in order, all sources at once. A
    source's walk stops at the first document with entries, so what stands behind it is never loaded.
    If none of those entries counts, the walk goes on behind it in another wave: an anti-join takes
    out the sources that have a feed, and what was loaded. Nearly always one wave is all.
    """
    loads = keep(fetch.scan(homes.withColumn("url", F.col("home_url")), options, served).drop("host", "kind"), "homes")
    p = homes.select("source_id", "home_url").join(loads.select(F.col("url").alias("home_url"), F.col("body").alias("html")), "home_url")
    linked = pages.feed_links(p.select("source_id", "home_url", "html"))
    tries = feed_candidates(homes.select("home_url").distinct(), linked.select("home_url", F.col("pos"), "href"))
    tries = keep(homes.select("source_id", "home_url", *[c for c in homes.columns if c == "verify"]).join(tries, "home_url"), "feed-tries")
    left, wave, walked, probed = tries, 0, None, None
    while not left.isEmpty():
        got = keep(fetch.walk(left.withColumn("kind", F.lit("feed")), "source_id", _has_entries, options, served), f"feed-walk{wave}")
        rows = got.withColumnRenamed("error", "load_error").withColumnRenamed("url", "feed_url")
        n = parse(rows.where("load_error IS NULL AND status < 400").select("source_id", "feed_url", "body"), limit=limit).groupBy("source_id", "feed_url").agg(F.count("*").alias("entries"))
        rows = rows.join(n, ["source_id", "feed_url"], "left").withColumn("entries", F.coalesce("entries", F.lit(0)))
        error = F.coalesce("load_error", outcome(F.col("status"), F.col("body"), F.col("entries")))
        outcomes = keep(rows.select("source_id", F.col("feed_url").alias("url"), error.alias("error"), "entries"), f"feed-outcomes{wave}")
        walked, probed = (got, outcomes) if walked is None else (walked.unionByName(got), probed.unionByName(outcomes))
        left = left.join(outcomes.select("source_id", "url"), ["source_id", "url"], "left_anti")
        left = left.join(outcomes.where("error IS NULL AND entries > 0").select("source_id"), "source_id", "left_anti")
        wave += 1
    if probed is None:
        none = homes.limit(0).select("source_id", F.lit("").alias("feed_url"), F.lit("").alias("body"))
        return none.select("source_id", "feed_url"), parse(none), loads
    best = keep(discovered(tries.select("source_id", "url", "pos").join(probed, ["source_id", "url"]), "source_id"), "feed-found")
    bodies = walked.withColumnRenamed("url", "feed_url").join(best, ["source_id", "feed_url"], "left_semi")
    entries = keep(parse(bodies.select("source_id", "feed_url", "body"), limit=limit), "feed-found-entries")
    return best, entries, loads.unionByName(walked.select(*loads.columns))
