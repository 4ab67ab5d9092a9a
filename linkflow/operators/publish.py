"""Publishing: feed items, contract items, rollups, day bundles and their index."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from linkflow.functions.dates import to_iso, window_hours
from linkflow.functions.text import or_else
from linkflow.operators.articles import merge

SCHEMA_VERSION = 1
_OPTIONAL = (
    "title", "via", "collect_mode", "content", "content_format", "content_status", "content_via", "content_source_url", "content_sha256",
    "content_fetched_at", "content_error", "source_name", "fetch_status", "published_at", "collected_at", "home_url", "author", "source_id",
    "external_id", "id", "url"
)


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")


def feed_items(articles: DataFrame, now: str) -> DataFrame:
    """Articles as items of a day's feed."""
    c = {n: _text(articles, n) for n in _OPTIONAL}
    actor = or_else(c["source_id"], c["author"])
    chars = F.coalesce(F.col("content_chars").cast("int"), F.lit(0)) if "content_chars" in articles.columns else F.lit(0)
    fixed = F.coalesce("url_corrected", F.lit(False)) if "url_corrected" in articles.columns else F.lit(False)
    keep = [F.col("pos")] if "pos" in articles.columns else []
    return articles.select(
        or_else(c["external_id"], c["id"]).alias("id"), F.lit("publish").alias("kind"), F.concat(actor, F.lit(" published: "), c["title"]).alias("text"), actor.alias("actor"), c["home_url"].alias("actor_url"),
        or_else(c["published_at"], c["collected_at"], F.lit(now)).alias("created_at"), c["url"].alias("html_url"), c["title"].alias("title"), c["via"].alias("via"), or_else(c["collect_mode"], F.lit("auto")).alias("collect_mode"),
        c["content"].alias("content"), or_else(c["content_format"], F.lit("text/plain")).alias("content_format"), *[c[n].alias(n) for n in ("content_status", "content_via", "content_source_url")], chars.alias("content_chars"),
        *[c[n].alias(n) for n in ("content_sha256", "content_fetched_at", "content_error")], F.when(c["published_at"] != "", "exact").otherwise("daily_window").alias("time_precision"),
        c["source_name"].alias("source_name"), c["fetch_status"].alias("fetch_status"), fixed.alias("url_corrected"), *keep,
    )


def count_by(df: DataFrame, column: str, default: str) -> DataFrame:
    return df.groupBy(or_else(F.col(column), F.lit(default)).alias("label")).agg(F.count("*").alias("n"))


#: A feed's counters: their columns, and what an absent value counts as.
COUNTERS = {"by_via": ("via", "unknown"), "by_source": ("actor", "?"), "by_content_status": ("content_status", "missing")}


def counters(items: DataFrame) -> DataFrame:
    """``counter, label, n`` of all counters and of the total (counter ``total``, label empty).

    One pass: grouping sets expand each item once per counter before the map-side sums, and one
    shuffle carries the sums of all.
    """
    rows = items.select(*[or_else(F.col(c), F.lit(default)).alias(name) for name, (c, default) in COUNTERS.items()])
    names = list(COUNTERS)
    sums = rows.groupingSets([[], *[[n] for n in names]], *names).agg(F.count("*").alias("n"), F.grouping_id().alias("set"))
    # In a set's number each column that does not group has its bit set, the first column the highest.
    every = (1 << len(names)) - 1
    which = {every: "total"} | {every ^ (1 << (len(names) - 1 - i)): n for i, n in enumerate(names)}
    counter = F.coalesce(*[F.when(F.col("set") == k, F.lit(n)) for k, n in which.items()])
    return sums.select(counter.alias("counter"), F.coalesce(*names, F.lit("")).alias("label"), "n")


def summary(items: DataFrame) -> DataFrame:
    """One row: the feed's counters as maps."""
    c = counters(items)
    as_map = lambda name: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("counter") == name, F.struct("label", "n")))))
    out = c.agg(F.coalesce(F.max(F.when(F.col("counter") == "total", F.col("n"))), F.lit(0).cast("long")).alias("item_count"), *[as_map(n).alias(n) for n in COUNTERS])
    return out.withColumn("by_kind", F.create_map(F.lit("publish"), F.col("item_count")))


def sort_items(items: DataFrame, key: str = "created_at", pos: str = "pos") -> DataFrame:
    """Newest first by text; equal times keep their order."""
    return items.orderBy(F.desc(key), F.asc(pos))


def places(items: DataFrame, order: list[Column], keep) -> DataFrame:
    """``items`` with ``place``, from 1 by ``order``: ranges of rows are sorted by themselves, and count on from those before.

    ``keep(df, name)`` saves a table. The only window over all counts the ranges, one row a partition.
    """
    dealt = keep(items.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    n = dealt.groupBy("range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = n.select("range", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return dealt.join(n, "range").withColumn("place", (F.col("before") + own).cast("long")).drop("range", "before")


def contract_items(items: DataFrame, collected_at: str | None = None) -> DataFrame:
    """Feed items as items of the bundle contract, with nested structs."""
    who, url, at = F.col("actor"), F.col("html_url"), to_iso(F.col("created_at"))
    text = or_else(F.col("text"), F.concat(who, F.lit(" published: "), "title"))
    tag = lambda p, c: F.when(c != "", F.concat(F.lit(p), c))
    tags = F.array_compact(F.array(F.lit("kind:publish"), tag("src:", who), tag("via:", F.col("via")), tag("channel:", or_else(F.col("collect_mode"), F.lit("auto")))))
    name, none = or_else(F.col("source_name"), who), F.lit(None).cast("string")
    collected = to_iso(F.lit(collected_at)) if collected_at else at
    refs = F.struct(
        F.struct(who.alias("login"), F.col("actor_url").alias("url")).alias("actor"), none.alias("repo"), none.alias("target_user"), none.alias("forkee"),
        F.struct(who.alias("id"), name.alias("name"), F.col("actor_url").alias("home_url")).alias("source"), F.struct("title", url.alias("url"), "content_sha256").alias("article"),
    )
    no, empty = F.lit(False), F.expr("cast(array() as array<string>)")
    flags = F.struct(
        F.lit("publish").alias("kind"), "via", or_else(F.col("collect_mode"), F.lit("auto")).alias("collect_mode"), "time_precision",
        no.alias("is_follow"), no.alias("is_repo_event"), "url_corrected", "fetch_status", "content_status", "content_via"
    )
    keep = ["pos"] if "pos" in items.columns else []
    return items.select(
        "id", who.alias("who"), F.col("actor_url").alias("who_url"), F.lit("publish").alias("action"), F.col("title").alias("target"), url.alias("target_url"), text.alias("text"), at.alias("at"), F.col("id").alias("external_id"), url.alias("url"), "title",
        or_else(F.col("content"), text).alias("content"), "content_format", "content_status", "content_via", or_else(F.col("content_source_url"), url).alias("content_source_url"),
        F.when(F.col("content_chars") > 0, F.col("content_chars")).otherwise(F.char_length("content")).alias("content_chars"), "content_sha256", to_iso(F.col("content_fetched_at")).alias("content_fetched_at"),
        who.alias("author"), name.alias("author_name"), F.col("actor_url").alias("author_url"), at.alias("published_at"), collected.alias("collected_at"), tags.alias("tags"), empty.alias("hashtags"),
        F.filter(F.array("actor_url", url), lambda u: u != "").alias("links"), refs.alias("refs"), F.struct(empty.alias("photos"), empty.alias("videos")).alias("media"),
        F.struct(F.lit(None).cast("long").alias("circle_count"), no.alias("trending"), no.alias("trending_front_page")).alias("metrics"), flags.alias("flags"), *keep,
    )


def tag_rollup(items: DataFrame) -> DataFrame:
    """Occurrences of kind, via and src tags: ``prefix, label, n``."""
    t = items.select(F.explode("tags").alias("tag")).select(
        F.substring_index("tag", ":", 1).alias("prefix"), F.expr("substring(tag, instr(tag, ':') + 1)").alias("label")
    )
    return t.where(F.col("prefix").isin("kind", "via", "src")).groupBy("prefix", "label").agg(F.count("*").alias("n"))


def window(items: DataFrame, column: str, fallback_start: str, fallback_end: str) -> DataFrame:
    """One row: the first and last time among the items, compared as text, and the hours between."""
    t = F.nullif(F.col(column), F.lit(""))
    w = items.agg(F.coalesce(F.min(t), F.lit(fallback_start)).alias("start"), F.coalesce(F.max(t), F.lit(fallback_end)).alias("end"))
    return w.withColumn("hours", window_hours(F.col("start"), F.col("end")))


def merge_day(existing: DataFrame, items: DataFrame) -> DataFrame:
    """A day's items after a rerun: new ones win, and all are sorted newest first."""
    return merge(existing, items, "external_id", "pos").orderBy(F.desc("at"), F.asc("pos.side"), F.asc("pos.pos"))


def bundle_document(items: list[dict], date: str, source_id: str, start: str, end: str, hours: int, producer: dict, stats: dict) -> str:
    """The JSON of one day. A day is tens of items, rendered on the driver so that its bytes are exact."""
    doc = {
        "schema_version": SCHEMA_VERSION, "source_id": source_id, "collect_date": date,
        "collect_window": {"start": start, "end": end, "hours": hours or 24}, "producer": producer, "stats": stats, "items": items
    }
    return json.dumps(doc, ensure_ascii=False, indent=2) + "\n"


def index_rows(bundles: DataFrame) -> DataFrame:
    """``date, count, sha256, window_end`` of bundle files read by the binaryFile source (path, content)."""
    doc = F.try_parse_json(F.decode("content", "UTF-8"))
    get = lambda path, kind: F.try_variant_get(doc, path, kind)
    rows = bundles.where(~F.col("path").endswith("/index.json")).select(
        get("$.collect_date", "string").alias("date"), get("$.stats.total", "long").alias("count"), F.sha2("content", 256).alias("sha256"),
        F.coalesce(get("$.collect_window.end", "string"), F.lit("")).alias("window_end")
    )
    return rows.where("date is not null")


def index_document(rows: DataFrame, source_id: str, updated_at: str) -> dict:
    """The index over all days; its rows are days."""
    days = [r.asDict() for r in rows.orderBy(F.desc("date")).collect()]
    return {
        "source_id": source_id, "schema_version": SCHEMA_VERSION, "latest": days[0]["date"] if days else "",
        "watermark": max((d["window_end"] for d in days), default=""), "updated_at": updated_at, "days": days
    }


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> str:
    """Writes a document beside its place on any Hadoop file system, moves it there, and returns its sha256."""
    raw = text.encode()
    at, fs = _path(spark, path)
    tmp, _ = _path(spark, f"{path}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(raw)
    finally:
        out.close()
    fs.delete(at, False)
    if not fs.rename(tmp, at):
        raise OSError(f"cannot write {path}")
    return hashlib.sha256(raw).hexdigest()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A document's text, None if there is none."""
    at, fs = _path(spark, path)
    if not fs.exists(at):
        return None
    row = spark.read.format("binaryFile").load(path).select("content").first()
    return bytes(row.content).decode() if row else None


def existing_items(spark: SparkSession, text: str, schema: StructType) -> DataFrame:
    """The items of a day's bundle document, with their places."""
    doc = spark.createDataFrame([(text,)], "text string")
    items = F.from_json(F.get_json_object("text", "$.items"), ArrayType(schema))
    return doc.select(F.posexplode(items).alias("pos", "item")).select("item.*", F.col("pos").cast("long").alias("pos"))
