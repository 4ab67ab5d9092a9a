"""Links, text and blocks of pages. Only parsing runs in Python (Arrow batches); the rest is plan."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linkflow.functions import dom, urls
from linkflow.functions.text import clean_text, n_chars, sha256
from linkflow.settings import Settings

ANCHOR = r'(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a>'


def _explode(df: DataFrame, column: str, parse: Callable[[str], list[tuple]], fields: str) -> DataFrame:
    """Appends one row per tuple that ``parse`` makes of ``column``, with its place ``pos``."""
    out = df.sparkSession.createDataFrame([], f"pos int, {fields}").schema
    at, names, own = df.columns.index(column), [f.name for f in out.fields[1:]], df.columns
    types = [pa.string() if f.dataType.simpleString() == "string" else pa.int32() for f in out.fields[1:]]

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                rows, take, pos = [], [], []
                for k, doc in enumerate(part.column(at)):
                    got = parse(doc.as_py() or "")
                    rows += got
                    take += [k] * len(got)
                    pos += range(len(got))
                kept = part.take(pa.array(take, pa.int64()))
                cols = list(zip(*rows, strict=True)) or [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(pos, pa.int32()), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
                    names=[*own, "pos", *names]
                )

    return df.mapInArrow(run, StructType([*df.schema.fields, *out.fields]))


def links(pages: DataFrame) -> DataFrame:
    """``pages`` plus (pos, href, title, parent_text) for each link of ``html``, by the DOM."""
    return _explode(pages, "html", dom.links, "href string, title string, parent_text string")


def links_native(pages: DataFrame) -> DataFrame:
    """(pos, href, title) of each link by expressions alone; enough where links hold plain text."""
    out = pages.select("*", F.posexplode(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0))).alias("pos", "anchor"))
    title = F.regexp_replace(F.regexp_extract("anchor", ANCHOR, 2), r"<[^>]*>", "")
    return out.select(*pages.columns, "pos", F.regexp_extract("anchor", ANCHOR, 1).alias("href"), F.trim(title).alias("title"))


def candidates(
    links: DataFrame, page_key: str = "page_id", page_url: str = "url", limit: int = Settings.page_candidates, hosts: str | None = None,
    extra: str | None = None
) -> DataFrame:
    """The links of each page that may be articles: first accepted link of a URL, in page order.

    Filters come before the deduplication, so a link that they drop does not hide a later one.
    """
    base = F.col(page_url)
    url = urls.canonicalize(
        F.col("href"), base=base, home=F.col("home_url") if "home_url" in links.columns else base, allowed=F.col(hosts) if hosts else None,
        extra=F.col(extra) if extra else None
    )
    out = links.withColumn("link_url", url).where("link_url != ''")
    out = out.where(~urls.is_non_article(F.col("link_url")) & ~urls.is_promotion(F.col("link_url"), F.col("title")) & ~urls.is_asset(F.col("link_url")))
    first = Window.partitionBy(page_key, "link_url").orderBy("pos")
    order = Window.partitionBy(page_key).orderBy("pos")
    out = out.withColumn("nth", F.row_number().over(first)).where("nth = 1").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    near = F.substring("parent_text", 1, 320) if "parent_text" in links.columns else F.lit("")
    context = F.when(F.col("parent_text") != F.col("title"), near).otherwise("") if "parent_text" in links.columns else near
    return out.withColumn("context", context).withColumn("title", F.substring("title", 1, 200)).drop("nth")


def heuristic_picks(candidates: DataFrame, page_key: str = "page_id", limit: int = Settings.heuristic_picks) -> DataFrame:
    """Candidates whose title and path look like an article's; the first ``limit`` of each page."""
    words = ("read more", "learn more", "home", "blog", "about", "contact")
    title = F.trim("title")
    deep = F.size(F.filter(F.split(urls.path_of(F.col("link_url")), "/"), lambda s: s != "")) >= 1
    good = candidates.where((F.char_length(title) >= 8) & deep & ~F.lower(title).isin(*words))
    order = Window.partitionBy(page_key).orderBy("pos")
    return good.withColumn("pick", F.row_number().over(order)).where(F.col("pick") <= limit)


def _replace(df: DataFrame, column: str, parse: Callable[[str], tuple], fields: str) -> DataFrame:
    """``column`` replaced by what ``parse`` makes of it: one row out for each row in, nothing shuffled."""
    at = df.columns.index(column)
    new = StructType.fromDDL(fields).fields
    taken = {f.name for f in new}
    schema = StructType([f for f in df.schema.fields if f.name != column and f.name not in taken] + new)
    kept = [i for i, c in enumerate(df.columns) if c != column and c not in taken]

    def run(batches):
        for b in batches:
            got = [parse(doc.as_py() or "") for doc in b.column(at)]
            cols = list(zip(*got, strict=True)) or [[] for _ in new]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], *[pa.array(c, pa.string()) for c in cols]], names=schema.names)

    return df.mapInArrow(run, schema)


def texts(documents: DataFrame, column: str = "html", max_chars: int | None = Settings.content_max_chars, closed: bool = False) -> DataFrame:
    """``documents`` with ``content`` and ``method`` in place of ``column``.

    The longest choice is picked where the page is parsed, so nothing is grouped, joined or shuffled;
    null keys and repeated rows are rows like others. With ``closed``, only references with a semicolon
    are decoded (see ``dom.clean``); without ``max_chars``, texts are whole.
    """
    best = _replace(documents, column, lambda h: dom.longest(h, closed)[::-1], "content string, method string")
    return best if max_chars is None else best.withColumn("content", F.substring("content", 1, max_chars))


def texts_native(documents: DataFrame, column: str = "html") -> DataFrame:
    """``content`` by expressions: the first ``article`` element's text, else the body's."""
    bare = F.regexp_replace(F.col(column), r"(?is)<(script|style|noscript|svg|nav|footer|header|form|aside)\b[^>]*>.*?</\1>", "")
    article = F.regexp_extract(bare, r"(?is)<article\b[^>]*>(.*?)</article>", 1)
    inner = F.when(article != "", article).otherwise(F.regexp_extract(bare, r"(?is)<body\b[^>]*>(.*?)(?:</body>|$)", 1))
    return documents.withColumn("content", clean_text(F.regexp_replace(F.regexp_replace(inner, r"(?s)<!--.*?-->", "\n"), r"<[^>]*>", "\n")))


def digest(df: DataFrame, column: str = "content") -> DataFrame:
    return df.withColumn("content_chars", n_chars(F.col(column))).withColumn("content_sha256", sha256(F.col(column)))


def rank_blocks(blocks: DataFrame, key: str, settings: Settings | None = None, whole: bool = False) -> DataFrame:
    """The best blocks of each page of ``blocks(key, pos, kind, text, link_chars)``.

    A text counts once (its first element); blocks that are short or mostly links go. Texts are cut to
    ``content_max_chars``, unless ``whole``; scores count no more than that in any case.
    """
    s = settings or Settings()
    n = F.char_length("text")
    ratio = F.least(F.lit(1.0), F.col("link_chars") / F.greatest(F.lit(1), n))
    first = Window.partitionBy(key, F.xxhash64("text"), "text").orderBy("pos")
    out = blocks.where(n >= s.block_min_chars).withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")
    out = out.withColumn("chars", n).withColumn("link_ratio", ratio).where(F.col("link_ratio") <= s.block_max_link_ratio)
    out = out.withColumn("score", F.floor(F.least(n, F.lit(s.content_max_chars)) * (F.lit(1.0) - F.col("link_ratio"))).cast("int"))
    order = Window.partitionBy(key).orderBy(F.desc("score"), F.desc("chars"), "pos")
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.block_limit)
    return out if whole else out.withColumn("text", F.substring("text", 1, s.content_max_chars))


def blocks(pages: DataFrame, key: str = "page_id", settings: Settings | None = None, closed: bool = False, whole: bool = False) -> DataFrame:
    found = _explode(pages.select(key, "html"), "html", lambda h: dom.blocks(h, closed), "kind string, text string, link_chars int").drop("html")
    return rank_blocks(found, key, settings, whole)


def excerpts(pages: DataFrame, max_chars: int = 12_000, closed: bool = False) -> DataFrame:
    return _explode(pages, "html", lambda h: [(dom.excerpt(h, max_chars, closed),)], "excerpt string").drop("html", "pos")


def feed_links(pages: DataFrame) -> DataFrame:
    """``pages`` without ``html``, plus (pos, href) of the alternate links that name feeds."""
    return _explode(pages, "html", lambda h: [(x,) for x in dom.feed_links(h)], "href string").drop("html")


def cleaned(df: DataFrame, column: str) -> DataFrame:
    """``column`` with character references decoded and lines cleaned; ``text.clean_text`` is the native form without references."""
    return _replace(df, column, lambda t: (dom.clean(t),), f"`{column}` string")
