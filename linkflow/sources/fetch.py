"""Page loads: one row of what came back for each request.

Two forms with the same rows. ``load`` is a plan operator over a DataFrame of requests, which may
grow with the day's articles. ``PageSource`` is a data source (``spark.read.format("linkflow_pages")``)
for the addresses of configured sources: its partitions are planned by host, filters on url, host,
transport and kind are pushed into it and drop requests before they are planned, and a task that is
lost loads its own host again and no other.

Either way one task talks to one host over one session and one browser context.
``transport`` is ``http`` (conditional, with redirects), ``browser`` (Playwright, if it is installed)
or ``probe`` (HEAD, else a ranged GET). ``served`` is a dictionary that answers in place of the
network: ``{url: {status, body, final_url, error, etag, last_modified, browser: {...}, probe: {...}}}``.
Loads are not repeatable, so callers save what they get before they use it twice.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from linkflow import schemas
from linkflow.functions import urls
from linkflow.settings import Settings

# What clients say of themselves, and the kinds of documents they ask for.
AGENT = "Mozilla/5.0 (compatible; linkflow/1.0)"
ACCEPT = {
    "feed": "application/rss+xml, application/atom+xml, application/xml;q=0.9, text/xml;q=0.8, */*;q=0.5",
    "page": "text/html,application/xhtml+xml;q=0.9,*/*;q=0.5",
}
#: Titles of pages that stand before the page while a site checks its visitor.
CHALLENGES = ("just a moment", "checking your browser", "attention required")

_FIELDS = ("url", "transport", "kind", "verify", "etag", "last_modified")
_OUT = pa.schema(
    [("url", pa.string()), ("transport", pa.string()), ("final_url", pa.string()), ("status", pa.int32()), ("body", pa.string()), ("error", pa.string()), ("etag", pa.string()), ("last_modified", pa.string())]
)


@dataclass(frozen=True)
class Options:
    """How to load; ``of`` takes the values from the settings."""

    timeout: float = 45.0
    probe_timeout: float = 8.0
    #: A body beyond so many bytes is an error, not a page that is cut.
    max_bytes: int = 32 << 20
    browser: bool = True
    browser_timeout: float = 60.0
    wait_until: str = "domcontentloaded"
    wait_ms: int = 2000
    challenge_ms: int = 8_000
    scroll_ms: int = 500
    proxy: str = ""
    tasks: int = 64

    @classmethod
    def of(cls, s: Settings) -> Options:
        return cls(
            timeout=s.http_timeout_s, probe_timeout=s.probe_timeout_s, max_bytes=s.http_max_mb << 20, browser=s.browser_enabled,
            browser_timeout=s.browser_timeout_s, wait_until=s.browser_wait_until, wait_ms=s.browser_wait_ms, challenge_ms=s.browser_challenge_ms,
            scroll_ms=s.browser_scroll_ms, proxy=s.browser_proxy or os.environ.get("HTTPS_PROXY", "")
        )


def is_challenge(status: int | None, title: str, body: str) -> bool:
    """Whether a refused page is one that stands before the page while a site checks its visitor."""
    shown = f"{title} {body[:4000]}".lower()
    return status in (401, 403, 503) and any(x in shown for x in CHALLENGES)


class _Loader:
    """One task's connections; a browser starts with the first page that needs one and ends with the task."""

    def __init__(self, options: Options, served: dict | None):
        self.o, self.served = options, served
        self.play = self.browser = None
        self.contexts: dict[tuple[str, bool], object] = {}

    def close(self) -> None:
        if self.browser is not None:
            self.browser.close()
            self.play.stop()

    def load(self, r: dict) -> dict:
        if r["transport"] == "browser" and not self.o.browser:
            return {"error": "BrowserDisabled"}
        try:
            if self.served is not None:
                return self._answer(r)
            return {"browser": self._render, "probe": self._probe}.get(r["transport"], self._get)(r)
        except ImportError:
            return {"error": "BrowserUnavailable"}
        except Exception as e:
            return {"error": type(e).__name__}

    def _answer(self, r: dict) -> dict:
        got = self.served.get(r["url"])
        if got is not None and r["transport"] != "http":
            got = got.get(r["transport"], got if r["transport"] == "probe" else None)
        if got is None:
            return {"error": "ConnectError"}
        if r["etag"] and got.get("etag") == r["etag"]:
            return {"status": 304, "etag": r["etag"]}
        got = {"status": None if got.get("error") else 200, "body": "", **got}
        if len(got["body"].encode()) > self.o.max_bytes:
            return {"error": "BodyTooLarge"}
        if r["transport"] == "browser" and is_challenge(got["status"], got.get("title", ""), got["body"]):
            return {"error": f"challenge_unresolved:{got['status']}"}
        return {k: v for k, v in got.items() if k != "title"}

    def _open(self, r: dict, method: str, headers: dict[str, str], timeout: float) -> dict:
        import ssl
        import urllib.error
        import urllib.request

        context = ssl.create_default_context() if r["verify"] else ssl._create_unverified_context()
        request = urllib.request.Request(r["url"], headers={"User-Agent": AGENT, **headers}, method=method)
        try:
            with urllib.request.urlopen(request, timeout=timeout, context=context) as a:
                raw = b"" if method == "HEAD" else a.read(self.o.max_bytes + 1)
                if len(raw) > self.o.max_bytes:
                    return {"error": "BodyTooLarge"}
                body = raw.decode(a.headers.get_content_charset() or "utf-8", "replace")
                return {"status": a.status, "final_url": a.geturl(), "body": body, "etag": a.headers.get("ETag"), "last_modified": a.headers.get("Last-Modified")}
        except urllib.error.HTTPError as e:
            return {"status": e.code, "final_url": e.geturl()}

    def _get(self, r: dict) -> dict:
        known = {"If-None-Match": r["etag"], "If-Modified-Since": r["last_modified"]}
        return self._open(r, "GET", {"Accept": ACCEPT[r["kind"]], **{k: v for k, v in known.items() if v}}, self.o.timeout)

    def _probe(self, r: dict) -> dict:
        """A HEAD request; servers that do not answer it are asked for the first byte."""
        try:
            got = self._open(r, "HEAD", {}, self.o.probe_timeout)
        except OSError:
            got = {}
        if got.get("status") is None or got["status"] >= 400:
            got = self._open(r, "GET", {"Range": "bytes=0-0"}, self.o.probe_timeout)
        return {**got, "body": ""}

    def _render(self, r: dict) -> dict:
        host = host_key(r["url"])
        if self.browser is None:
            from playwright.sync_api import sync_playwright

            self.play = sync_playwright().start()
            self.browser = self.play.chromium.launch(proxy={"server": self.o.proxy} if self.o.proxy else None)
        key = host, r["verify"]
        if key not in self.contexts:
            self.contexts[key] = self.browser.new_context(user_agent=AGENT, ignore_https_errors=not r["verify"])
        page = self.contexts[key].new_page()
        try:
            answer = page.goto(r["url"], wait_until=self.o.wait_until, timeout=self.o.browser_timeout * 1000)
            status = answer.status if answer else None
            page.wait_for_timeout(self.o.wait_ms)
            # Lists that fill when they come into view.
            page.evaluate("window.scrollTo(0, document.body ? document.body.scrollHeight / 3 : 0)")
            page.wait_for_timeout(self.o.scroll_ms)
            waited = 0
            while (challenged := is_challenge(status, page.title(), page.content())) and waited < self.o.challenge_ms:
                page.wait_for_timeout(1000)
                waited += 1000
            if challenged:
                return {"error": f"challenge_unresolved:{status}"}
            return {"status": status, "final_url": page.url, "body": page.content()}
        finally:
            page.close()


def _row(loader: _Loader, r: dict) -> dict:
    got = {"final_url": r["url"], "body": "", **{k: v for k, v in loader.load(r).items() if v is not None}}
    return {f.name: got.get(f.name) for f in _OUT} | {"url": r["url"], "transport": r["transport"]}


def host_key(url: str) -> str:
    """What one task and one browser context serve: the host without a leading www."""
    return (urlsplit(url).hostname or "default").removeprefix("www.")


def _full(requests: DataFrame) -> DataFrame:
    default = {"transport": F.lit("http"), "kind": F.lit("page"), "verify": F.lit(True), "etag": F.lit(None).cast("string"), "last_modified": F.lit(None).cast("string")}
    rows = requests.select(*[F.col(c) if c in requests.columns else default[c].alias(c) for c in _FIELDS])
    return rows.where("coalesce(url, '') != ''").dropDuplicates(["url", "transport"])


class _Host(InputPartition):
    def __init__(self, requests: list[dict]):
        self.requests = requests


class _PageReader(DataSourceReader):
    def __init__(self, requests: list[dict], options: Options, served: dict | None):
        self.requests, self.o, self.served = requests, options, served

    def pushFilters(self, filters: list[Filter]):
        known = {"url": lambda r: r["url"], "host": lambda r: host_key(r["url"]), "transport": lambda r: r["transport"], "kind": lambda r: r["kind"]}
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in known:
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                of = known[f.attribute[0]]
                self.requests = [r for r in self.requests if of(r) in wanted]
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        by: dict[str, list[dict]] = {}
        for r in self.requests:
            by.setdefault(host_key(r["url"]), []).append(r)
        return [_Host(rs) for rs in by.values()]

    def read(self, partition: _Host | None) -> Iterator[tuple]:
        if partition is None:  # no requests are left
            return
        loader = _Loader(self.o, self.served)
        try:
            for r in partition.requests:
                row = _row(loader, r)
                yield (*[row[f.name] for f in _OUT], host_key(r["url"]), r["kind"])
        finally:
            loader.close()


class PageSource(DataSource):
    """``spark.read.format("linkflow_pages")``; options: ``requests`` and ``served`` as JSON, ``loader`` as JSON of ``Options``."""

    @classmethod
    def name(cls) -> str:
        return "linkflow_pages"

    def schema(self) -> str:
        return f"{schemas.FETCHED}, host string, kind string"

    def reader(self, schema) -> DataSourceReader:
        given = self.options
        served = json.loads(given["served"]) if given.get("served") else None
        return _PageReader(json.loads(given["requests"]), Options(**json.loads(given.get("loader", "{}"))), served)


#: Spark's switch for filters of Python data sources.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def scan(requests: DataFrame, options: Options | None = None, served: dict | None = None) -> DataFrame:
    """``load`` by the data source, for the few addresses of configured sources, which the driver plans by host.

    Gives what ``load`` gives, and ``host`` and ``kind``.
    """
    spark = requests.sparkSession
    spark.dataSource.register(PageSource)
    spark.conf.set(PUSHDOWN, "true")
    rows = [r.asDict() for r in _full(requests).collect()]
    if not rows:
        return spark.createDataFrame([], f"{schemas.FETCHED}, host string, kind string")
    own = served if served is None else {r["url"]: served[r["url"]] for r in rows if r["url"] in served}
    given = {"requests": json.dumps(rows), "loader": json.dumps(asdict(options or Options()))} | ({} if own is None else {"served": json.dumps(own)})
    return spark.read.format("linkflow_pages").options(**given).load()


def load(requests: DataFrame, options: Options | None = None, served: dict | None = None) -> DataFrame:
    """Loads distinct ``requests(url, transport[, kind, verify, etag, last_modified])``.

    Gives ``url, transport, final_url, status, body, error, etag, last_modified``; an error is the
    name of what went wrong, and then there is no status.
    """
    o = options or Options()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loader = _Loader(o, served)
        try:
            for b in batches:
                for r in b.to_pylist():
                    yield pa.RecordBatch.from_pylist([_row(loader, r)], _OUT)
        finally:
            loader.close()

    return _full(requests).repartition(o.tasks, urls.context_key(F.col("url"))).mapInArrow(run, schemas.FETCHED)


def walk(requests: DataFrame, key: str, stop, options: Options | None = None, served: dict | None = None) -> DataFrame:
    """Loads the ``requests(key, pos, url[, ...])`` of each key in order, until ``stop(body)`` says that one was what was looked for.

    Gives what ``load`` gives, with the key; what stands behind a stop is not loaded and has no row.
    A key's requests are one task's work, as a host's are in ``load``.
    """
    o = options or Options()
    default = {"transport": F.lit("http"), "kind": F.lit("page"), "verify": F.lit(True), "etag": F.lit(None).cast("string"), "last_modified": F.lit(None).cast("string")}
    rows = requests.select(key, "pos", *[F.col(c) if c in requests.columns else default[c].alias(c) for c in _FIELDS])
    schema = pa.schema([(key, pa.string()), *_OUT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loader, found = _Loader(o, served), None
        try:
            for b in batches:
                for r in b.to_pylist():
                    if r[key] == found:
                        continue
                    row = _row(loader, r)
                    if row["error"] is None and (row["status"] or 0) < 400 and stop(row["body"] or ""):
                        found = r[key]
                    yield pa.RecordBatch.from_pylist([{key: r[key], **row}], schema)
        finally:
            loader.close()

    return rows.repartition(o.tasks, key).sortWithinPartitions(key, "pos").mapInArrow(run, f"{key} string, {schemas.FETCHED}")


def validators(old: DataFrame, loads: DataFrame) -> DataFrame:
    """``url, etag, last_modified`` for the next conditional request.

    A page that came (200) replaces what was known of it, or removes it where it names nothing; what
    has not changed (304), failed or was not asked for keeps its validators.
    """
    came = loads.where("transport = 'http' AND status = 200").select("url", F.struct("etag", "last_modified").alias("new")).dropDuplicates(["url"])
    both = old.join(came, "url", "full_outer")
    value = lambda c: F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(c))
    return both.select("url", value("etag").alias("etag"), value("last_modified").alias("last_modified")).where("coalesce(etag, last_modified) IS NOT NULL")


def fetch(spark: SparkSession, addresses: list[str], transport: str = "http", fixtures: str | None = None, **options) -> DataFrame:
    """Loads a few URLs; ``fixtures`` names a JSON file on the driver that is served instead of the network."""
    served = None
    if fixtures:
        with open(fixtures, encoding="utf-8") as f:
            served = json.load(f)
    rows = spark.createDataFrame([(u, transport) for u in addresses], "url string, transport string")
    return load(rows, Options(**(asdict(Options()) | options)), served)


def verified(url: Column, insecure_hosts: str, ssl_verify: Column) -> Column:
    """Whether TLS is verified for a source's URL."""
    hosts = [h.strip().lower() for h in insecure_hosts.split(",") if h.strip()]
    return ~urls.is_insecure(url, F.array(*map(F.lit, hosts)).cast("array<string>"), ssl_verify)


def load_error(status: Column, body: Column, transport: Column, error: Column) -> Column:
    """The error of a page load, null if it can be read. A browser's long error pages can."""
    bad = (status >= 400) & ((transport != "browser") | (F.char_length(F.coalesce(body, F.lit(""))) < 500))
    return F.when(F.coalesce(error, F.lit("")) != "", error).when(bad, F.concat(F.lit("http_"), status.cast("string"))).when(F.trim(F.coalesce(body, F.lit(""))) == "", "html_empty")


def needs_browser(status: Column, error: Column) -> Column:
    """Whether a failed plain load is worth a browser: refusals, TLS errors and time-outs."""
    return status.isin(401, 403) | F.coalesce(error, F.lit("")).rlike("(?i)ssl|timeout|timed")


def first_readable(loads: DataFrame) -> DataFrame:
    """The first readable load of each URL of ``loads(url, attempt, status, body, transport, error)``."""
    ok = loads.where(load_error(F.col("status"), F.col("body"), F.col("transport"), F.col("error")).isNull())
    w = Window.partitionBy("url").orderBy("attempt")
    return ok.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def pages(wanted: DataFrame, keep, options: Options | None = None, served: dict | None = None) -> DataFrame:
    """The page loader with fallback: ``wanted(url, first, fallback[, verify])`` as the load that counts.

    ``first`` is the first transport; with ``fallback``, a plain load that was refused, or failed at
    TLS or by time, is tried with a browser, and with ``always`` one that failed in any way. ``keep(df, name)`` saves a table. A row has ``error``
    null if the page can be read; else the errors of all its attempts in order.
    """
    wanted = wanted.dropDuplicates(["url"])
    one = keep(scan(wanted.withColumn("transport", F.col("first")), options, served).drop("host", "kind"), "loads-first")
    error = load_error(F.col("status"), F.col("body"), F.col("transport"), F.col("error"))
    failed = one.withColumn("failed", error).where("transport = 'http' AND failed IS NOT NULL")
    failed = failed.select("url", F.coalesce(needs_browser(F.col("status"), F.col("error")), F.lit(False)).alias("walled"))
    always = F.col("always") if "always" in wanted.columns else F.lit(False)
    again = wanted.where("fallback").join(failed, "url").where(F.col("walled") | always).drop("walled").withColumn("transport", F.lit("browser"))
    two = keep(scan(again, options, served).drop("host", "kind"), "loads-again")
    both = one.withColumn("attempt", F.lit(0)).unionByName(two.withColumn("attempt", F.lit(1))).withColumn("error", error)
    by = Window.partitionBy("url")
    trail = F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("attempt", F.concat("transport", F.lit(":"), "error").alias("note")))).over(by))
    several = F.count("*").over(by) > 1
    both = both.withColumn("error", F.when(F.col("error").isNotNull() & several, F.array_join(F.transform(trail, lambda x: x["note"]), "; ")).otherwise(F.col("error")))
    w = by.orderBy(F.col("error").isNotNull(), F.when(F.col("error").isNull(), F.col("attempt")).otherwise(-F.col("attempt")))
    return both.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth", "attempt")
