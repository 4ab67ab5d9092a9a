"""The data source of addresses, validators, discovery and the loader's refusals."""

from linkflow.functions import dates
from linkflow.sources import feeds, fetch
from pyspark.sql import functions as F

OPTIONS = fetch.Options(tasks=3)
KEEP = lambda df, name: df.cache()


def feed(n, etag=None):
    items = "".join(f"<item><title>T{i}</title><link>https://h/{i}</link></item>" for i in range(n))
    return {"body": f"<rss><channel>{items}</channel></rss>", "etag": etag}


def test_the_data_source_plans_by_host_and_takes_filters(spark):
    served = {u: {"body": u} for u in ("https://a.com/1", "https://www.a.com/2", "https://b.com/1")}
    asked = spark.createDataFrame([(u, "feed") for u in [*served, "https://b.com/none", None]], "url string, kind string")
    got = fetch.scan(asked, OPTIONS, served)
    assert got.rdd.getNumPartitions() == 2
    assert {(r.url, r.body, r.error, r.host, r.kind) for r in got.collect()} == {(u, u, None, u.split("/")[2].removeprefix("www."), "feed") for u in served} | {("https://b.com/none", "", "ConnectError", "b.com", "feed")}
    want = {tuple(r) for r in fetch.load(asked, OPTIONS, served).collect()}
    assert {tuple(r) for r in got.drop("host", "kind").collect()} == want
    one = got.where("host = 'a.com' AND url IN ('https://a.com/1', 'https://b.com/1') AND body != 'x'")
    assert one.rdd.getNumPartitions() == 1 and [r.url for r in one.collect()] == ["https://a.com/1"]
    # What was pushed is no longer filtered above the scan; what the source cannot do still is.
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "a.com" not in plan and "body" in plan and "Filter" in plan
    assert fetch.scan(asked.limit(0), OPTIONS, served).count() == 0


def test_validators_follow_what_came(spark):
    old = spark.createDataFrame([("same", "e1", None), ("new", "e1", "d1"), ("bare", "e1", None), ("down", "e1", None), ("rest", None, "d1")], "url string, etag string, last_modified string")
    loads = spark.createDataFrame(
        [("same", "http", 304, "e1", None), ("new", "http", 200, "e2", None), ("bare", "http", 200, None, None), ("down", "http", 500, None, None), ("first", "http", 200, None, "d9"), ("new", "browser", 200, "x", None)],
        "url string, transport string, status int, etag string, last_modified string",
    )
    got = {r.url: (r.etag, r.last_modified) for r in fetch.validators(old, loads).collect()}
    assert got == {"same": ("e1", None), "new": ("e2", None), "down": ("e1", None), "rest": (None, "d1"), "first": (None, "d9")}


def test_a_second_scan_is_conditional(spark):
    served = {"https://a/f": feed(2, "e1"), "https://b/f": feed(150)}
    wanted = spark.createDataFrame([("a", "https://a/f"), ("b", "https://b/f")], "source_id string, feed_url string")
    none = spark.createDataFrame([], "url string, etag string, last_modified string")
    shown = lambda x: sorted((r.source_id, r.error, r.entries) for r in x[0].collect())
    one = feeds.scan(wanted, KEEP, "one", OPTIONS, served, none, limit=3)
    assert shown(one) == [("a", None, 2), ("b", None, 3)]
    known = fetch.validators(none, one[2])
    two = feeds.scan(wanted, KEEP, "two", OPTIONS, served, known)
    assert shown(two) == [("a", None, 0), ("b", None, 100)]
    assert {r.url: r.status for r in two[2].collect()} == {"https://a/f": 304, "https://b/f": 200}
    assert {tuple(r) for r in fetch.validators(known, two[2]).collect()} == {("https://a/f", "e1", None)}


def test_discovery_loads_nothing_behind_the_first_feed_with_entries(spark):
    html = {"body": "<link rel='alternate' type='application/rss+xml' href='/empty.xml'><link rel='alternate' type='application/rss+xml' href='/odd.xml'>"}
    odd = {"body": "<rss><channel><item><title>no link</title></item></channel></rss>"}
    served = {"https://h.com/": html, "https://h.com/empty.xml": feed(0), "https://h.com/odd.xml": odd, "https://h.com/rss": feed(3), "https://g.com/feed": feed(1), "https://e.com/rss": feed(0), "https://e.com/feed.xml": feed(0)}
    homes = spark.createDataFrame([(s, f"https://{s}.com/") for s in "hgex"], "source_id string, home_url string")
    best, entries, loads = feeds.discover(homes, KEEP, OPTIONS, served)
    assert {(r.source_id, r.feed_url) for r in best.collect()} == {("h", "https://h.com/rss"), ("g", "https://g.com/feed"), ("e", "https://e.com/rss")}
    assert entries.groupBy("source_id").count().count() == 2
    n = {r.host: r.n for r in loads.groupBy(F.regexp_extract("url", "//([^/]*)", 1).alias("host")).agg(F.count("*").alias("n")).collect()}
    # The home page; h: two links, then feed, feed/ and rss; g: the first guess; the others: all guesses.
    assert n["h.com"] == 6 and n["g.com"] == 2 and n["e.com"] == n["x.com"] == 1 + len(feeds.COMMON_PATHS)


def test_what_the_loader_refuses(spark):
    wall = {"status": 403, "title": "Just a moment...", "body": "x" * 600}
    served = {"https://a/": {"status": 403, "browser": wall}, "https://b/": {"status": 403, "browser": {"body": "y" * 600, "status": 403}}, "https://c/": {"body": "z" * 5000}}
    asked = spark.createDataFrame([("https://a/", "browser"), ("https://b/", "browser"), ("https://c/", "http")], "url string, transport string")
    got = lambda **o: {r.url: r.error for r in fetch.load(asked, fetch.Options(tasks=2, **o), served).collect()}
    assert got() == {"https://a/": "challenge_unresolved:403", "https://b/": None, "https://c/": None}
    assert got(browser=False, max_bytes=4999) == {"https://a/": "BrowserDisabled", "https://b/": "BrowserDisabled", "https://c/": "BodyTooLarge"}
    wanted = spark.createDataFrame([("https://a/", "http", True, False)], "url string, first string, fallback boolean, always boolean")
    assert [r.error for r in fetch.pages(wanted, KEEP, OPTIONS, served).collect()] == ["http:http_403; browser:challenge_unresolved:403"]


def test_a_known_hard_site_gets_a_browser_after_any_failure(spark):
    served = {u: {"status": 500, "browser": {"body": "y" * 600}} for u in ("https://a/", "https://b/")}
    wanted = spark.createDataFrame([("https://a/", "http", True, True), ("https://b/", "http", True, False)], "url string, first string, fallback boolean, always boolean")
    assert {r.url: (r.transport, r.error) for r in fetch.pages(wanted, KEEP, OPTIONS, served).collect()} == {"https://a/": ("browser", None), "https://b/": ("http", "http_500")}


def test_feed_dates_of_all_zones_and_years(spark):
    cases = {
        "Mon, 05 Jan 2026 10:00:00 EST": "2026-01-05T10:00:00-05:00", "05 Jan 26 10:00:00 GMT": "2026-01-05T10:00:00+00:00", "05 Jan 69 10:00 PDT": "1969-01-05T10:00:00-07:00", "5 Jan 68 10:00:00 +0130": "2068-01-05T10:00:00+01:30",
        "Mon, 05 Jan 2026 10:00:00 CEST": "2026-01-05T10:00:00+00:00", "Mon, 05 Jan 2026 10:00:00": "2026-01-05T10:00:00+00:00", "nonsense": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.p for r in df.select("t", dates.published(F.col("t")).alias("p")).collect()} == cases
