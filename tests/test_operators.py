import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linkflow import schemas
from linkflow.operators import articles, classify, diff, pages, publish, remote
from linkflow.plans import daily
from linkflow.settings import Settings
from linkflow.sources import config, feeds, fetch, store
from linkflow.streaming import incremental


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_candidates_first_accepted_link_wins(spark):
    html = "<div><a href='/x'>Sponsored</a><a href='/x'>Real title</a><a href='/tag/y'>t</a><a href='/z.pdf'>p</a><a href='https://other.com/q'>o</a><span>beside</span></div>"
    p = spark.createDataFrame([(1, "https://h.com/", html)], "page_id long, url string, html string")
    got = pages.candidates(pages.links(p)).collect()
    assert [(r.link_url, r.title) for r in got] == [("https://h.com/x", "Real title")] and "beside" in got[0].context


def test_limit_counts_accepted_links(spark):
    html = "".join(f"<a href='/tag/{i}'>t</a><a href='/n{i}'>a long headline</a>" for i in range(120))
    p = spark.createDataFrame([(1, "https://h.com/", html)], "page_id long, url string, html string")
    got = pages.candidates(pages.links(p))
    assert got.count() == 80 and pages.heuristic_picks(got).count() == 40


def test_blocks(spark):
    long = "word " * 60
    html = f"<section><p>{long}</p></section><div><div><a href=x>{long}</a></div></div><div>short</div>"
    p = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = pages.blocks(p).collect()
    assert [(r.kind, r["rank"]) for r in got] == [("section", 1)]


def test_parse_ids(spark):
    cases = [('x {"article_ids": [2,0,2,99,-1,"1","no",true]} y', [2, 0, 1]), ('{"articles": ["u"]}', []), ("", []), ("{bad", []), ('{"article_ids": 5}', []), (None, [])]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    got = [r.x for r in df.select("i", classify.parse_ids(F.col("t"), "article_ids", F.lit(3)).alias("x")).orderBy("i").collect()]
    assert got == [c[1] for c in cases]


def test_scorer_sees_only_unknown_candidates(spark):
    c = spark.createDataFrame([(1, 0, "https://h/old", "an old headline"), (1, 1, "https://h/new", "a new headline")], "page_id long, pos int, link_url string, title string")
    known = spark.createDataFrame([("https://h/old",)], "url string")
    assert rows(classify.choose(c, known), "link_url") == [("https://h/new",)]
    assert classify.choose(c, known, baseline_only=True).count() == 0
    plan = classify.choose(c, known)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_state_steps_agree_with_the_fold(spark, tmp_path):
    obs = [("s", f"u{i % 7}", i % 4) for i in range(20)] + [("t", f"v{i}", i % 3 + 1) for i in range(9)] + [("s", "late", 3)]
    df = spark.createDataFrame(obs, "source_id string, url string, run int")
    for run in range(4):
        batch = df.where(F.col("run") == run).select("source_id", "url", F.lit("").alias("title"), F.lit("").alias("published_at"))
        incremental.process(batch, run, f"{tmp_path}/state", f"{tmp_path}/out")
    incremental.process(batch, 3, f"{tmp_path}/state", f"{tmp_path}/out")  # a rerun changes nothing
    got = incremental.all_output(spark, f"{tmp_path}/out")
    assert rows(got, "source_id", "url", "batch") == rows(diff.emitted(df), "source_id", "url", "run")


def test_stream_over_files(spark, tmp_path):
    for run, urls in enumerate((["a", "b"], ["b", "c"], ["d", "a"])):
        spark.createDataFrame([("s", u, "", "") for u in urls], "source_id string, url string, title string, published_at string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("source_id string, url string, title string, published_at string").parquet(f"{tmp_path}/in")
        incremental.start(stream, f"{tmp_path}/state", f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    assert rows(incremental.all_output(spark, f"{tmp_path}/out"), "url") == [("c",), ("d",)]


def test_stateful_form_emits_what_the_batches_do_and_forgets_the_oldest(spark, tmp_path):
    schema = "source_id string, url string, title string, published_at string"
    runs = (["a", "b"], ["b", "c"], ["d", "e", "c"], ["a", "e"])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    got, before = [], Counter()
    try:
        for urls in runs:
            spark.createDataFrame([("s", u, "", "") for u in urls], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            new = incremental.stateful(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), limit=3)
            query = new.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
            query.awaitTermination()
            every = Counter(r.url for r in spark.read.schema("source_id string, url string").parquet(f"{tmp_path}/out").collect())
            got.append(sorted((every - before).elements()))
            before = every
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    # Three URLs stay, the newest first: a and b go in the third run, so a is new again.
    assert got == [[], ["c"], ["d", "e"], ["a"]]


def test_redirects_mark_both_urls_and_gone_articles_go(spark):
    a = spark.createDataFrame([("s", f"https://h.com/{x}", "t", False, "", "", "", "") for x in "abc"], "source_id string, url string, title string, url_corrected boolean, published_at string, content_status string, content_sha256 string, content_fetched_at string")
    p = spark.createDataFrame([("https://h.com/a", 200, "https://h.com/final?utm_x=1"), ("https://h.com/b", 410, ""), ("https://h.com/c", 500, "")], "url string, code int, final_url string")
    got = articles.apply_probe(a, p)
    assert rows(got, "url", "fetch_status", "url_corrected") == [("https://h.com/c", "unknown", False), ("https://h.com/final", "ok", True)]
    seen = diff.update_seen(spark.createDataFrame([], schemas.SEEN), got, "r1")
    assert rows(seen, "url") == [("https://h.com/a",), ("https://h.com/c",), ("https://h.com/final",)]


def test_candidate_state(spark):
    empty = spark.createDataFrame([], schemas.CANDIDATE_STATE)
    seen, none = spark.createDataFrame([("s", "u0")], "source_id string, url string"), spark.createDataFrame([], "source_id string")
    look = lambda *us: spark.createDataFrame([("s", u, f"title {u}", u == "u2", "h") for u in us], "source_id string, url string, title string, selected boolean, selector string")
    one = diff.update_candidates(empty, look("u0", "u1"), "r1", none, seen).cache()
    assert rows(one, "url", "baseline") == [("u0", True), ("u1", True)]
    two = diff.update_candidates(one, look("u1", "u2"), "r2", spark.createDataFrame([("s",)], "source_id string"), seen)
    assert rows(two, "url", "baseline", "first_seen", "last_seen", "selected") == [("u0", True, "r1", "r1", False), ("u1", True, "r1", "r2", False), ("u2", False, "r2", "r2", True)]
    assert diff.update_candidates(one, look("u1", "u2"), "r2", none, seen, Settings(candidate_cap=1)).count() == 1


def test_sources(spark, tmp_path):
    good = {"id": "a", "home_url": "https://a.com", "rss_url": "https://a.com/f", "collect_mode": "RSS"}
    bad = [good, good, {"id": "b", "home_url": "h"}, {"id": "c", "home_url": "h", "collect_mode": "browser_llm", "access_status": "blocked"}, {"id": "", "home_url": "x"}, {"id": "d", "home_url": "h", "collect_mode": "rss"}]
    s = config.from_rows(spark, bad)
    assert rows(config.validate(s), "id", "rule") == [("a", "duplicate id"), ("b", "auto mode"), ("c", "blocked but enabled"), ("c", "browser mode needs browser_fallback"), ("d", "rss needs rss_url")]
    with pytest.raises(Exception, match="rss without rss_url"):
        config.strict(s).select("id").collect()
    found, missing = config.select_ids(s, ["a", "zz"])
    assert found.count() == 2 and rows(missing, "id") == [("zz",)]
    (tmp_path / "s.yaml").write_text("sources:\n- {id: a, home_url: 'https://a.com', enabled: false}\n")
    assert config.enabled(config.load(spark, f"{tmp_path}/s.yaml")).count() == 0
    with pytest.raises(FileNotFoundError):
        config.load(spark, f"{tmp_path}/none.yaml")


RSS = """<?xml version="1.0"?><rss><channel><link>https://h.com/</link>
<item><title>One &amp; only</title><link>https://h.com/1?utm_source=x</link><description>short</description><content:encoded><![CDATA[<p>a longer body</p>]]></content:encoded><pubDate>Sat, 01 Aug 2026 10:00:00 +0200</pubDate><dc:creator>Ann</dc:creator></item>
<item><title>Guid only</title><guid>https://h.com/2</guid></item><item><title>No link</title></item><item><title>broken</titl></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link rel="self" href="https://h.com/self"/><link rel="enclosure" href="https://h.com/e.mp3" type="audio/mpeg"/><link rel="alternate" type="text/html" href="https://h.com/a"/><updated>2026-08-01T00:00:00Z</updated><author><name>Bob</name></author><content type="html">body</content></entry></feed>"""


def test_feeds(spark):
    df = spark.createDataFrame([("r", RSS), ("a", ATOM), ("e", "<rss></rss>"), ("n", None)], "source_id string, body string")
    got = {(r.source_id, r.pos): r for r in feeds.parse(df).collect()}
    one, atom = got["r", 0], got["a", 0]
    assert (one.url, one.title, one.content_html, one.published_at, one.author) == ("https://h.com/1?utm_source=x", "One & only", "<p>a longer body</p>", "2026-08-01T10:00:00+02:00", "Ann")
    assert got["r", 1].url == "https://h.com/2" and (atom.url, atom.author, atom.published_at, atom.content_html) == ("https://h.com/a", "Bob", "2026-08-01T00:00:00+00:00", "body")
    assert not any(k[0] in "en" for k in got) and ("r", 2) not in got
    assert feeds.parse(df, limit=1).where("source_id = 'r'").count() == 1
    out = spark.createDataFrame([(304, "", 0), (500, "", 0), (200, "<!DOCTYPE html>", 0), (200, "junk", 0), (200, "<rss></rss>", 0)], "s int, b string, n int")
    assert [r.x for r in out.select(feeds.outcome(F.col("s"), F.col("b"), F.col("n")).alias("x")).collect()] == [None, "http_500", "not_a_feed_html", "parse_error", None]


def test_discovery(spark):
    homes = spark.createDataFrame([("https://h.com/blog/",)], "home_url string")
    linked = spark.createDataFrame([("https://h.com/blog/", 0, "/feed")], "home_url string, pos int, href string")
    c = feeds.feed_candidates(homes, linked)
    first = c.orderBy("pos").first()
    assert first.url == "https://h.com/feed" and c.select("url").distinct().count() == c.count()
    probed = c.withColumn("error", F.when(~F.col("url").isin("https://h.com/rss", "https://h.com/blog/rss"), "http_404")).withColumn("entries", F.when(F.col("url").contains("blog"), 3).otherwise(0))
    assert rows(feeds.discovered(probed), "feed_url") == [("https://h.com/blog/rss",)]


def test_fetch_from_fixtures(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps({"https://h/1": {"body": "hello"}, "https://h/2": {"status": 403}}))
    got = fetch.fetch(spark, ["https://h/1", "https://h/2", "https://h/3"], fixtures=f"{tmp_path}/f.json")
    err = fetch.load_error(F.col("status"), F.col("body"), F.col("transport"), F.col("error"))
    assert rows(got.select("url", err.alias("e"), fetch.needs_browser(F.col("status"), F.col("error")).alias("b")), "url", "e", "b") == [("https://h/1", None, False), ("https://h/2", "http_403", True), ("https://h/3", "ConnectError", None)]


def test_bundle_merge_and_blocks(spark):
    mk = lambda ids, title: spark.createDataFrame([(f"k{i}", title, f"2026-01-0{i}", i) for i in ids], "external_id string, title string, at string, pos long")
    got = [(r.external_id, r.title) for r in publish.merge_day(mk([1, 2], "old"), mk([2, 3], "new")).collect()]
    assert got == [("k3", "new"), ("k2", "new"), ("k1", "old")]
    b = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 3, "x")], "page_id long, rank int, text string")
    s = spark.createDataFrame([(1, 0, 2), (1, 1, 1), (1, 2, 3)], "page_id long, nth int, rank int")
    assert rows(articles.join_blocks(b, "page_id", s), "block_text") == [("y\nx",)]


def test_enrich_paths(spark):
    a = [("s", "f", "u", "", "", None), ("s", "p", "u", "", "sum", None), ("s", "r", "u", "x" * 900, "", None), ("s", "b", "u", "", "", None)]
    # A model that picks nothing leaves the page's own text and name; another source's load of the same URL does not count.
    a += [("s", "n", "u", "", "", None), ("s", "m", "u", "", "", None), ("other", "m", "u", "", "", None)]
    a = spark.createDataFrame(a, "source_id string, external_id string, url string, rss_text string, summary_text string, content_html string")
    t = [
        ("s", "f", 0, "http", "u", "tiny", "article", False, "", None), ("s", "p", 0, "http", "u", None, None, False, None, "http_500"), ("s", "b", 0, "http", "u", "y" * 50, "body", True, "z" * 300, None),
        ("s", "b", 1, "browser", "u", "w" * 300, "article", True, "", None), ("s", "n", 0, "http", "u", "n" * 300, "body", True, None, None), ("s", "m", 0, "http", "u", "m" * 300, "body", False, None, None),
        ("other", "m", 0, "http", "u", "m" * 300, "body", False, None, "redirect_host:evil"),
    ]
    t = spark.createDataFrame(t, "source_id string, external_id string, attempt int, transport string, final_url string, text string, method string, asked_model boolean, block_text string, error string")
    got = rows(articles.enrich(a, t, "now"), "external_id", "source_id", "content_status", "content_via", "content_chars", "content_error")
    assert got == [
        ("b", "s", "ok", "http_llm_blocks", 300, None), ("f", "s", "failed", "", 0, "http:content_too_short:4"), ("m", "other", "failed", "", 0, "http:redirect_host:evil"), ("m", "s", "ok", "http_body_fallback", 300, None),
        ("n", "s", "ok", "http", 300, None), ("p", "s", "partial", "rss_summary", 3, "http:http_500"), ("r", "s", "ok", "rss", 900, None),
    ]


def test_settings():
    s = Settings.from_env({"LINKFLOW_SEEN_CAP": "7", "LINKFLOW_STRICT": "yes", "LINKFLOW_BLOCK_LIMIT": "x"})
    assert (s.seen_cap, s.strict, s.block_limit) == (7, True, 12)


def test_model_picks(spark):
    c = spark.createDataFrame([(1, i, f"https://h/{i}", f"title {i}", "") for i in range(3)] + [(2, 0, "https://h/x", "other", "")], "page_id long, pos int, link_url string, title string, context string")

    def ask(prompt, temperature):
        if "other" in prompt:
            raise TimeoutError
        return 'sure: {"article_ids": [2, 0, 7]}', {"total_tokens": 5}

    picks, answers = remote.article_picks(c, ask)
    assert rows(picks, "link_url") == [("https://h/0",), ("https://h/2",)]
    assert rows(remote.usage(answers), "requests", "failed", "total_tokens") == [(2, 1, 5)]
    b = spark.createDataFrame([(1, r, "div", 9, f"text {r}") for r in (1, 2, 3)], "page_id long, rank int, kind string, chars int, text string")
    t = spark.createDataFrame([(1, "T")], "page_id long, title string")
    got, _ = remote.block_picks(b, t, lambda p, t: ('{"content_block_ids": [2, 0]}', {}))
    assert rows(got, "page_id", "nth", "rank") == [(1, 0, 3), (1, 1, 1)]


def test_sources_check(spark, tmp_path):
    page = "<a href='/news/1'>A headline</a><a href='/tag/x'>t</a>"
    (tmp_path / "f.json").write_text(json.dumps({"https://h.com/f": {"body": RSS}, "https://p.com/": {"body": page}, "https://e.com/": {"body": "<p>no links</p>"}, "https://x.com/f": {"status": 500}, "https://b.com/": {"status": 403, "browser": {"body": page + "<a href='/news/2'>About</a>"}}}))
    s = config.from_rows(spark, [{"id": "f", "home_url": "https://h.com/", "rss_url": "https://h.com/f", "collect_mode": "rss"}, {"id": "p", "home_url": "https://p.com/"}, {"id": "e", "home_url": "https://e.com/"}, {"id": "x", "home_url": "https://x.com/", "rss_url": "https://x.com/f", "collect_mode": "rss"}, {"id": "b", "home_url": "https://b.com/", "collect_mode": "browser_llm"}])
    got = rows(daily.check(spark, s, fixtures=f"{tmp_path}/f.json"), "id", "transport", "error", "found", "selected")
    # Each source by its own mode: the browser's page has two links, of which the heuristic takes one.
    assert got == [("b", "browser", None, 2, 1), ("e", "http", "no_candidates", 0, 0), ("f", "http", None, 2, 0), ("p", "http", None, 1, 1), ("x", "http", "http_500", 0, 0)]


def test_texts_keep_every_row_and_column(spark):
    rows = [(None, "<article>a</article>", 1), (None, "<article>bb</article>", 2), ("k", "<p>x", 3), ("k", "<p>x", 3), ("k", None, 4), ("p", "plain &lt; x", 5)]
    df = spark.createDataFrame(rows, "url string, html string, pos int")
    got = sorted(map(tuple, pages.texts(df).select("url", "pos", "content", "method").collect()), key=str)
    assert got == sorted([(None, 1, "a", "article"), (None, 2, "bb", "article"), ("k", 3, "", "empty"), ("k", 3, "", "empty"), ("k", 4, "", "empty"), ("p", 5, "plain < x", "plain")], key=str)
    assert "Exchange" not in pages.texts(df)._jdf.queryExecution().executedPlan().toString()
    assert [r.html for r in pages.cleaned(df.where("pos = 5"), "html").collect()] == ["plain < x"]


def test_json_ld_bodies_by_variants_equal_the_walk(spark):
    import random

    from linkflow.functions import dom
    from linkflow.operators import jsonld

    rng = random.Random(3)

    def value(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind == 0:
            return rng.choice(["", "text", None, 7, True])
        if kind in (1, 2):
            return {"articleBody": rng.choice(["", "  \n ", "body %d" % rng.randrange(9), 5, None, ["x"]]), "name": "n"} if rng.random() < 0.5 else {"name": "n"}
        if kind == 3:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        keys = rng.sample([*dom.BODY_PARENTS, "other"], rng.randrange(1, 4))
        return {k: value(depth - 1) for k in keys}

    docs = [json.dumps(value(5)) for _ in range(900)] + ["", "{", "[]", "null", '"articleBody"']
    want = {i: dom.article_body(dom.Page(f'<script type="application/ld+json">{t}</script>')) for i, t in enumerate(docs)}
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string")
    got = jsonld.bodies(df, "id", "doc", lambda x, _: x.cache())
    assert {r.id: r.body for r in got.collect()} == {i: t for i, t in want.items() if t} and len([t for t in want.values() if t]) > 50
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
