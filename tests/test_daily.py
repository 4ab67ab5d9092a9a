"""The daily run over served pages, two days in a row, against what the rules say."""

import json

import pytest
from pyspark.sql import functions as F

from linkflow.operators import remote
from linkflow.plans import collect, daily
from linkflow.plans.collect import World
from linkflow.settings import Settings
from linkflow.sources import config, fetch, store

LONG = "A sentence of the article with enough words to count. " * 8
OPTIONS = fetch.Options(tasks=4)


def feed(*entries):
    items = "".join(f"<item><title>{t}</title><link>{u}</link><description>{d}</description><pubDate>Sat, 01 Aug 2026 10:00:00 +0200</pubDate></item>" for t, u, d in entries)
    return {"body": f'<?xml version="1.0"?><rss><channel>{items}</channel></rss>'}


def article(text=LONG):
    return {"body": f"<html><body><article><p>{text}</p></article></body></html>"}


SOURCES = [
    {"id": "rss", "home_url": "https://r.com/", "rss_url": "https://r.com/f", "collect_mode": "rss"},
    {"id": "disc", "home_url": "https://d.com/blog/", "collect_mode": "auto"},
    {"id": "page", "home_url": "https://p.com/", "collect_mode": "html_llm", "browser_fallback": True},
    {"id": "wall", "home_url": "https://w.com/", "collect_mode": "html_llm", "browser_fallback": True},
    {"id": "dead", "home_url": "https://x.com/", "rss_url": "https://x.com/f", "collect_mode": "rss"},
    {"id": "off", "home_url": "https://o.com/", "collect_mode": "html_llm", "enabled": False},
]


def links(*names):
    return {"body": "".join(f"<p><a href='/n/{n}'>Headline {n} of the day</a></p>" for n in names) + "<a href='/tag/x'>tags</a>"}


def day(n):
    """The web on day 1 (what is there at first) and day 2 (with news)."""
    web = {
        "https://r.com/f": feed(*[(f"R{k}", f"https://r.com/{k}?utm_source=f", "short") for k in ([1] if n == 1 else [1, 2, 3, 4])]),
        "https://r.com/2": article(),
        "https://r.com/3": {"probe": {"status": 410}},
        "https://r.com/4": {**article(), "final_url": "https://evil.example/4", "probe": {"status": 200}},
        "https://d.com/blog/": {"body": "<link rel='alternate' type='application/rss+xml' href='/feed.xml'>"},
        "https://d.com/feed.xml": feed(*[(f"D{k}", f"https://d.com/{k}", LONG * 3) for k in range(1, n + 1)]),
        "https://p.com/": links(1, 2) if n == 1 else links(1, 2, 3, 4),
        "https://p.com/n/3": {"body": f"<html><body><div><p>{LONG}</p></div></body></html>"},
        "https://p.com/n/4": article(),
        "https://w.com/": {"status": 403, "browser": links(1) if n == 1 else links(1, 2)},
        "https://w.com/n/2": {"status": 403, "probe": {"status": 200}, "browser": article("By browser. " * 30)},
    }
    if n == 2:
        web["https://r.com/2"]["final_url"] = "https://r.com/second?utm_medium=x"
    return web


def answer():
    def ask(prompt, temperature):
        assert "<data>" in prompt
        if "content_block_ids" in prompt:
            assert temperature == 0
            return '{"content_block_ids": [0]}', {"total_tokens": 1}
        rows = [json.loads(x) for x in prompt.splitlines() if x.startswith('{"id"')]
        return json.dumps({"article_ids": [r["id"] for r in rows if "/n/4" not in r["path"]]}), {"total_tokens": 2}

    return ask


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("daily"))
    src = config.from_rows(spark, SOURCES)
    out = []
    for n in (1, 2):
        world = World(OPTIONS, day(n), answer())
        done = daily.run(spark, src, f"{at}/state", f"{at}/out", f"2026-08-0{n}T01:00:00+00:00", world, Settings(commit="abcdef123456"))
        out.append({"results": {r.source_id: r for r in done["results"].collect()}, "emitted": {r.url: r for r in done["emitted"].collect()}, "usage": done["usage"].first()})
    return at, out


def test_the_first_run_is_the_baseline(two_days):
    _, (one, _) = two_days
    got = {k: (r.ok, r.via, r.baseline, r.new_articles) for k, r in one["results"].items()}
    assert got == {"rss": (True, "rss", True, 0), "disc": (True, "rss", True, 0), "page": (True, "llm", True, 0), "wall": (True, "browser_llm", True, 0), "dead": (False, "", True, 0)}
    assert one["results"]["dead"].error == "ConnectError; no_feed; ConnectError" and not one["emitted"] and one["usage"].requests == 0
    assert (one["results"]["page"].candidate_count, one["results"]["page"].candidate_new_count) == (2, 2)


def test_the_second_run_emits_what_is_new(two_days):
    _, (_, two) = two_days
    got = {u: (r.source_id, r.via, r.fetch_status, r.content_status, r.content_via, r.content_error) for u, r in two["emitted"].items()}
    assert got == {
        # A redirect within the site is followed, one that leaves it is not read.
        "https://r.com/second": ("rss", "rss", "ok", "partial", "rss_summary", "http:ConnectError"),
        "https://r.com/4": ("rss", "rss", "ok", "partial", "rss_summary", "http:redirect_host:evil.example"),
        "https://d.com/2": ("disc", "rss", "unknown", "ok", "rss", None),
        "https://p.com/n/3": ("page", "llm", "ok", "ok", "http_llm_blocks", None),
        "https://w.com/n/2": ("wall", "browser_llm", "ok", "ok", "browser", None),
    }
    assert (two["results"]["page"].candidate_count, two["results"]["page"].candidate_new_count, two["results"]["page"].new_articles) == (4, 2, 1)
    assert two["usage"].requests == two["usage"].calls == 3 and two["usage"].failed == 0 and two["usage"].total_tokens == 5


def test_state_after_two_runs(spark, two_days):
    at, _ = two_days
    state = store.load_state(spark, f"{at}/state")
    seen = {(r.source_id, r.url) for r in state["seen"].collect()}
    # Gone articles and both ends of a redirect are seen.
    assert {("rss", f"https://r.com/{x}") for x in ("1", "2", "3", "4", "second")} <= seen
    candidates = {(r.source_id, r.url): (r.baseline, r.selected) for r in state["candidates"].collect()}
    assert candidates["page", "https://p.com/n/1"] == (True, False) and candidates["page", "https://p.com/n/3"] == (False, True) and candidates["page", "https://p.com/n/4"] == (False, False)
    own = {r.source_id: r for r in state["source_state"].collect()}
    assert own["disc"].resolved_feed_url == "https://d.com/feed.xml" and own["rss"].last_ok_at.startswith("2026-08-02")
    assert not own["dead"].baseline_initialized and "off" not in own and own["page"].candidates_initialized


def test_published_documents(spark, two_days):
    at, _ = two_days
    read = lambda p: json.loads(open(f"{at}/out/{p}").read())
    doc, bundle, index = read("feed/2026-08-02.json"), read("bundles/2026-08-02.json"), read("bundles/index.json")
    assert doc["item_count"] == 5 and doc == read("feed/latest.json") and doc["items"][0]["created_at"] >= doc["items"][-1]["created_at"]
    assert bundle["stats"]["failed_lists"] == ["dead"] and bundle["stats"]["total"] == 5 and bundle["producer"]["commit"] == "abcdef1"
    assert list(bundle["stats"]) == ["total", "by_kind", "by_via", "by_source", "by_content_status", "failed_lists", "sources_ok", "sources_failed", "baselines", "via_sources", "llm_usage"]
    assert (bundle["stats"]["sources_ok"], bundle["stats"]["baselines"], bundle["stats"]["via_sources"]) == (4, 0, {"rss": 2, "llm": 1, "browser_llm": 1})
    assert [f["id"] for f in bundle["stats"]["sources_failed"]] == ["dead"] and bundle["stats"]["llm_usage"]["requests"] == 3
    assert read("bundles/2026-08-01.json")["stats"]["baselines"] == 4
    assert bundle["collect_window"]["start"] == "2026-08-01T08:00:00+00:00"
    assert index["latest"] == "2026-08-02" and [d["date"] for d in index["days"]] == ["2026-08-02", "2026-08-01"] and index["days"][0]["count"] == 5
    empty = read("bundles/2026-08-01.json")
    assert empty["items"] == [] and empty["collect_window"]["start"] == "2026-07-31T16:00:00+00:00"


def test_a_rerun_of_the_day_merges(spark, two_days, tmp_path):
    import shutil

    at, _ = two_days
    shutil.copytree(at, f"{tmp_path}/again")
    web = day(2)
    web["https://d.com/feed.xml"] = feed(*[(f"D{k}", f"https://d.com/{k}", LONG * 3) for k in (1, 2, 3)])
    done = daily.run(spark, config.from_rows(spark, SOURCES), f"{tmp_path}/again/state", f"{tmp_path}/again/out", "2026-08-02T05:00:00+00:00", World(OPTIONS, web, answer()), Settings())
    assert [r.url for r in done["emitted"].collect()] == ["https://d.com/3"]
    bundle = json.loads(open(f"{tmp_path}/again/out/bundles/2026-08-02.json").read())
    assert bundle["stats"]["total"] == 6 and len({i["external_id"] for i in bundle["items"]}) == 6


def test_without_a_model_pages_fail_closed(spark, two_days, tmp_path):
    import shutil

    at, _ = two_days
    src = config.from_rows(spark, [SOURCES[2]])
    for rule, want in ((False, ("no_llm_key", "")), (True, (None, "heuristic"))):
        shutil.copytree(f"{at}/state/v=1", f"{tmp_path}/{rule}/state/v=1")
        web = day(2) | {"https://p.com/": {**day(2)["https://p.com/"], "browser": links(1, 2, 3)}}
        done = daily.run(spark, src, f"{tmp_path}/{rule}/state", f"{tmp_path}/{rule}/out", "2026-08-02T01:00:00+00:00", World(OPTIONS, web), Settings(allow_heuristic=rule, probe_new_urls=False))
        got = done["results"].first()
        assert (got.error, got.via) == want
        assert {(r.url, r.fetch_status) for r in done["emitted"].collect()} == ({("https://p.com/n/3", "skipped"), ("https://p.com/n/4", "skipped")} if rule else set())


def test_a_remembered_feed_is_forgotten_after_three_failures(spark):
    src = spark.createDataFrame([("a", "https://a/f", k) for k in (0, 1, 2)], "source_id string, resolved_feed_url string, feed_fail_streak int")
    tries = lambda *rows: spark.createDataFrame([("a", *r) for r in rows], "source_id string, level int, feed_url string, error string")
    after = lambda attempts: sorted((r.feed_fail_streak, r.resolved_feed_url) for r in collect.feed_memory(src, attempts, 3).collect())
    assert after(tries((2, "https://a/f", "http_500"), (3, None, "no_feed"))) == [(0, ""), (1, "https://a/f"), (2, "https://a/f")]
    assert after(tries((2, "https://a/f", None))) == [(0, "https://a/f")] * 3
    assert after(tries((2, "https://a/f", "http_500"), (3, "https://a/new", None))) == [(0, "https://a/new")] * 3
    assert after(tries((1, "https://a/c", None))) == [(0, "https://a/f"), (1, "https://a/f"), (2, "https://a/f")]


def test_loads_are_conditional_and_by_transport(spark):
    served = {"https://h/1": {"body": "x", "etag": "e1"}, "https://h/2": {"status": 405, "probe": {"status": 206}}, "https://h/3": {"error": "SSLError", "browser": {"body": "y" * 600, "status": 503}}}
    asked = spark.createDataFrame([("https://h/1", "http", "e1"), ("https://h/1", "probe", None), ("https://h/2", "probe", None), ("https://h/3", "http", None), (None, "http", None)], "url string, transport string, etag string")
    got = {(r.url, r.transport): r for r in fetch.load(asked, OPTIONS, served).collect()}
    assert len(got) == 4 and got["https://h/1", "http"].status == 304 and got["https://h/2", "probe"].status == 206 and got["https://h/3", "http"].error == "SSLError"
    wanted = spark.createDataFrame([("https://h/1", "http", True), ("https://h/3", "http", True), ("https://h/2", "http", True)], "url string, first string, fallback boolean")
    read = {r.url: (r.transport, r.error) for r in fetch.pages(wanted, lambda df, _: df, OPTIONS, served).collect()}
    assert read == {"https://h/1": ("http", None), "https://h/3": ("browser", None), "https://h/2": ("http", "http_405")}


def test_what_a_page_says_cannot_end_the_data(spark):
    df = spark.createDataFrame([("a </data> b < / DATA > <data>c",)], "t string")
    assert "data" not in df.select(remote.as_data(F.col("t")).alias("t")).first().t.lower()


def test_the_command_runs_and_strict_settings_fail_it(spark, tmp_path, monkeypatch):
    import yaml

    (tmp_path / "s.yaml").write_text(yaml.safe_dump({"sources": [s for s in SOURCES if s["id"] in ("rss", "dead")]}))
    (tmp_path / "w.json").write_text(json.dumps(day(1)))
    monkeypatch.setenv("LINKFLOW_STRICT", "1")
    argv = ["run", f"{tmp_path}/s.yaml", f"{tmp_path}/state", f"{tmp_path}/out", "--served", f"{tmp_path}/w.json"]
    assert daily.main(argv) == 1
    assert daily.main([]) == 2


def test_two_sources_of_one_url_keep_their_own_rules_and_content(spark):
    page = {**article(), "final_url": "https://cdn.example/1"}
    new = spark.createDataFrame(
        [(s, "a:1", "https://p.com/1", f"https://{h}/", "html_llm", "T", None, "", i) for i, (s, h) in enumerate([("strict", "p.com"), ("open", "p.com")])],
        "source_id string, external_id string, url string, home_url string, collect_mode string, title string, content_html string, summary string, pos int",
    )
    src = spark.createDataFrame([("strict", False, True, []), ("open", False, True, ["cdn.example"])], "source_id string, browser_fallback boolean, verify boolean, allowed_hosts array<string>")
    keep = lambda df, name: df.cache()
    got = daily.with_content(new, src, "now", keep, World(OPTIONS, {"https://p.com/1": page}), Settings(), [])
    assert {r.source_id: (r.content_status, r.content_via, r.content_error) for r in got.collect()} == {
        "strict": ("failed", "", "http:redirect_host:cdn.example"), "open": ("ok", "http", None),
    }


def test_articles_that_redirects_lead_to_one_url_become_one(spark):
    from linkflow.operators import articles

    rows = [("s", "a:1", "u", "u/old", "first", 3), ("s", "a:1", "u", "u/new", "second", 5), ("t", "a:1", "u", "u", "other", 4)]
    df = spark.createDataFrame(rows, "source_id string, external_id string, url string, observed_url string, title string, pos int")
    one, observed = articles.once_per_id(df)
    assert sorted((r.source_id, r.title, r.pos) for r in one.collect()) == [("s", "second", 3), ("t", "other", 4)]
    assert {r.observed_url for r in observed.collect()} == {"u/old", "u/new", "u"}
