import hashlib
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkflow.functions import dates, dom, text, urls


def column(spark, values, expr):
    df = spark.createDataFrame(list(enumerate(values)), "i int, u string")
    return [r.x for r in df.select("i", expr(F.col("u")).alias("x")).orderBy("i").collect()]


def test_url_vectors(spark):
    given_ = ["HTTPS://User@Host.COM:443/a;p?b=1&utm_source=x#f", "http://h:8080/amp", "http://h/amp/?amp=1&c=~*", "ftp://h/x", "http://h:99999/x", "", None, "http://h?d", "https://e_x.com/a|b?q=a%20b&q=c"]
    want = ["https://host.com/a?b=1", "http://h:8080/", "http://h/?c=~%2A", "", "", "", "", "http://h/?d=", "https://e_x.com/a|b?q=a+b&q=c"]
    assert column(spark, given_, urls.canonicalize) == want
    assert column(spark, ["https://www.a.com/x", "https://b.com/x"], lambda u: urls.canonicalize(u, home=F.lit("https://a.com/"))) == ["https://www.a.com/x", ""]
    assert column(spark, ["https://a.com/x?k=1&K=2&z=3"], lambda u: urls.canonicalize(u, extra=F.array(F.lit("k")))) == ["https://a.com/x?z=3"]


def test_resolution_follows_the_standard_library(spark):
    base = "https://h.com/a/b/c?q=1"
    refs = ["x", "../x", "../../../x", "./", "..", "/p/../q", "//o.com/z", "?y=2", "#f", "x/y?z#w", "https://abs.com/", "../x/./y/../z"]
    got = column(spark, refs, lambda u: urls.resolve_url(F.lit(base), u))
    assert got == [urljoin(base, r) for r in refs]
    assert column(spark, ["javascript:x", " mailto:a@b", "tel:1", "data:x", ""], lambda u: urls.resolve_url(F.lit(base), u)) == [""] * 5


PIECE = st.text(alphabet="abzAZ09-_.~*' é&=+%;", max_size=6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(PIECE, PIECE), min_size=1, max_size=20))
def test_query_reencoding_follows_the_standard_library(spark, pairs):
    qs = ["&".join(f"{k}={v}" for k, v in pairs[i:]).replace("%", "%25") for i in range(len(pairs))]
    got = column(spark, [f"http://h/p?{q}" for q in qs], urls.strip_tracking)
    for q, g in zip(qs, got, strict=True):
        want = urlencode([(k, v) for k, v in parse_qsl(q, keep_blank_values=True) if k.lower() not in urls.TRACKING_KEYS])
        assert urlsplit(g).query == want


def test_rules(spark):
    assert column(spark, ["http://h/", "http://h/tag/x", "http://h/TAGS", "http://h/staging/x", "http://h/a/login"], urls.is_non_article) == [True, True, True, False, True]
    assert column(spark, ["http://h/misc.php?a=1&do=TAD", "http://h/misc.php?do=x"], lambda u: urls.is_promotion(u, F.lit("t"))) == [True, False]
    assert column(spark, ["Sponsored", "sponsored content ", "Rent a  thread today", "Our sponsored dog"], lambda t: urls.is_promotion(F.lit("http://h/x"), t)) == [True, True, True, False]
    assert column(spark, ["http://h/a.css", "http://h/a.CSS", "http://h/a.pdf?x"], urls.is_asset) == [True, False, True]
    assert column(spark, ["http://h/x"], urls.external_id) == ["a:" + hashlib.sha1(b"http://h/x").hexdigest()[:16]]
    assert column(spark, ["https://sub.ex.org", "https://ex.org:1", "https://notex.org"], lambda u: urls.is_insecure(u, F.array(F.lit("ex.org")))) == [True, True, False]


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet="ab \t\n\r\x0b\x0c\x1c\x85  ", max_size=30))
def test_clean_text_follows_the_parser_side(spark, value):
    assert column(spark, [value], text.clean_text) == [dom.clean(value)]


def test_dates(spark):
    assert column(spark, ["Sat, 01 Aug 2026 10:00:00 +0200", "1 Aug 2026 08:00:00 GMT", "2026-08-01T10:00:00.5+02:00", "nonsense", None], dates.published) == ["2026-08-01T10:00:00+02:00", "2026-08-01T08:00:00+00:00", "2026-08-01T08:00:00.500000+00:00", "", ""]
    assert column(spark, ["Sat, 01 Aug 2026 00:10:00 -0730", "Sat, 01 Aug 2026 00:10:00 -0000", "1 Aug 2026 00:10 +1345"], dates.published) == ["2026-08-01T00:10:00-07:30", "2026-08-01T00:10:00+00:00", "2026-08-01T00:10:00+13:45"]
    assert column(spark, ["2026-01-01T00:00:00Z", "not a time", None], dates.to_iso) == ["2026-01-01T00:00:00+00:00", "not a time", ""]
    hours = lambda e: dates.window_hours(F.lit("2026-01-01T00:00:00+00:00"), e)
    assert column(spark, ["2026-01-01T07:59:59+00:00", "2026-01-01T00:00:00+00:00", None], hours) == [7, 24, 24]
    assert column(spark, ["2026-07-31 22:11:00", "2026-07-31 15:59:59"], lambda t: dates.beijing_date(t.cast("timestamp"))) == ["2026-08-01", "2026-07-31"]


def test_dom():
    page = "<body><nav><a href='/n'>n</a></nav><div id=post_message_1><p>One<p>Two &amp;amp; <b>three<br></div><ul><li>x<li><a href=/y>y</a> near</ul><script>bad</script>"
    assert [(h, t) for h, t, _ in dom.links(page)] == [("/n", "n"), ("/y", "y")] and dom.links(page)[1][2] == "y near"
    assert dom.choices(page) == [('[id^="post_message_"]', "One\nTwo &\nthree")]
    ld = '<script type="application/ld+json">{"@graph":[{"x":1},{"articleBody":"Body &amp; text"}]}</script><p>s</p>'
    assert dom.choices(ld) == [("jsonld:articleBody", "Body & text")]
    assert dom.choices("plain &lt; text") == [("plain", "plain < text")] and dom.choices("") == []
    assert dom.feed_links('<link rel="alternate" type="application/rss+xml" href="/f"><link rel=icon href=x>') == ["/f"]
    assert dom.excerpt("<body><header>h</header><p>a</p>\n<p>b</p>") == "a\nb"


@pytest.mark.parametrize("doc", [None, "", "<", "<a", "<a href=", "</p></p>", "<!--", "<p" * 50])
def test_dom_takes_anything(doc):
    dom.links(doc), dom.choices(doc), dom.blocks(doc), dom.excerpt(doc), dom.feed_links(doc)
