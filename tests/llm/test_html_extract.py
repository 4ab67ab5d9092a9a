import html
import re

import pytest

from linkflow.llm import html_extract, queries

BODY = "A paragraph of the article, with several commas, and enough words to count as text. " * 3


def page(inner, around=""):
    return f"<!DOCTYPE html><html><head><title>Site</title><style>p{{}}</style></head><body><nav><ul><li><a href=/a>Menu</a></ul></nav>{around}{inner}<footer>&copy; foot</footer><script>var t='</p>';</script></body></html>"


def test_article_without_boilerplate():
    inner = f"<article><header>Head</header><h1>Title &amp; more</h1><p>{BODY}<p>Second&nbsp;one\n  here<br>next</p><aside>side</aside><div class='share-buttons'>Share</div><div id=comments><p>{BODY}</p></div><form><p>Sign up</p></form></article>"
    got = html_extract.main_text(page(inner, "<div class=ad>Buy this</div><div class='cookie-notice'><p>We use cookies, really.</p></div>"))
    assert got == f"Title & more\n{BODY.strip()}\nSecond one here next"


def test_divs_without_semantics():
    inner = f"<div id=main2><div class=story><p>{BODY}</p><p>{BODY}</p><ul><li>point</li></ul></div><div class=links><a href=1>{'link words ' * 30}</a></div></div>"
    got = html_extract.main_text(page(inner)).split("\n")
    assert got == [BODY.strip(), BODY.strip(), "point"]


def test_text_of_formulas_and_stand_ins_stays():
    got = html_extract.main_text(f"<article><p>{BODY}</p><p>Math <math><mi>x</mi><mo>=</mo><mn>2</mn></math> done</p><object>Seen <b>instead</b></object><noscript><p>Without scripts</p></noscript><svg><title>tip</title><text>Label</text></svg><template>not shown</template></article>")
    assert got == f"{BODY.strip()}\nMath x=2 done\nSeen instead\nWithout scripts\nLabel"


def test_short_articles_side_by_side_stay_and_link_lists_do_not():
    short = "A few words of news, and more."
    cards = "".join(f"<article><a href={i}>{'Card ' * 20}</a></article>" for i in range(3))
    got = html_extract.main_text(page(f"<div><article><p>{short}</p></article><article><p>{short} Two.</p></article>{cards}</div>"))
    assert got == f"{short}\n{short} Two."


def test_sections_of_an_article_stay_together():
    inner = "<main>" + "".join(f"<section><h2>Part {i}</h2><p>{BODY}</p></section>" for i in range(3)) + "</main>"
    assert html_extract.main_text(page(inner)).count("Part") == 3


@pytest.mark.parametrize("source", [None, "", "<", "<p", "<!--", "<script>x", "<p title='a>b", "</p></div>", "<div>" * 3000, "&#0;&amp", "<p>" * 2000 + "x"])
def test_takes_anything(source):
    html_extract.main_text(source)


def test_small_pages():
    assert html_extract.main_text("just text &lt;b&gt;") == "just text <b>"
    assert html_extract.main_text("<p>One.</p><p>Two.</p>") == "One.\nTwo."
    assert html_extract.main_text("<body><nav>only menu</nav></body>") == ""


def test_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x</p>"), (3, "u", "<p>" + "long, " * 40_000 + "</p>"), (3, "u", "<p>same</p>"), (3, "u", "<p>same</p>")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    got = html_extract.extract(df).collect()
    assert len(got) == 6 and all(len(r.text) == r.n_chars for r in got) and {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_query_against_the_pages_structure(spark):
    """The test pages hold one article whose blocks are headings and paragraphs."""
    d = "/root/testdata/sf0.01"
    source = {r.page_id: r.html for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    for r in queries.op10_html_extract(spark, d).collect():
        inner = re.search("<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("name", ["content has-sidebar", "site no-sidebar", "wrap fixed-header", "post comments-open", "entry-content share-on", "layout-with-sidebar", "sidebar-right", "header-page"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_wrappers_named_like_boilerplate_keep_the_article(name, tag):
    inner = f"<div class='{name}'><{tag}><p>{BODY}</p><p>{BODY}</p></{tag}><div class='sidebar'><p>Other things to read here</p></div></div>"
    assert html_extract.main_text(page(inner, "<div class=ad>Buy this</div>")) == f"{BODY.strip()}\n{BODY.strip()}"


def test_named_boilerplate_goes_beside_an_article():
    inner = f"<div class=post><p>{BODY} <span class=share>Share</span> end</p></div><div class=related><article><p>Teaser text of another article</p></article></div><div id=comments><p>{BODY}</p><p>{BODY}</p></div>"
    assert html_extract.main_text(page(f"<main>{inner}</main>")) == f"{BODY} end".replace("  ", " ")
    assert html_extract.main_text(page(f"<div id=comments><p>{BODY}</p></div>")) == BODY.strip()


def test_deep_pages_take_linear_time():
    import time

    t = time.perf_counter()
    deep = "<div>" * 60_000 + "<p>A paragraph, long enough to be kept as the text of the page.</p>" + "<span>" * 60_000 + "</i>" * 20_000
    assert html_extract.main_text(deep).startswith("A paragraph")
    assert html_extract.main_text("<p>x</b>" * 30_000).count("x") == 30_000
    assert time.perf_counter() - t < 30


def test_generated_pages_against_their_construction(spark):
    """Pages are built at random from an article whose text is known, and parts around and inside it that are none."""
    import random

    rng = random.Random(11)
    word = lambda: rng.choice("lorem ipsum dolor sit amet consetetur é ü &amp; &lt;x&gt; 日本 100&nbsp;km &#8211;".split())
    prose = lambda n: " ".join(word() for _ in range(n)) + ", and so on."
    plain = lambda t: " ".join(html.unescape(t).split())
    noise = [
        lambda: f"<nav><ul>{''.join(f'<li><a href=/{i}>{word()}</a></li>' for i in range(5))}</ul></nav>", lambda: f"<aside><p>{prose(20)}</p></aside>", lambda: f"<div class='ad-box'>{prose(10)}</div>",
        lambda: f"<form><p>{prose(5)}</p><input name=q><button>Go</button></form>", lambda: f"<script>var a = '{word()}</p>';</script>", lambda: f"<style>p {{ color: {rng.randrange(9)} }}</style>",
        lambda: f"<section id=comments><div class=comment><p>{prose(40)}</p></div></section>", lambda: f"<!-- {prose(9)} -->", lambda: f"<div class='cookie-notice'><p>{prose(12)}</p></div>",
    ]

    def block(out):
        kind = rng.randrange(6)
        t = prose(rng.randrange(12, 60))
        if kind == 0:
            out.append(plain(t))
            return f"<h2>{t}</h2>"
        if kind == 1:
            items = [prose(6) for _ in range(rng.randrange(1, 5))]
            out += map(plain, items)
            return "<ul>" + "".join(f"<li>{i}" + rng.choice(["", "</li>"]) for i in items) + "</ul>"
        if kind == 2:
            return f"<section>{block(out)}{block(out)}</section>"
        if kind == 3:
            a, b = prose(15), prose(15)
            out.append(plain(f"{a} {b}"))
            return f"<p>{a}<br>\n {b}" + rng.choice(["", "</p>"])
        if kind == 4:
            cells = [prose(5) for _ in range(3)]
            out += map(plain, cells)
            return "<table><tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr></table>"
        out.append(plain(t))
        return rng.choice([f"<p>{t}</p>", f"<blockquote>{t}</blockquote>", f"<p><b>{t}</b></p>", f"<P CLASS=x>{t}</P>"])

    rows, want = [], {}
    for i in range(300):
        out: list[str] = []
        inner = "".join(block(out) + (rng.choice(noise)() if rng.random() < 0.3 else "") for _ in range(rng.randrange(3, 9)))
        tag = rng.choice(["article", "main", "div class='story'"])
        around = lambda: "".join(rng.choice(noise)() for _ in range(rng.randrange(3)))
        rows.append((i, "u", f"<html><head><title>{word()}</title></head><body><header>{prose(4)}</header>{around()}<{tag}>{inner}</{tag.split()[0]}>{around()}<footer>{prose(4)}</footer></body></html>"))
        want[i] = "\n".join(out)
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want
