"""A page as flat arrays on the standard library's HTML parser, for what expressions cannot do.

Elements are numbered in document order and pieces of text in reading order, so an element is an
interval of both. Each reading of a page (links, text, blocks, excerpt) first mutes the elements
that it leaves out, with all that they hold, and then works on intervals.

The contract is well-formed-ish HTML: void elements, implied ends of ``p``, ``li``, table cells and
options, and unclosed formatting are handled; full HTML5 tree repair is not.
"""

from __future__ import annotations

import html as _html
import json
import re
from collections import Counter
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser
from itertools import groupby

# Element roles, and where content is looked for, in the order of preference.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SCOPES = frozenset("table ul ol dl select div article section main body html td th".split())
CONTENT = (
    "article", "main", '[role="main"]', '[id^="post_message_"]', ".postcontent", ".postbody", ".entry-content", ".post-content", ".article-content",
    ".blog-post-content", ".single-post-content", ".td-post-content",
)
HIDDEN = frozenset(("script", "style", "noscript", "svg"))
MARGIN = frozenset(("nav", "footer", "header"))
NOISE_TAGS = HIDDEN | MARGIN | {"form", "aside"}
NOISE_CLASSES = frozenset(("cookie", "cookies", "newsletter", "social-share", "related-posts"))
BODY_KEY = "articleBody"
BODY_PARENTS = ("@graph", "mainEntity", "itemListElement")

_AMPERSAND = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")

# The preference of each content role, by what an element shows of itself.
_BY_TAG = {s: i for i, s in enumerate(CONTENT) if s[0] not in ".["}
_BY_CLASS = {s[1:]: i for i, s in enumerate(CONTENT) if s[0] == "."}
_ROLE_MAIN, _POST_ID = CONTENT.index('[role="main"]'), CONTENT.index('[id^="post_message_"]')


class Page(HTMLParser):
    """``tag``, ``attrs``, ``parent``, ``stop`` (number past the last element inside) and ``text`` (interval of pieces) by element."""

    def __init__(self, document: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.attrs, self.parent = ["#root"], [{}], [-1]
        self.stop, self.text = [0], [[0, 0]]
        self.pieces: list[str] = []
        self.owner: list[int] = []
        self._open, self._count = [0], Counter()
        self.feed(document)
        self.close()
        self._leave(0)
        self._end(0)

    def _end(self, i: int) -> None:
        self.stop[i], self.text[i][1] = len(self.tag), len(self.pieces)

    def _leave(self, depth: int) -> None:
        """Closes all open elements deeper than ``depth`` in the stack."""
        while len(self._open) > depth + 1:
            i = self._open.pop()
            self._count[self.tag[i]] -= 1
            self._end(i)

    def handle_starttag(self, tag, attrs):
        closes = ENDS.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
        if any(self._count[c] for c in closes):
            for depth in range(len(self._open) - 1, 0, -1):
                name = self.tag[self._open[depth]]
                if name in closes:
                    self._leave(depth - 1)
                    break
                if name in SCOPES:
                    break
        i = len(self.tag)
        self.tag.append(tag)
        self.attrs.append({k: v or "" for k, v in reversed(attrs)})
        self.parent.append(self._open[-1])
        self.stop.append(i + 1)
        self.text.append([len(self.pieces)] * 2)
        if tag not in VOID:
            self._open.append(i)
            self._count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._leave(len(self._open) - 2)

    def handle_endtag(self, tag):
        if self._count[tag]:
            depth = next(d for d in range(len(self._open) - 1, 0, -1) if self.tag[self._open[d]] == tag)
            self._leave(depth - 1)

    def handle_data(self, data):
        self.pieces.append(data)
        self.owner.append(self._open[-1])

    def muted(self, tags: frozenset[str], classes: frozenset[str] = frozenset()) -> list[bool]:
        """Which elements are of these tags or classes, or lie within one."""
        out = [False] * len(self.tag)
        for i in range(1, len(out)):
            out[i] = out[self.parent[i]] or self.tag[i] in tags or (bool(classes) and not classes.isdisjoint(self.attrs[i].get("class", "").split()))
        return out

    def read(self, i: int, mute: list[bool]) -> Iterator[str]:
        """The stripped pieces of text within an element, without what is muted."""
        a, b = self.text[i]
        return (self.pieces[j].strip() for j in range(a, b) if not mute[self.owner[j]])


def _closed(text: str) -> str:
    """``text`` with every ampersand that begins no known reference closed by a semicolon written as ``&amp;``."""
    return _AMPERSAND.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else "&amp;" + (m[1] or ""), text)


def clean(text: str, closed: bool = False) -> str:
    """References decoded, lines with single spaces, without blank lines and direct repeats.

    HTML also reads references without a semicolon (``&amp`` at a cut, ``&copy2020``); with ``closed``,
    here and in the readings below, these are text.
    """
    text = _html.unescape(_closed(text or "") if closed else text or "")
    lines = (re.sub(r"[\t\r\f\v ]+", " ", x).strip() for x in text.splitlines())
    return "\n".join(line for line, _ in groupby(filter(None, lines)))


def links(document: str) -> list[tuple[str, str, str]]:
    """(href, text, text of the parent) of every link, in order."""
    page = Page(document or "")
    mute = page.muted(HIDDEN)
    at = [i for i, t in enumerate(page.tag) if t == "a" and not mute[i] and "href" in page.attrs[i]]
    near = {p: " ".join(" ".join(page.read(p, mute)).split()) for p in {page.parent[i] for i in at}}
    return [(page.attrs[i]["href"], "".join(page.read(i, mute)).strip(), near[page.parent[i]]) for i in at]


def excerpt(document: str, max_chars: int = 12_000, closed: bool = False) -> str:
    """The visible lines of the page's body."""
    page = Page(_closed(document or "") if closed else document or "")
    mute = page.muted(HIDDEN | MARGIN)
    body = next((i for i, t in enumerate(page.tag) if t == "body" and not mute[i]), 0)
    lines = (line.strip() for x in page.read(body, mute) for line in x.splitlines())
    return "\n".join(filter(None, lines))[:max_chars]


def article_body(page: Page) -> str:
    """The first non-blank article body of the page's JSON-LD: a work list, depth first."""
    for i, tag in enumerate(page.tag):
        if tag != "script" or page.attrs[i].get("type") != "application/ld+json":
            continue
        a, b = page.text[i]
        try:
            todo = [json.loads("".join(page.pieces[a:b]))]
        except ValueError:
            continue
        while todo:
            value = todo.pop()
            if isinstance(value, list):
                todo += reversed(value)
            elif isinstance(value, dict):
                if isinstance(body := value.get(BODY_KEY), str) and body.strip():
                    return body
                todo += [value[k] for k in reversed(BODY_PARENTS) if k in value]
    return ""


def _by_role(page: Page, mute: list[bool]) -> list[list[int]]:
    """The elements of each content role, in one pass; an element may have several."""
    out: list[list[int]] = [[] for _ in CONTENT]
    for i in range(1, len(page.tag)):
        if mute[i]:
            continue
        own = page.attrs[i]
        roles = {_BY_CLASS[c] for c in own.get("class", "").split() if c in _BY_CLASS}
        if page.tag[i] in _BY_TAG:
            roles.add(_BY_TAG[page.tag[i]])
        if own.get("role") == "main":
            roles.add(_ROLE_MAIN)
        if own.get("id", "").startswith("post_message_"):
            roles.add(_POST_ID)
        for r in roles:
            out[r].append(i)
    return out


def _is_markup(document: str | None) -> bool:
    return bool(document) and ("<" in document or ">" in document)


def choices(document: str, closed: bool = False) -> list[tuple[str, str]]:
    """(method, text) of all candidates for a document's text, in the order of preference."""
    if not _is_markup(document):
        return [("plain", clean(document, closed))] if document else []
    page = Page(_closed(document) if closed else document)
    mute = page.muted(NOISE_TAGS, NOISE_CLASSES)
    whole = lambda i: clean("\n".join(page.read(i, mute)), closed)
    out = [(CONTENT[r], whole(i)) for r, at in enumerate(_by_role(page, mute)) for i in at]
    out.append(("jsonld:articleBody", clean(article_body(page), closed)))
    out = [x for x in out if x[1]]
    bodies = () if out else (i for i, t in enumerate(page.tag) if t == "body" and not mute[i])
    return out or [("body", whole(i)) for i in bodies][:1]


def longest(document: str, closed: bool = False) -> tuple[str, str]:
    """(method, text) of the longest candidate, the first of equals; ``empty`` if there is none."""
    return max(choices(document, closed), key=lambda x: len(x[1]), default=("empty", ""))


def blocks(document: str, closed: bool = False) -> list[tuple[str, str, int]]:
    """(kind, text, characters within links) of the elements that may hold content, in order of their kinds."""
    if not _is_markup(document):
        return []
    page = Page(_closed(document) if closed else document)
    mute = page.muted(NOISE_TAGS, NOISE_CLASSES)
    # Sums over the elements before: an element's links are an interval.
    linked = [0]
    for i, t in enumerate(page.tag):
        linked.append(linked[-1] + (len(clean(" ".join(page.read(i, mute)), closed)) if t == "a" and not mute[i] else 0))
    kinds = [*zip(CONTENT, _by_role(page, mute), strict=True)]
    kinds += [(k, [i for i, t in enumerate(page.tag) if t == k and not mute[i]]) for k in ("section", "div")]
    return [(k, clean("\n".join(page.read(i, mute)), closed), linked[page.stop[i]] - linked[i + 1]) for k, at in kinds for i in at]


def feed_links(document: str) -> list[str]:
    """Targets of ``link rel=alternate`` elements whose type names a feed."""
    page = Page(document or "")
    own = [a for t, a in zip(page.tag, page.attrs, strict=True) if t == "link" and a.get("href")]
    return [a["href"] for a in own if "alternate" in a.get("rel", "").lower().split() and re.search("rss|atom|xml", a.get("type", "").lower())]
