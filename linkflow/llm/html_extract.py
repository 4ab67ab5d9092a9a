"""Main text of HTML pages by tree scoring.

A page is cut into tags and text by one regular expression, and a tree of elements is built with
HTML's implied end tags. Text gathers in blocks. Each paragraph passes points for its length and
its commas to its ancestors (half of them per level; items of lists and cells of tables to what holds
the list or table, which is never the best element itself); an element's points are discounted by its
link density. The best element, or the ``article``/``main`` that holds it, and those of its
siblings that read like text are kept, without boilerplate elements inside. An element is also
boilerplate by a name in its class or id (``STATES`` such as ``has-sidebar`` are no such names); but
a wrapper that holds at least half of the text of the page's ``article`` and ``main`` elements (of
the page, if these have none) stays, unless named as comments, and where no text would be left
outside of named elements, names do not count. Articles beside the best one stay if they are text and
not links, however short. Only elements whose content is no text of the page (``RAW``) go unread:
formulas, drawings, and what stands in for scripts and players is text like any other.

Defined results: null, empty or text-free html gives an empty text; a page without tags is one
block; unclosed tags, comments and quotes end with the page; a tie of points goes to the element
that comes first; repeated rows give repeated results; extra columns are not carried.
"""

from __future__ import annotations

import html as _html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import batch

# HTML element names by the role they play here.
RAW = frozenset("script style template textarea title iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav header footer aside form menu button select option fieldset label dialog head datalist".split())
BLOCK = frozenset(
    "html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre hr figure figcaption address details summary center nav header footer aside form menu fieldset dialog head".split()
)
#: Parts of lists and tables: their items' points go to what holds the list or table.
FRAME = frozenset("ul ol dl menu table thead tbody tfoot tr".split())
PARAGRAPH = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6 figcaption".split())
# A start tag of the key's kind closes an open element of the values, up to the nearest limit.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})
}
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar|side-?bar|nav\w*|menu|breadcrumbs?|footer|header|masthead|comments?|commentlist|disqus|respond|replies|reply|related|recommend\w*|share|sharing|social|newsletter|subscribe|signup|popup|modal|overlay|cookie\w*|consent|gdpr|notices?|alert|widget|pagination|pager|toolbar)(?=$|[\s_-])",
    re.I
)
ROLES = re.compile(r"\brole\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|dialog|alert|menu|form)\b", re.I)

#: Names that tell what an element has or how it is shown, not what it is.
STATES = re.compile(
    r"(?:^|[_-])(?:has|no|with|without)[_-]|^(?:is|not|fixed|sticky|show|hide|enable|disable)[_-]|[_-](?:open|closed|on|off|enabled|disabled|active|visible)$",
    re.I
)
COMMENTS = re.compile(r"(?:^|[_-])(?:comments?|commentlist|disqus|respond|replies|reply)(?=$|[_-])", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


class _Page:
    """Elements as parallel lists (parent, tag, dropped) and blocks of (element, text, link characters)."""

    def __init__(self, source: str, gone: frozenset[int] = frozenset()):
        self.parent, self.tag, self.dropped = [-1], ["#root"], [False]
        #: Elements that are dropped by their names; those that have such names, and if as comments.
        self.gone, self.named = gone, {}
        self.blocks: list[tuple[int, str, int]] = []
        #: The nearest block element that an element is in, itself included.
        self.block = [0]
        self._stack, self._parts, self._links, self._in_link = [0], [], 0, 0
        #: Depths of the open elements by name, and of all open block elements: no tag scans the stack.
        self._depths: dict[str, list[int]] = defaultdict(list)
        self._blocks_open: list[int] = []
        self._parse(source)

    def _flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.blocks.append((self.block[self._stack[-1]], text, min(self._links, len(text))))
        self._parts, self._links = [], 0

    def _text(self, raw: str) -> None:
        if raw and not self.dropped[self._stack[-1]]:
            raw = _html.unescape(raw)
            self._parts.append(raw)
            if self._in_link:
                self._links += len(raw.strip())

    def _pop_to(self, depth: int) -> None:
        while len(self._stack) > depth:
            name = self.tag[self._stack[-1]]
            if name in BLOCK:
                self._flush()
                self._blocks_open.pop()
            if name == "a":
                self._in_link -= 1
            self._depths[name].pop()
            self._stack.pop()

    def _nearest(self, names) -> int:
        """The depth of the innermost open element of these names, 0 if there is none."""
        return max((self._depths[x][-1] for x in names if self._depths.get(x)), default=0)

    def _close_open(self, names, limits) -> None:
        depth = self._nearest(names)
        if depth > self._nearest(limits):
            self._pop_to(depth)

    def _start(self, name: str, attrs: str) -> None:
        if name in BLOCK:
            self._flush()
            self._close_open({"p"}, {"td", "th", "table", "button", "object"})
        if name in CLOSES:
            self._close_open(*CLOSES[name])
        if name == "br":
            self._text(" ")
        if name in VOID:
            return
        up = self._stack[-1]
        own = bool(attrs) and name not in ("html", "body", "article", "main")
        drop = self.dropped[up] or name in BOILERPLATE or len(self.tag) in self.gone or (own and bool(ROLES.search(attrs) or _HIDDEN.search(attrs)))
        if own and not drop and (names := self._unlikely(attrs)):
            self.named[len(self.tag)] = any(map(COMMENTS.search, names))
        if not drop and name == "article" and attrs and re.search(r"comment", attrs, re.I):
            drop = True
        self.parent.append(up)
        self.tag.append(name)
        self.dropped.append(drop)
        self.block.append(len(self.tag) - 1 if name in BLOCK else self.block[up])
        self._depths[name].append(len(self._stack))
        if name in BLOCK:
            self._blocks_open.append(len(self._stack))
        self._stack.append(len(self.tag) - 1)
        if name == "a":
            self._in_link += 1

    @staticmethod
    def _unlikely(attrs: str) -> list[str]:
        names = (x for m in _NAMES.finditer(attrs) for x in next(filter(None, m.groups()), "").split())
        return [x for x in names if UNLIKELY.search(x) and not STATES.search(x)]

    def by_name(self) -> frozenset[int]:
        """The elements to drop by their names, of a page read without that."""
        n = len(self.tag)
        every, inside, article = [0] * n, [0] * n, [False] * n
        for i in range(1, n):
            article[i] = article[self.parent[i]] or (self.tag[i] in ("article", "main") and not self.dropped[i])
        for at, text, linked in self.blocks:
            if self.tag[at] in PARAGRAPH or len(text) >= 25:
                every[at] += len(text) - linked
                inside[at] += (len(text) - linked) * article[at]
        for i in range(n - 1, 0, -1):
            every[self.parent[i]] += every[i]
            inside[self.parent[i]] += inside[i]
        held = inside if inside[0] else every
        gone = frozenset(i for i, comments in self.named.items() if comments or not 0 < held[0] <= 2 * held[i])
        out = [False] * n
        for i in range(1, n):
            out[i] = out[self.parent[i]] or i in gone
        left = any(not out[at] and (self.tag[at] in PARAGRAPH or len(text) >= 25) for at, text, _ in self.blocks)
        return gone if left or not every[0] else frozenset()

    def _end(self, name: str) -> None:
        depth = self._nearest((name,))
        if depth and (name in BLOCK or not self._blocks_open or self._blocks_open[-1] < depth):
            self._pop_to(depth)

    def _parse(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            m = _TOKEN.search(source, at)
            if not m:
                break
            self._text(source[at : m.start()])
            at = m.end()
            name = m[2]
            if not name:
                continue
            name = name.lower()
            if m[1]:
                if name == "p" and not self._depths["p"]:
                    continue
                self._end(name)
            elif name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
                at = close.end() if close else end
            else:
                self._start(name, m[3])
        self._text(source[at:])
        self._pop_to(1)
        self._flush()

    def main(self) -> list[str]:
        if not self.blocks:
            return []
        n = len(self.tag)
        points, chars, links = [0.0] * n, [0] * n, [0] * n
        for at, text, linked in self.blocks:
            chars[at] += len(text)
            links[at] += linked
            paragraph = self.tag[at] in PARAGRAPH
            if paragraph or len(text) >= 25:
                got = 1 + text.count(",") + text.count("，") + text.count("、") + min(len(text) / 100, 3)
                to = self.parent[at] if paragraph else at
                while self.tag[to] in FRAME:
                    to = self.parent[to]
                points[to] += got
        # Children have larger numbers than their parents: sums, and half of the points, pass upwards.
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            chars[up] += chars[i]
            links[up] += links[i]
            points[up] += points[i] / 2
        points[0] = 0.0
        score = [p * (1 - links[i] / chars[i]) if chars[i] else 0.0 for i, p in enumerate(points)]
        best = max(range(n), key=lambda i: (score[i], -i))
        if score[best] <= 0:
            return [text for _, text, _ in self.blocks]
        up = best
        while up > 0:
            if self.tag[up] in ("article", "main"):
                best = up
                break
            up = self.parent[up]
        keep = {best}
        for i in range(1, n):
            if i != best and self.parent[i] == self.parent[best] and self.tag[best] not in ("html", "body") and chars[i]:
                density = links[i] / chars[i]
                if score[i] >= max(10, score[best] / 5) or (self.tag[i] == self.tag[best] == "article" and density < 0.25) or (self.tag[i] in PARAGRAPH and (chars[i] > 80 and density < 0.25)):
                    keep.add(i)
        inside = [False] * n
        for i in range(n):
            inside[i] = i in keep or (i > 0 and inside[self.parent[i]])
        return [text for at, text, _ in self.blocks if inside[at]]


def main_text(source: str | None) -> str:
    """The main text of one page; blocks are joined by newlines."""
    if not source:
        return ""
    page = _Page(source)
    if page.named and (gone := page.by_name()):
        page = _Page(source, gone)
    return "\n".join(page.main())


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages(page_id, url, html)``."""

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                p = b.slice(i, 256)
                texts = [main_text(h.as_py()) for h in p.column(2)]
                yield batch(_SCHEMA, p.column(0), p.column(1).cast(pa.string()), texts, list(map(len, texts)))

    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).mapInArrow(run, "page_id long, url string, text string, n_chars long")
