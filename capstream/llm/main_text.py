"""Main text of web pages by line-block distribution.

The markup is stripped into lines, one per block element. Scripts, styles,
forms, navigation and whatever a page marks as advert, notice, sidebar or
comment give no lines; where such a part stood outside the article there are
``WINDOW`` blank lines. A line's weight is its length without link text (its
whole length inside an article or main element). The weights are summed over
sliding windows of ``WINDOW`` lines: text begins where the sum surges to the
page's threshold, at the first heading or longer line of that window, and ends
where it dives to zero, so everything between is kept, short lines included. The
page's own mark overrules the threshold: a stretch inside an article element
begins and ends with the element. Lines outside it take part only while the
page's article elements hold less than half of the weight.

Defined results: NULL and empty html, and pages without text, give the empty
string; unclosed elements end with the element around them, unclosed comments,
scripts and the like with the page; repeated rows and ids are ordinary rows;
an empty table gives no rows; columns other than the asked ones are ignored.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from capstream.functions.common import quoted

#: Lines whose lengths are summed.
WINDOW = 3
#: A window surges at this share of the page's largest window, and at this length at the latest.
SHARE, ENOUGH = 0.25, 120
#: UTF-8 bytes of html turned into rows at a time (one longer page goes alone).
AT_ONCE = 4 << 20

# Element names and attribute words.
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext svg math select object canvas audio video".split())
STRIPPED = frozenset("nav footer aside form noscript template menu dialog button head fieldset".split())
ARTICLE = frozenset(["article", "main"])
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub "
                   "sup time tt u var wbr nobr img input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that end an open element of the same kind.
SIBLINGS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies reply discussion".split())
MARKED_WORDS = COMMENT_WORDS | frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "disclaimer popup modal overlay newsletter subscribe subscription signup nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager "
    "alert alerts masthead topbar footer sidebar aside widget widgets related recommended recommendations teaser teasers share sharing social login search toolbar "
    "skip copyright".split())
ARTICLE_CLASSES = frozenset("article-body articlebody article-content post-body post-content entry-content story-body main-content".split())
MARKED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words beside which "header" is the article's own.
OWN_HEADER = frozenset("article post entry content section story".split())
#: Words beside which a marking word speaks of a layout ("with-sidebar").
LAYOUT_WORDS = frozenset("with has no without".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"'=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")


@functools.lru_cache(4096)
def _marks(attrs: str) -> tuple[bool, bool, bool, bool]:
    """(marked as something else than the article, as comments, as the article, as a header) by class, id and role."""
    words, classes, other, article = set(), set(), False, False
    for name, a, b, c, hidden in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), a or b or c
        if hidden:
            other = True
        elif name in ("class", "id"):
            for one in value.split():
                classes.add(one.lower())
                own = {w.lower() for w in WORDS.findall(one)} | {one.lower()}
                if not own & LAYOUT_WORDS:
                    words |= own
        elif name == "role":
            other |= value.lower() in MARKED_ROLES
            article |= value.lower() in ("main", "article")
        elif name == "aria-hidden":
            other |= value.lower() == "true"
        elif name == "itemprop":
            article |= value == "articleBody"
        elif name == "style":
            other |= "display:none" in value.replace(" ", "").lower()
    return other or bool(words & MARKED_WORDS), bool(words & COMMENT_WORDS), article or bool(classes & ARTICLE_CLASSES), "header" in words and not words & OWN_HEADER


class _Element:
    """An open element: ``dropped`` by its name, ``marked`` by its attributes, inside an article (``top``: the outermost) or a header."""

    __slots__ = ("article", "dropped", "header", "link", "marked", "name", "top", "up")

    def __init__(self, name: str, up: _Element | None):
        self.name, self.up = name, up
        self.marked = False
        self.dropped, self.article, self.header, self.link = (up.dropped, up.article, up.header, up.link) if up else (False,) * 4
        self.top = up.top if up else None

    def gone(self) -> bool:
        """Whether it, or an element around it, is no part of the article."""
        e = self
        while e is not None:
            if e.marked:
                return True
            e = e.up
        return self.dropped


class _Line:
    __slots__ = ("element", "heading", "linked", "parts")

    def __init__(self, element: _Element, heading: bool):
        self.element, self.heading, self.parts, self.linked = element, heading, [], 0


BLANK = ("", 0, False, False)


def lines_of(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, weight, inside an article, heading) of the page's lines, ``BLANK`` ones where something was stripped."""
    root = _Element("", None)
    stack, lines = [root], []
    line = _Line(root, False)

    def flush(heading: bool | None = None) -> None:
        nonlocal line
        if line.parts:
            lines.append(line)
        line = _Line(stack[-1], line.heading if heading is None else heading)

    def text(piece: str) -> None:
        if piece and not stack[-1].dropped:
            line.parts.append(piece)
            if stack[-1].link:
                line.linked += len(piece)

    at, size = 0, len(page)
    lower = None  # lower-cased page, for the ends of raw elements
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at, name = m.end(), m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in RAW and not m["end"]:
            if not m["attrs"].endswith("/") or name in ("script", "style", "title", "textarea"):
                if lower is None:
                    lower = page.lower() if len(page.lower()) == size else re.sub("[A-Z]", lambda x: x[0].lower(), page)
                end = lower.find(f"</{name}", at)
                at = size if end < 0 else end
            text(" ")
        elif name == "br":
            text(" ")
        elif m["end"]:
            place = len(stack) - 1
            while place > 0 and stack[place].name != name and not (name in INLINE and stack[place].name not in INLINE):
                place -= 1
            if place > 0 and stack[place].name == name:
                del stack[place:]
                if name not in INLINE:
                    flush(False if name in HEADINGS else None)
                elif line.element is not stack[-1] and not line.parts:
                    line.element = stack[-1]
            elif name not in INLINE:
                flush()
        else:
            _open(name, m["attrs"], stack, flush)
    flush()
    return _weighed(lines)


def _open(name: str, attrs: str, stack: list[_Element], flush) -> None:
    if name not in INLINE:
        while len(stack) > 1 and stack[-1].name in INLINE and any(e.name in SIBLINGS.get(name, ()) for e in stack[-4:]):
            stack.pop()  # inline elements left open in an element that ends here
        if stack[-1].name in SIBLINGS.get(name, ()) or (stack[-1].name == "p" and name not in VOID):
            stack.pop()
    if name in VOID or attrs.endswith("/") and name not in ARTICLE and name not in STRIPPED:
        if name not in INLINE:
            flush()
        return
    e = _Element(name, stack[-1])
    marked, comments, article, header = _marks(attrs) if len(attrs) > 4 and name not in ("html", "body", "a") else (False,) * 4
    if name in ARTICLE or article:
        if not (comments or (marked and name not in ARTICLE)):
            e.article = True
            e.top = e.top or e
        else:
            e.marked = True
    else:
        e.marked = marked
        e.dropped |= name in STRIPPED
        e.header |= header or name == "header"
    e.link |= name == "a"
    stack.append(e)
    if name not in INLINE:
        flush(name in HEADINGS)


def _articles_in_marked_parts(lines: list[_Line]) -> None:
    """When no article stands outside marked parts, and little else does, what holds the longest one is a layout, whatever its words."""
    held: dict[_Element, int] = {}
    outside = 0
    for line in lines:
        size = sum(map(len, line.parts))
        if not line.element.gone():
            if line.element.article:
                return
            outside += 0 if line.element.header else size - line.linked
        elif line.element.article:
            held[line.element.top] = held.get(line.element.top, 0) + size
    if held and 2 * outside < max(held.values()):
        up = max(held, key=held.get).up
        while up is not None:
            up.marked = False
            up = up.up


def _weighed(lines: list[_Line]) -> list[tuple[str, int, bool, bool]]:
    _articles_in_marked_parts(lines)
    out, last_inside, gap = [], None, False
    for line in lines:
        e = line.element
        # a header holds the article's title at most
        if e.gone() or (e.header and not (e.article and line.heading)):
            gap |= not e.article
            continue
        told = " ".join(entities.unescape("".join(line.parts)).split())
        if not told:
            continue
        if last_inside is not None and (gap and not (e.article and last_inside) or e.article != last_inside):
            out += [BLANK] * WINDOW
        gap, last_inside = False, e.article
        own = sum(map(len, line.parts))
        out.append((told, len(told) if e.article else len(told) * (own - line.linked) // max(1, own), e.article, line.heading))
    return out


def main_text(page: str) -> str:
    """The text between every surge and its dive, lines joined by one space."""
    lines = lines_of(page)
    inside = sum(x[1] for x in lines if x[2])
    if inside and 2 * inside >= sum(x[1] for x in lines):
        lines = [x if x[2] else BLANK for x in lines]
    n = len(lines)
    weights = [x[1] for x in lines] + [0] * WINDOW
    sums = [sum(weights[i:i + WINDOW]) for i in range(n)]
    surge = max(1, min(ENOUGH, int(SHARE * max(sums, default=0))))
    kept, at = [], 0
    while at < n:
        if sums[at] == 0:
            at += 1
            continue
        dive = next((j for j in range(at, n) if sums[j] == 0), n)
        if any(x[2] for x in lines[at:dive]):
            kept += [x[0] for x in lines[at:dive] if x[0]]
        else:
            begin = next((i for i in range(at, dive) if sums[i] >= surge), dive)
            while begin < dive and not lines[begin][3] and lines[begin][1] < surge // 4:
                begin += 1
            kept += [x[0] for x in lines[begin:dive] if x[0]]
        at = dive
    return " ".join(kept)


def extract(df: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` (its code points) of every page.

    Memory per task: one Arrow batch and the lines of one page.
    """
    rows = df.select(*[quoted(c).alias(f"_{i}") for i, c in enumerate(keep)], quoted(html_col).cast("string").alias("_html"))
    schema = StructType([StructField(c, df.schema[c].dataType) for c in keep]).add("text", "string").add("n_chars", "long")
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages, texts, held, first = b.column(b.num_columns - 1), [], 0, 0
            for i in range(len(pages)):
                page = pages[i].as_py() or ""
                texts.append(main_text(page))
                held += len(page)
                if held >= AT_ONCE or i + 1 == len(pages):
                    own = b.slice(first, len(texts))
                    told = pa.array(texts, pa.string())
                    columns = [*own.columns[:-1], told, pa.array([len(t) for t in texts], pa.int64())]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target, strict=True)], schema=target)
                    texts, held, first = [], 0, i + 1

    return rows.mapInArrow(run, schema)
