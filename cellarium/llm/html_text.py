"""Main text of web pages by scoring the element tree.

A page is read into a tree (unclosed and misnested elements allowed).  Scripts, navigation,
forms, asides, hidden parts and elements whose class, id or role names such a thing are set aside; a name alone
does not set aside what holds most of the prose, or a section of an article with a heading and prose.
Comments go wherever they stand, articles nested in the article included.
Every paragraph earns points for its length and commas; its parent gets all of them, the next
ancestor half, those above a third of the one below.  An element's points are discounted by the
share of its text that lies in links.  The best container is kept whole, and of its siblings those that
score a fifth of it, hold prose, are a heading, or are loose text that reads like prose.

Each step is one pass over the page: tags are cut by hand, open elements are found by
tag, and text is summed bottom up.  Once a tag's quotes run to the end of the page, quotes bind no more in it.

Pages are rows of their own: no shuffle, any number of tasks.  Null html is empty and gives an
empty text, as does a page without text; page_id and url pass through, nulls included.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellarium.llm.common import batches

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
UNQUOTED = re.compile(r"[^>\"']*")
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - frozenset("td th tr tbody thead tfoot option optgroup body html head".split())
# An open element of these kinds ends when another of its group starts, unless a fence lies between.
ALIKE = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
FENCES = frozenset(
    "html body article section main div td th table aside nav header footer form li dd blockquote "
    "button figure fieldset details dialog".split()
)

# Never part of an article.
ASIDE_TAGS = frozenset(
    "script style noscript template iframe nav footer header aside form button select textarea input "
    "svg canvas object embed dialog menu head title search".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored sponsors promo "
    "promotion promoted cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "menu nav navbar navigation topnav subnav breadcrumb breadcrumbs sidebar sidebars aside rail footer footnav "
    "header masthead topbar toolbar comment comments commentlist disqus discussion respond reply replies "
    "share sharing social related recommended newsletter subscribe subscription signup login "
    "pager pagination widget widgets skip hidden".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())
# Names that sections of an article have as well.
SECTION_NAMES = frozenset("discussion notice notices header related banner hidden".split())
# What stands before a name in classes that tell of a layout, not of the element's own purpose.
LAYOUT = frozenset("no not has have with without is".split())
COMMENT_HEADING = re.compile(r"\W*\d*\s*(?:(?:reader|user|visitor)s?\W*)?(?:comments?|replies|responses)\b.{0,20}", re.I | re.S)
NAME = re.compile(r"[a-z0-9]+")
PARAGRAPHS = frozenset("p pre td th blockquote li dd dt figcaption".split())
PROSE = 80  # characters of a paragraph that reads like prose
SENTENCE_END = re.compile(r"[.!?…](?:[\"'”»)]*)(?:\s|$)")


class Element:
    __slots__ = ("tag", "names", "role", "hidden", "parent", "children", "points", "size", "linked", "commas", "prose", "paragraphs")

    def __init__(self, tag: str, attrs: str, parent: Element | None):
        self.tag, self.parent, self.children, self.points = tag, parent, [], 0.0
        # Of the whole element: characters, those in links, commas, characters and number of prose paragraphs.
        self.size = self.linked = self.commas = self.prose = self.paragraphs = 0
        self.names, self.role, self.hidden = (), "", False
        if attrs and not attrs.isspace():
            self._read(attrs)

    def _read(self, attrs: str) -> None:
        names = []
        for m in ATTR.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                for name in value.split():
                    words = NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
                    if not LAYOUT.intersection(words[:-1]):
                        names += words
            elif key == "role":
                self.role = value.strip().lower()
            elif key == "hidden" or (key == "aria-hidden" and value.strip().lower() == "true"):
                self.hidden = True
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                self.hidden = True
        self.names = names


class Open:
    """The open elements, with the places of each tag and of the fences among them."""

    def __init__(self, root: Element):
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}
        self.fences: list[int] = []
        self.push(root)

    def push(self, element: Element) -> None:
        at = len(self.stack)
        self.places.setdefault(element.tag, []).append(at)
        if element.tag in FENCES:
            self.fences.append(at)
        self.stack.append(element)

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            gone = self.stack.pop()
            self.places[gone.tag].pop()
            if gone.tag in FENCES:
                self.fences.pop()

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def close(self, tag: str) -> None:
        at = self.last(HEADINGS if tag in HEADINGS else (tag,))
        # An inline end tag does not reach over the block it stands in.
        if at > 0 and (tag in BLOCKS or at >= self.fences[-1]):
            self.cut(at)

    def end(self, kinds: set, fence: int) -> None:
        """Ends the elements of some kinds above a fence."""
        above = [p[bisect(p, max(fence, 0))] for p in map(self.places.get, kinds) if p and p[-1] > max(fence, 0)]
        if above:
            self.cut(min(above))

    def make_room(self, tag: str) -> None:
        """Ends open elements that the start of ``tag`` ends."""
        if tag in CLOSES_P:
            self.end({"p"}, self.fences[-1])
        if tag in ALIKE:
            kinds, fences = ALIKE[tag]
            self.end(kinds, self.last(fences - kinds))
        elif tag == "body":
            self.end({"head"}, self.last({"html"}))


def parse(page: str) -> Element:
    root = Element("html", "", None)
    opened, at, size = Open(root), 0, len(page)
    stack = opened.stack
    last_end, last_cdata = page.rfind(">"), page.rfind("]]>")
    quoted = True
    while at < size:
        start = page.find("<", at)
        if start < 0:
            _text(stack[-1], page[at:])
            break
        if start > at:
            _text(stack[-1], page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else size
            continue
        if last_end < start:
            # No tag ends any more.
            _text(stack[-1], page[start:])
            break
        if page.startswith("<![CDATA[", start) and last_cdata > start:
            end = page.find("]]>", start)
            stack[-1].children.append(page[start + 9 : end])
            at = end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            at = page.find(">", start) + 1
            continue
        ending = page.startswith("/", start + 1)
        name = TAG_NAME.match(page, start + 1 + ending)
        if name is None:
            _text(stack[-1], "<")
            at = start + 1
            continue
        end = _tag_end(page, name.end()) if quoted else -1
        if end < 0:
            quoted, end = False, page.find(">", name.end())
        tag, attrs, at = name[0].lower(), page[name.end() : end], end + 1
        if ending:
            opened.close(tag)
            continue
        if tag == "html" or (tag == "body" and opened.places.get(tag)):
            continue
        opened.make_room(tag)
        element = Element(tag, attrs, stack[-1])
        stack[-1].children.append(element)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|$)[^>]*>?", re.I).search(page, at)
            at = close.end() if close else size
        elif tag not in VOID and not (attrs.endswith("/") and tag in ("svg", "path")):
            opened.push(element)
    return root


def _tag_end(page: str, at: int) -> int:
    """The place of the first > that is not in quotes, -1 if there is none."""
    while True:
        at = UNQUOTED.match(page, at).end()
        if at >= len(page) or page[at] == ">":
            return at if at < len(page) else -1
        at = page.find(page[at], at + 1) + 1
        if not at:
            return -1


def _text(element: Element, raw: str) -> None:
    element.children.append(html.unescape(raw) if "&" in raw else raw)


def measure(root: Element) -> None:
    """Sums text bottom up."""
    for element in reversed(_tree(root)):
        own = [c for c in element.children if isinstance(c, str)]
        inner = [c for c in element.children if not isinstance(c, str)]
        element.size = sum(len(" ".join(c.split())) for c in own) + sum(c.size for c in inner)
        element.commas = sum(c.count(",") for c in own) + sum(c.commas for c in inner)
        element.linked = element.size if element.tag == "a" else sum(c.linked for c in inner)
        element.prose, element.paragraphs = sum(c.prose for c in inner), sum(c.paragraphs for c in inner)
        if element.tag in ("script", "style", "template", "noscript", "form"):
            element.prose = element.paragraphs = 0
        elif element.tag in PARAGRAPHS and not element.paragraphs and element.size >= PROSE and density(element) < 0.25:
            element.prose, element.paragraphs = element.size, 1


def _tree(root: Element) -> list[Element]:
    """All elements, parents before children, in page order."""
    found, todo = [], [root]
    while todo:
        element = todo.pop()
        found.append(element)
        todo.extend(c for c in reversed(element.children) if not isinstance(c, str))
    return found


def density(element: Element) -> float:
    return element.linked / element.size if element.size else 0.0


def _set_aside(element: Element, in_article: bool, page: Element) -> bool:
    tag, names = element.tag, set(element.names)
    if element.hidden or element.role in ASIDE_ROLES or element.role == "comment":
        return True
    if tag in ASIDE_TAGS:
        return not (tag == "header" and in_article and _heading(element) is not None)
    if tag in ("html", "body", "main") or tag in HEADINGS:
        return False
    outside = page.prose - element.prose
    if names & COMMENT_NAMES and (tag != "article" or in_article or outside):
        return outside > 0 or not element.paragraphs
    if tag == "article":
        return False
    heading = _heading(element) if in_article and tag in ("section", "div") else None
    if heading is not None and any(c.tag in ("article", "li", "ol", "ul") for c in _elements(element)):
        if COMMENT_HEADING.fullmatch(text_of(heading)):
            return True
    if not names & ASIDE_NAMES:
        return False
    if element.paragraphs >= 3 and 2 * element.prose > page.prose:
        return False
    section = heading is not None and tag == "section" and element.paragraphs and density(element) < 0.25
    return not (section and names & ASIDE_NAMES <= SECTION_NAMES)


def _elements(element: Element) -> list[Element]:
    return [c for c in element.children if not isinstance(c, str)]


def _heading(element: Element) -> Element | None:
    return next((c for c in _elements(element) if c.tag in HEADINGS), None)


def prune(root: Element) -> list[Element]:
    """Takes out what is set aside; the elements left, parents before children."""
    kept, todo = [], [(root, False)]
    while todo:
        element, inside = todo.pop()
        kept.append(element)
        inside = inside or element.tag in ("article", "main")
        element.children = [
            c for c in element.children if isinstance(c, str) or not _set_aside(c, inside, root)
        ]
        todo.extend((c, inside) for c in reversed(element.children) if not isinstance(c, str))
    return kept


def text_of(element: Element) -> str:
    """Blocks in page order, white space inside them as one space, joined by one space."""
    parts, todo = [], [element]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
            continue
        apart = item.tag in BLOCKS or item.tag == "br"
        if apart:
            parts.append(" ")
            todo.append(" ")
        todo.extend(reversed(item.children))
    return " ".join("".join(parts).split())


def _score(kept: list[Element]) -> None:
    """Points of every element, summed bottom up: ``near`` for the parent, ``far`` for those above."""
    near = {id(e): 0.0 for e in kept}
    over = {id(e): 0.0 for e in kept}
    far = {id(e): 0.0 for e in kept}
    for element in reversed(kept):
        key, up = id(element), element.parent
        own = 0.0
        if element.tag in PARAGRAPHS:
            own = _points(element.size, element.commas)
        elif element.tag in ("div", "section", "article", "main", "body", "center"):
            # Loose text of a container counts for the container itself.
            text = " ".join(c.strip() for c in element.children if isinstance(c, str)).strip()
            near[key] += _points(len(text), text.count(","))
        element.points = near[key] + over[key] / 2 + far[key] / 6
        if up is not None:
            near[id(up)] += own
            over[id(up)] += near[key]
            far[id(up)] += over[key] + far[key] / 3


def _points(size: int, commas: int) -> float:
    return 1 + commas + min(size / 100, 3) if size else 0.0


def value(element: Element) -> float:
    return element.points * (1 - density(element))


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    measure(root)
    kept = prune(root)
    measure(root)
    _score(kept)

    best = max((e for e in kept if e.points > 0), key=value, default=None)
    if best is None:
        best = next((e for tag in ("article", "main", "body") for e in kept if e.tag == tag), root)
    up = best.parent
    while up is not None:
        # The outermost article, since those inside belong to it.
        best = up if up.tag == "article" else best
        up = up.parent
    if best.tag in ("html", "body", "article") or best.parent is None:
        return text_of(best)
    parts, loose = [], []
    for other in [*best.parent.children, None]:
        if isinstance(other, str) or (other is not None and other.tag not in BLOCKS):
            loose.append(other)
            continue
        # Loose text and inline elements in a row are a paragraph of their own.
        if loose:
            row = Element("p", "", None)
            row.children, loose = loose, []
            measure(row)
            if _belongs(row, best):
                parts.append(text_of(row))
        if other is not None and (other is best or _belongs(other, best)):
            parts.append(text_of(other))
    return " ".join(p for p in parts if p)


def _belongs(other: Element, best: Element) -> bool:
    """Whether what stands beside the best container is part of the text."""
    if other.tag in HEADINGS or (other.points and value(other) >= value(best) / 5):
        return True
    if other.prose and density(other) < 0.25:
        return True
    if other.tag not in PARAGRAPHS:
        return False
    return density(other) < 0.25 and SENTENCE_END.search(text_of(other)) is not None


def _extract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 256):
        texts = [main_text(x.as_py()) for x in batch.column(2)]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes],
            names=["_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``key``, url, text and n_chars of every page."""
    rows = pages.select(F.col(key).alias("_id"), F.col("url").cast("string"), F.col("html"))
    kind = rows.schema["_id"].dataType.simpleString()
    out = rows.mapInArrow(_extract, f"_id {kind}, url string, text string, n_chars bigint")
    return out.withColumnRenamed("_id", key)
