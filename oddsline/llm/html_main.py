"""Op 7. HTML extraction: tag-path ratios.

A page is read into blocks (runs of text between block-level tags), each with
its root-to-leaf tag path. Per path the text length and the punctuation are
summed and divided by the number of nodes of that path: running text sits in
paths with long, punctuated nodes, menus in paths with many short ones. The
two ratios are smoothed over neighbouring blocks, weighted down by their share
of link text, and multiplied. Paths above a threshold (a share of the best)
are content; the content element is the deepest element that holds all of their
blocks (but for those that are mostly link text), or the ``article`` or
``main`` around it, and its blocks are the article, but for link-heavy ones
outside the selection and for branches of it that hold nothing selected: a
``div``, ``section`` or the like around running text goes as a whole if every
block's path (headings aside) has a ratio below the threshold times the best path's,
so a teaser amid the article goes and a short paragraph beside the chosen
ones, a wrapped heading, list, table or figure stays.

Elements that are no article by their meaning (scripts, styles, menus,
headers and footers of the page, sidebars, forms, and elements with a class or
id whose whole name says advert, notice, comments and the like) are left out
while reading, and an ``article`` or ``main`` element counts for more. A
sidebar, form and so on is read like any other element if it holds most of the
text in ``article`` and ``main`` elements, or most of all text (outside links)
while no such element elsewhere has any (a form, or an element within an
article, also while there is only little).

White space inside a block becomes one space; blocks are joined by one line
feed in page order. Nothing else is dropped or cut.

Defined cases: null or empty html gives an empty text; broken markup is read
leniently (a block-level start tag ends an open paragraph and inline elements
in it; unknown end tags are ignored; the page may end anywhere); a page of
plain text is one block; repeated rows are extracted each for itself; extra
columns are ignored.
"""

from __future__ import annotations

import html as html_entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
BLOCK = set("""address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure
 footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section
 summary table tbody td tfoot th thead tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("""head title script style noscript template svg math canvas iframe object audio video button select
 textarea input""".split())
BESIDE = set("nav aside footer header form dialog menu".split())  # mostly no article, but they may wrap one
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_BOILERPLATE = re.compile(
    r"ads?|adverts?|advertisement|advertising|adsense|banner|sponsor(?:ed)?|promo(?:tion)?s?|cookies?|consent|gdpr|"
    r"notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|sidebars?|widgets?|menus?|"
    r"nav(?:bar|igation)?|breadcrumbs?|pagination|pager|footer|header|masthead|toolbar|share|sharing|social|related|"
    r"recommend(?:ed|ations)?|comments?|disqus|respond|replies|skip", re.I)
# Words that say where or in what form, not what: "site-footer" is a footer, "has-sidebar" is no sidebar.
_PLACES = re.compile(
    r"site|page|main|global|top|bottom|left|right|primary|secondary|upper|lower|inner|outer|sticky|fixed|area|section|"
    r"block|box|bar|container|wrapper|wrap|panel|slot|unit|list|items?|group|links?|buttons?|icons?|forms?|posts?|"
    r"articles?|stories|to|\d+", re.I)
_PUNCTUATION = ".,;:!?…。，、！？；："
# A comment, a declaration, or a tag (quoted attribute values may hold ``>``).
_MARKUP = re.compile(r"""<!--.*?(?:-->|--!>|\Z)|<[!?][^>]*(?:>|\Z)
 |<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TELLING = re.compile(r"class|id|role|hidden", re.I)
_RAW = {t: re.compile(f"</{t}(?=[\\s/>]|\\Z)", re.I) for t in ("script", "style", "textarea", "title", "xmp")}
_LEAVES = HEADINGS | {"p", "li", "td", "th", "tr", "ul", "ol", "pre", "blockquote", "dd", "dt", "dl", "tbody", "table"}
_ROOTS = {"article", "main"}
_REPEATS = {"li", "dt", "dd", "tr", "td", "th", "option"}
_NEVER_BOILERPLATE = {"html", "body", "article", "main"}
_BRANCHES = {"div", "section", "center", "details", "fieldset"}  # by themselves they say nothing of what they hold
_STRUCTURED = {"table", "pre", "blockquote", "figure", "dl", "ul", "ol"}
_KEEPS_HEADER = {"article", "main", "section"}

THRESHOLD = 0.1   # of the best path's score
MOST = 0.5        # share of the text by which an element wraps the article, whatever its name
LESS = 0.25       # text of articles elsewhere that is little, as a share of a form's own
LINKS = 0.5       # a block with more link text than this does not widen the content, and outside the selection goes


class _Element:
    """``beside``: the innermost element around it, or itself, that looks like no article;
    ``article``: the outermost article or main around it, or itself; ``tally``: characters
    of text outside links, and those of them in articles, of an element that is ``beside``."""

    __slots__ = ("tag", "name", "parent", "skip", "number", "beside", "article", "tally")

    def __init__(self, tag, name, parent, skip, number, beside):
        self.tag, self.name, self.parent, self.skip, self.number = tag, name, parent, skip, number
        self.beside = self if beside else parent and parent.beside
        self.article = parent and parent.article or (self if tag in _ROOTS else None)
        self.tally = [0, 0]


def _is_boilerplate(name: str) -> bool:
    """Whether a whole class, id or role name says so."""
    words = [w for w in re.split("[_-]+", name) if w]
    hits = sum(bool(_BOILERPLATE.fullmatch(w)) for w in words)
    return hits > 0 and all(_BOILERPLATE.fullmatch(w) or _PLACES.fullmatch(w) for w in words)


class _Reader:
    """Blocks of a page: (element, text, link characters). Text in elements that look like no
    article is only counted, but for those whose numbers are in ``wrappers``."""

    def __init__(self, page: str, wrappers: frozenset[int] = frozenset()):
        self.count = 0
        self.wrappers = wrappers
        self.total = [0, 0]
        self.asides: list[_Element] = []
        self.at = None
        self.root = self.at = self._new("#", "#", False)
        self.links = 0  # open links around the current text
        self.blocks: list[tuple] = []
        self.text: list[str] = []
        self.linked = 0
        self.owner = None
        self._read(page)
        self._end_block()

    def _read(self, page: str) -> None:
        at, search, n = 0, _MARKUP.search, len(page)
        while at < n:
            m = search(page, at)
            if m is None:
                self._data(page[at:])
                return
            if m.start() > at:
                self._data(page[at : m.start()])
            at = m.end()
            end, tag, rest = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if end:
                self._end(tag)
                continue
            self._start(tag, rest)
            if tag in _RAW:  # everything up to its end tag is no markup
                m = _RAW[tag].search(page, at)
                if m is None:
                    return
                at = m.start()
            elif rest.endswith("/") and tag not in VOID and tag not in BLOCK:
                self._end(tag)

    def _new(self, tag, name, skip, beside=False):
        self.count += 1
        e = _Element(tag, name, self.at, skip, self.count, beside and self.count not in self.wrappers)
        if e.beside is e:
            self.asides.append(e)
        return e

    def found(self) -> frozenset[int]:
        """The elements that look like no article but wrap it: they hold most of the text in
        articles, or most of all text while no article elsewhere has any (for forms, and for
        elements within an article: while it has little)."""
        text, articles = self.total
        wrappers = set()
        for e in reversed(self.asides):  # inner ones first
            if around := e.parent.beside:
                around.tally[0] += e.tally[0]
                around.tally[1] += e.tally[1]
            own, elsewhere = e.tally[0], articles - e.tally[1]
            little = LESS * own if e.article or e.tag == "form" else 0
            if (e.article is None and e.tally[1] > MOST * articles) or (own > MOST * text and (elsewhere == 0 or elsewhere < little)):
                wrappers.add(e.number)
        return frozenset(wrappers)

    def _end_block(self):
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((self.owner, text, self.linked))
            self.text, self.linked = [], 0

    def _start(self, tag, rest):
        block = tag in BLOCK
        if block:
            self._end_block()
        if tag in VOID:
            return
        if block:  # implied end tags
            e = self.at
            while e is not self.root and e.tag not in BLOCK:
                e = e.parent
            if e.tag == "p" or (e.tag in HEADINGS and tag in HEADINGS) or (e.tag == tag and tag in _REPEATS):
                self._leave(e)
        skip = self.at.skip or tag in SKIPPED
        beside = tag in BESIDE and not (tag == "header" and self._within(_KEEPS_HEADER))
        name = tag
        if rest and not skip and _TELLING.search(rest):
            marks = []
            for m in _ATTRIBUTE.finditer(rest):
                key, value = m[1].lower(), html_entities.unescape(m[2] or m[3] or m[4] or "")
                if key in ("class", "id", "role"):
                    marks.append(value)
                skip = skip or key == "hidden" or (key == "aria-hidden" and value == "true")
            if marks and tag not in _NEVER_BOILERPLATE:
                marks = " ".join(marks).split()
                beside = beside or any(map(_is_boilerplate, marks))
                name = ".".join([tag, *marks[:2]])
        self.at = self._new(tag, name, skip, beside)
        if tag == "a":
            self.links += 1

    def _leave(self, element):
        """Close an element with all inside it."""
        e = self.at
        while True:
            if e.tag == "a":
                self.links -= 1
            if e is element:
                break
            e = e.parent
        self.at = element.parent

    def _within(self, tags):
        e = self.at
        while e is not None:
            if e.tag in tags:
                return True
            e = e.parent
        return False

    def _end(self, tag):
        block = tag in BLOCK
        if block:
            self._end_block()
        e = self.at
        while e is not self.root and e.tag != tag:
            if not block and e.tag in BLOCK:
                return  # an inline end tag doesn't end a block
            e = e.parent
        if e is not self.root:
            self._leave(e)

    def _data(self, data):
        if self.at.skip:
            return
        if "&" in data:
            data = html_entities.unescape(data)
        if not self.links and (n := len(data.strip())):
            for tally in (self.total, self.at.beside.tally) if self.at.beside else (self.total,):
                tally[0] += n
                tally[1] += n if self.at.article else 0
        if self.at.beside:
            return
        if not self.text:
            self.owner = self.at
        self.text.append(data)
        if self.links:
            self.linked += len(data.strip())


def _chain(element) -> list[_Element]:
    """The root and the block-level elements down to the innermost one."""
    chain = []
    while element is not None:
        if element.tag in BLOCK or element.parent is None:
            chain.append(element)
        element = element.parent
    return chain[::-1]


def _path(element) -> tuple[str, ...]:
    """Names from the root down to the innermost block-level element."""
    while element.tag not in BLOCK and element.parent is not None:
        element = element.parent
    names = []
    while element.parent is not None:
        names.append(element.name)
        element = element.parent
    return tuple(reversed(names))


def _smooth(values: list[float]) -> list[float]:
    """A small Gaussian over neighbouring blocks."""
    kernel = (0.06, 0.24, 0.4, 0.24, 0.06)
    n, out = len(values), []
    for i in range(n):
        total = weight = 0.0
        for d, k in zip(range(-2, 3), kernel, strict=True):
            if 0 <= i + d < n:
                total, weight = total + k * values[i + d], weight + k
        out.append(total / weight)
    return out


def _tally(blocks: list[tuple], paths: list[tuple]) -> tuple[dict, dict, dict, dict]:
    """Per path: characters of text, punctuation, nodes, characters of link text."""
    length, marks, nodes, links = {}, {}, {}, {}
    for p, (_, text, linked) in zip(paths, blocks, strict=True):
        length[p] = length.get(p, 0) + len(text)
        marks[p] = marks.get(p, 0) + sum(map(text.count, _PUNCTUATION))
        nodes[p] = nodes.get(p, 0) + 1
        links[p] = links.get(p, 0) + linked
    return length, marks, nodes, links


def scores(blocks: list[tuple]) -> tuple[list[tuple], list[float]]:
    """Every block's path, and the fused score of every block."""
    paths = [_path(e) for e, _, _ in blocks]
    length, marks, nodes, links = _tally(blocks, paths)
    text_ratio = _smooth([length[p] / nodes[p] for p in paths])
    mark_ratio = _smooth([marks[p] / nodes[p] for p in paths])
    prior = [2.0 if any(n.split(".")[0] in _ROOTS for n in p) else 1.0 for p in paths]
    free = [1 - min(1.0, links[p] / max(length[p], 1)) for p in paths]
    return paths, [t * math.log1p(1 + m) * w * f for t, m, w, f in zip(text_ratio, mark_ratio, prior, free, strict=True)]


def ratios(blocks: list[tuple], paths: list[tuple]) -> dict[tuple, float]:
    """Every path's own fused ratio, not smoothed: text and punctuation per node, less its links."""
    length, marks, nodes, links = _tally(blocks, paths)
    return {p: length[p] / n * math.log1p(1 + marks[p] / n) * (1 - min(1.0, links[p] / max(length[p], 1))) for p, n in nodes.items()}


def _low_branches(blocks: list[tuple], paths: list[tuple], chosen: set, root: _Element) -> set[int]:
    """Numbers of the branches inside ``root`` without a chosen block whose paths all have low ratios."""
    holds = {root.number}  # elements that hold a chosen block
    for p, (e, _, _) in zip(paths, blocks, strict=True):
        while p in chosen and e is not None and e.number not in holds:
            holds.add(e.number)
            e = e.parent
    ratio = ratios(blocks, paths)
    least = THRESHOLD * max(ratio.values())
    low: dict[int, bool] = {}
    for p, (e, _, _) in zip(paths, blocks, strict=True):
        inside, x = [], e
        while x is not None and x.number not in holds:
            inside.append(x)
            x = x.parent
        if inside and inside[-1].tag in _BRANCHES:
            tags, number = {x.tag for x in inside}, inside[-1].number
            if not tags & HEADINGS:
                low[number] = low.get(number, True) and ratio[p] < least and not tags & _STRUCTURED
    return {n for n, is_low in low.items() if is_low}


def main_text(html: str | None) -> str:
    """The article's text of a page."""
    if not html:
        return ""
    page = _Reader(html)
    wrappers = page.found()
    blocks = (_Reader(html, wrappers) if wrappers else page).blocks
    if not blocks:
        return ""
    paths, value = scores(blocks)
    total: dict[tuple, float] = {}
    for p, v, (_, text, _) in zip(paths, value, blocks, strict=True):
        total[p] = total.get(p, 0.0) + v * len(text)
    best = max(total.values())
    chosen = {p for p, t in total.items() if t >= THRESHOLD * best}
    # The lowest common ancestor of the chosen blocks; link-heavy ones do not widen it.
    common = None
    for heavy in (False, True):  # all of them only if every one is link-heavy
        for p, (e, text, linked) in zip(paths, blocks, strict=True):
            if p in chosen and (heavy or linked <= LINKS * len(text)):
                chain = _chain(e)
                n = 0
                for x, y in zip(common or chain, chain):
                    if x is not y:
                        break
                    n += 1
                common = chain[:n]
        if common:
            break
    x = common[-1]
    while x.parent is not None and x.tag in _LEAVES:
        x = x.parent
    y = x  # an article or main around it is the better root
    while y is not None:
        if y.tag in _ROOTS:
            x = y
            break
        y = y.parent
    low = _low_branches(blocks, paths, chosen, x)
    out = []
    for p, (e, text, linked) in zip(paths, blocks, strict=True):
        if not _inside(e, {x.number}) or _inside(e, low):
            continue
        if p not in chosen and linked > LINKS * len(text):
            continue
        out.append(text)
    return "\n".join(out)


def _inside(e, numbers: set[int]) -> bool:
    while e is not None:
        if e.number in numbers:
            return True
        e = e.parent
    return False


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    def run(batches):
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
