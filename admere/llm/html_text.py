"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each at a path of tags (and first class names) from
the root. Length and punctuation are added up per path and divided by the path's blocks.
These ratios are smoothed over neighbouring blocks and fused with what the path's tags say
of themselves: links take away, an article or main element adds (the more articles a page
has, the less each says), words of a class or id take away. The fused values are added up
for every container on the way to the root. The best container is kept with all below it,
and so is each other one that holds ``SHARE`` of its weight. Lists, quotes and tables
belong to the container they stand in.

The story is more than its best container. If that lies in an article, the whole article is kept; if it lies
in a main element, or in a container below the body, the containers beside it there are kept whose fused
value per block is at least ``RATIO`` of the best one's, and those that hold headings alone.

Below a kept container only what looks like page furniture goes: elements that are mostly
links with few stops, links under a name that hints at furniture, and elements whose whole
name is one (``comments``, ``ad-1``; not ``related-work``). In an article, prose under a name that may be part of a
story too (``menu``, ``teaser``) stays. Menus, headers, footers,
sidebars, forms, scripts and styles known by element or role are never text, but for a header inside
an article or main element. Headings inside the main text are text, whatever their id.

Character references are decoded, white space inside a block becomes one space, and
blocks are joined in page order by one space.

Defined results: NULL and empty pages, and pages without a text block, give empty text.
Broken markup is read the way browsers do in the common cases: a paragraph ends where the next block
begins, an end tag without a start is ignored, an element left open ends with its parent,
a comment or tag left open takes the rest. Extra columns come through whatever their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A container is kept if it holds this share of the best one's weight.
SHARE = 0.35
#: A container beside the best one is kept if a block of it is worth this share of one of the best one's.
RATIO = 0.2
#: Factor of a name that says nothing, hints at page furniture, is one, or is one of no story.
NAMED = (1.0, 0.5, 0.05, 0.05)
#: What is added for a main element, and for a page's only article.
MAIN, ARTICLE = 0.5, 2.0
#: A container counts so much less for every level that its text lies deeper.
DEEPER = 0.7
#: Share of links from which a path with less than a stop a block is furniture: anywhere, in an article, under a name that hints.
LINKS, LINKS_ARTICLE, LINKS_HINTED = 0.5, 0.8, 0.25
#: Bytes of text handed back in one batch.
ROOM = 4 << 20

# Elements of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_ENDS_PARAGRAPH = _BLOCK - frozenset("caption head html body legend optgroup option tbody td tfoot th thead title tr".split())
#: An open element of the first name ends when one of the second names begins.
_ENDS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
_HOLDS = frozenset("ul ol menu dl table select".split())

# What page parts call themselves.
_ASIDE_TAGS = frozenset("head nav header footer aside form script style noscript template iframe object select button textarea svg canvas menu dialog audio video noembed noframes xmp".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_ASIDE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar header masthead footer sidebar aside widget widgets related recommended share sharing social "
    "newsletter subscribe subscription signup login form comment comments commentlist reply replies respond disqus discussion teaser teasers".split()
)
#: Words among them that parts of a story are called by too; alone they only hint.
_MILD = frozenset("promotion consent notification alert header related recommended share sharing social subscription form reply replies respond discussion widget widgets".split())
#: Words that say where or how big a part is, and nothing else.
_NEUTRAL = frozenset("site page top bottom left right main global primary secondary list box bar area wrap wrapper container inner outer slot block section item items content link links button buttons text".split())
#: Words among the names of page furniture that never name a part of the story.
_HARD = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr notice notices popup modal overlay nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer sidebar widget widgets newsletter subscribe signup login comment comments commentlist replies disqus".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text belongs to the container around them; table cells with a class are parts of a layout.
_INNER = _HEADINGS | frozenset("p ul ol li dl dt dd dir blockquote pre figure figcaption caption table thead tbody tfoot tr td th details summary address hgroup center hr".split())
_WORD = re.compile(r"[a-z]+")
_BESIDE = re.compile(r"(has|with|no|without)[-_]")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_STOPS = re.compile(r"[.,;:!?…。、！？]")

#: Elements that are not furniture for links alone: a heading or one item may be a link.
_SINGLE = _HEADINGS | frozenset("p li dt dd caption figcaption thead tbody tfoot tr td th summary".split())


@dataclass
class _Element:
    tag: str
    aside: bool
    main: int
    linked: bool
    place: int


@dataclass
class _Node:
    """A path: the one around it, its last tag, how far its name says it is furniture (3: of no story), and its container."""

    up: int
    tag: str
    named: int
    container: int


@dataclass
class Block:
    """A run of text at a place; ``main`` is 2 inside an article, 1 inside a main element."""

    place: int
    text: str
    main: int
    linked: int


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Element] = field(default_factory=list)
    parts: list[tuple[str, bool]] = field(default_factory=list)
    nodes: list[_Node] = field(default_factory=lambda: [_Node(-1, "", 0, 0)])
    known: dict[tuple[int, str, int], int] = field(default_factory=dict)
    #: Elements in page order: the element around each, and its path.
    places: list[tuple[int, int]] = field(default_factory=lambda: [(-1, 0)])
    articles: int = 0

    def text(self, raw: str) -> None:
        if raw and not (self.stack and self.stack[-1].aside):
            self.parts.append((raw, bool(self.stack) and self.stack[-1].linked))

    def flush(self) -> None:
        if not self.parts:
            return
        text = " ".join(html.unescape("".join(p for p, _ in self.parts)).split())
        if text:
            linked = sum(len(" ".join(p.split())) for p, link in self.parts if link)
            main, place = (self.stack[-1].main, self.stack[-1].place) if self.stack else (0, 0)
            self.blocks.append(Block(place, text, main, min(linked, len(text))))
        self.parts = []

    def open(self, tag: str, attributes: str, closed: bool) -> None:
        if tag == "br":
            self.text(" ")
            return
        if tag in _BLOCK:
            self.flush()
            if tag in _ENDS_PARAGRAPH:
                self._end("p", _HOLDS | {"td", "th", "li", "div", "article", "section", "main", "body", "button", "object"})
        for name, ends in _ENDS.items():
            if tag in ends:
                self._end(name, _HOLDS)
        if tag in _VOID or (closed and tag not in _BLOCK):
            return
        up = self.stack[-1] if self.stack else _Element("", False, 0, False, 0)
        label, aside, named = tag, up.aside or (tag in _ASIDE_TAGS and not (tag == "header" and up.main)), 0
        if attributes and not aside:
            found = {k.lower(): html.unescape((v or "").strip("\"'")).lower() for k, v in _ATTRIBUTE.findall(attributes)}
            names = found.get("class", "").split()
            if names:
                label += "." + names[0]
            aside = found.get("role", "") in _ASIDE_ROLES
            if tag not in ("html", "body", "main"):
                # the id of a heading or an article comes from its title
                named = max((_named(n) for n in [*names, "" if tag in _HEADINGS or tag == "article" else found.get("id", "")]), default=0)
                named = named if tag != "article" or named >= 2 else 0
                if named == 3 and tag == "p" and "comment" in names:
                    named = 2
        main = max(up.main, 2 if tag == "article" and named < 2 else 1 if tag == "main" else 0)
        if main == 2 and up.main < 2 and not aside:
            self.articles += 1
        place = up.place
        if tag in _BLOCK and not aside:
            around = self.places[place][1]
            node = self.known.setdefault((around, label, named), len(self.nodes))
            if node == len(self.nodes):
                inner = tag in _INNER and not (tag in ("td", "th") and label != tag)
                self.nodes.append(_Node(around, tag, named, self.nodes[around].container if inner else node))
            self.places.append((place, node))
            place = len(self.places) - 1
        linked = up.linked or tag == "a" or (named >= 2 and tag not in _BLOCK)
        self.stack.append(_Element(tag, aside, main, linked, place))

    def close(self, tag: str) -> None:
        if tag in _BLOCK:
            self.flush()
        if tag == "br":
            self.text(" ")
        elif tag in _BLOCK:
            self._end(tag, frozenset(["table"]) if tag not in ("body", "html", "table") else frozenset())
        else:
            self._end(tag, _BLOCK)

    def _end(self, tag: str, bounds: frozenset[str] | set[str]) -> None:
        """End the nearest open element of that name, unless one of ``bounds`` stands before it."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                if any(e.tag in _BLOCK for e in self.stack[i:]):
                    self.flush()
                del self.stack[i:]
                return
            if self.stack[i].tag in bounds:
                return


def _named(name: str) -> int:
    """2 if a class or id is a name of page furniture, 3 if of no part of a story, 1 if part of it is, else 0."""
    words = [] if _BESIDE.match(name) else _WORD.findall(name)
    aside = [w for w in words if w in _ASIDE_WORDS]
    if not aside:
        return 0
    if any(w not in _MILD for w in aside) and all(w in _ASIDE_WORDS or w in _NEUTRAL for w in words):
        return 3 if any(w in _HARD for w in aside) else 2
    return 1


def read(page: str) -> _Reader:
    """The blocks of a page that are not set aside by their tags, in page order, and their paths."""
    reader = _Reader()
    at, n = 0, len(page)
    last = page.rfind(">")
    while at < n:
        sign = page.find("<", at)
        if sign < 0:
            reader.text(page[at:])
            break
        reader.text(page[at:sign])
        if page.startswith("<!--", sign):
            stop = page.find("-->", sign + 4)
            at = n if stop < 0 else stop + 3
            continue
        if page.startswith(("<!", "<?"), sign):
            stop = page.find(">", sign)
            at = n if stop < 0 else stop + 1
            continue
        found = (_TAG.match(page, sign) or _LOOSE.match(page, sign)) if sign < last else None
        if found is None:
            follows = page[sign + 1 : sign + 3]
            if sign > last and re.match(r"/?[a-zA-Z]", follows):
                break
            reader.text("<")
            at = sign + 1
            continue
        at = found.end()
        tag, attributes = found[2].lower(), found[3]
        if found[1]:
            reader.close(tag)
            continue
        reader.open(tag, attributes, attributes.endswith("/"))
        if tag in _RAW and reader.stack and reader.stack[-1].tag == tag:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            inside = page[at:] if stop is None else page[at : stop.start()]
            reader.text(inside)
            at = n if stop is None else stop.start()
    reader.flush()
    return reader


def ratios(paths: list[int], lengths: list[int], stops: list[int]) -> list[tuple[float, float]]:
    """Length and stops of each block's path, added up and divided by the path's blocks."""
    total: dict[int, list[int]] = {}
    for path, length, stop in zip(paths, lengths, stops, strict=True):
        sums = total.setdefault(path, [0, 0, 0])
        sums[0] += length
        sums[1] += stop
        sums[2] += 1
    return [(total[p][0] / total[p][2], total[p][1] / total[p][2]) for p in paths]


def smoothed(values: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Each value with half the weight of its neighbours' on both sides."""
    last = len(values) - 1
    return [tuple((values[max(i - 1, 0)][k] + 2 * values[i][k] + values[min(i + 1, last)][k]) / 4 for k in (0, 1)) for i in range(len(values))]


def select(page: _Reader) -> list[Block]:
    """The blocks whose path carries the page's main text."""
    blocks, nodes, places = page.blocks, page.nodes, page.places
    node = [places[b.place][1] for b in blocks]
    stops = [len(_STOPS.findall(b.text)) for b in blocks]
    # of every element with all inside: characters, those in links, stops, blocks, and blocks that are no heading
    below = [[0, 0, 0, 0, 0] for _ in places]
    for b, n, stop in zip(blocks, node, stops, strict=True):
        for k, x in enumerate((len(b.text), b.linked, stop, 1, nodes[n].tag not in _HEADINGS)):
            below[b.place][k] += x
    for i in range(len(places) - 1, 0, -1):
        for k in range(5):
            below[places[i][0]][k] += below[i][k]
    named, article = [0] * len(nodes), [False] * len(nodes)
    for n in range(1, len(nodes)):
        up = nodes[n].up
        named[n] = max(named[up], nodes[n].named)
        article[n] = article[up] or (nodes[n].tag == "article" and nodes[n].named < 2)
    own, count = [0.0] * len(nodes), [0] * len(nodes)
    for b, n, (length, stop) in zip(blocks, node, smoothed(ratios(node, [len(b.text) - b.linked for b in blocks], stops)), strict=True):
        marked = 1 + (ARTICLE / max(page.articles, 1) if b.main == 2 else MAIN if b.main else 0.0)
        links = b.linked / max(len(b.text), 1) * (0.9 if b.main else 1.0)
        own[nodes[n].container] += length * (1 + stop) * (1 - links) * marked * NAMED[named[n]]
        count[nodes[n].container] += 1
    weight = own[:]
    for n in range(len(nodes) - 1, 0, -1):
        up = nodes[n].up
        weight[up] += weight[n] * (DEEPER if nodes[n].container == n else 1.0)
    held = [n for n in range(len(nodes)) if nodes[n].container == n]
    best = max(held, key=lambda n: weight[n])
    if weight[best] <= 0:
        return []
    above, at = set(), nodes[best].up
    while at >= 0:
        above.add(at)
        at = nodes[at].up
    kept = {n for n in held if own[n] >= SHARE * weight[best]} | {best}
    region = _region(nodes, best, article)
    if region is not None:
        kept.add(region)
    # the value of a block: of the richest container in the best one's part of the page
    rich = max((own[n] / count[n] for n in held if count[n] and (n == best or n in kept)), default=0.0)

    def poor(i: int) -> bool:
        n = places[i][1]
        if nodes[n].container != n or nodes[n].tag in ("td", "th") or n in above or article[n] or not below[i][4] or not count[n]:
            return False
        return own[n] / count[n] < RATIO * rich

    def furniture(i: int) -> bool:
        (text, linked, stop, some, _), n = below[i], places[i][1]
        if nodes[n].named == 3:
            return True
        if nodes[n].named == 2:
            # in an article, prose stays whatever its name
            return not (article[n] and stop >= some and linked < LINKS_HINTED * text)
        if nodes[n].tag in _SINGLE or not text:
            return False
        return stop < some and linked / text >= (LINKS_HINTED if nodes[n].named else LINKS_ARTICLE if article[n] else LINKS)

    # 3: with what is rich enough below, 2: with all below, 1: its own text only, as the best container lies deeper
    inside = [0] * len(places)
    for i, (up, n) in enumerate(places):
        if n == region:
            inside[i] = 2 if article[n] else 3
        elif up >= 0 and inside[up] == 3:
            inside[i] = 0 if furniture(i) or poor(i) else 2 if n == best else 3
        elif n in kept and not (up >= 0 and inside[up] == 2):
            inside[i] = 1 if n in above else 2
        elif up >= 0 and (inside[up] == 2 or (inside[up] == 1 and nodes[n].container != n)):
            inside[i] = 0 if furniture(i) else inside[up]
    return [b for b in blocks if inside[b.place]]


def _region(nodes: list[_Node], best: int, article: list[bool]) -> int | None:
    """The path of the part of the page the best container lies in: its article, main element, or the container around it."""
    up, main, around = best, None, None
    while up > 0:
        if article[up] and not article[nodes[up].up]:
            return up
        if nodes[up].tag == "main":
            main = up
        if around is None and up != best and nodes[up].container == up:
            around = up
        up = nodes[up].up
    if main is not None:
        return main
    return around if around is not None and nodes[around].tag not in ("html", "body") else None


def main_text(page: str | None) -> str:
    """Main text of one page."""
    return " ".join(b.text for b in select(read(page))) if page else ""


def extract(pages: DataFrame, column: str = "html", name: str = "text") -> DataFrame:
    """Add the main text of each page; the other columns come through."""
    own = [f"c{i}" for i in range(len(pages.columns))]
    where = pages.columns.index(column)
    spec = ", ".join([f"{c} {f.dataType.simpleString()}" for c, f in zip(own, pages.schema, strict=True)] + ["added string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, size = 0, [], 0
            for i, page in enumerate(batch.column(where)):
                held.append(main_text(page.as_py()))
                size += len(held[-1])
                if size >= ROOM or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([*(c.slice(first, i + 1 - first) for c in batch.columns), pa.array(held, pa.string())], names=[*own, "added"])
                    first, held, size = i + 1, [], 0

    return pages.toDF(*own).mapInArrow(run, spec).toDF(*pages.columns, name)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every page and its length in code points."""
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
