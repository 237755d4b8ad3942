"""Main text of web pages by tree scoring.

A page becomes a small tree. Parts that are no article by their element, role or names are
set aside. Every paragraph gives points for its length and commas, less its share of links, to
the containers around it; the container with the most points, discounted by its link
density, is the article, and siblings that score well are kept with it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import slices, whole

# Fixed values of the HTML standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math "
    "output picture q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCK = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form header hgroup hr legend li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag ends an open element of these kinds if that is the innermost block.
CLOSES = {
    "li": {"li"},
    "dd": {"dd", "dt"},
    "dt": {"dd", "dt"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tr": {"td", "th", "tr"},
    "tbody": {"td", "th", "tr", "thead", "tbody"},
    "tfoot": {"td", "th", "tr", "thead", "tbody"},
}
CELLS = frozenset("td th caption table".split())

# Choices of this module.
#: Elements that are never part of an article.
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer form frameset map menu nav object "
    "optgroup option search select svg template video".split()
)
#: Words in a class or identifier that name parts around an article.
AROUND = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising alert alerts aside banner "
    "breadcrumb breadcrumbs colophon comment commentlist comments consent cookie cookies "
    "copyright discussion disqus footer form gdpr login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promotion recommendations recommended related replies reply respond rail search share "
    "sharing sidebar signin signup skip social sponsor sponsored subscribe subscription "
    "toolbar widget widgets "
    "anzeige comentario comentarios commentaire commentaires kommentar kommentare publicidad "
    "publicite werbung".split()
)
HEADER_WORDS = frozenset("header topbar".split())
#: Words after which a name says that the page has such a part, not that this is it.
ABOUT = frozenset("has no not with without".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search toolbar".split()
)
LIKELY = frozenset("article body content entry main post story text".split())

#: Open elements; deeper inline markup is read as text of the element around it.
MAX_DEPTH = 512
#: Levels of containers a paragraph gives points to: all, half, then a third of a share each.
LEVELS = 5
#: Share of the best score, and least score, from which a sibling is kept.
SIBLING_SHARE, SIBLING_LEAST = 0.2, 10.0

_MARKUP = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)|[!?/])")
_ATTRIBUTE = re.compile(
    r"""[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|(?!["'])([^\s>]*+)))?)"""
)
_COMMENT_END = re.compile("--!?>")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE) for name in RAW}
_WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+")
_COMMA = re.compile("[,،、，]")

KEEP, HEADINGS_ONLY, DROP, DROP_FORM, DROP_HINT = range(5)


class Node:
    """An element with its text and elements in page order, and what scoring finds."""

    __slots__ = ("tag", "parent", "parts", "fate", "likely", "holds", "chars", "links", "points")

    def __init__(self, tag: str, parent: Node | None, fate: int = KEEP, likely: bool = False):
        self.tag, self.parent, self.fate, self.likely = tag, parent, fate, likely
        self.parts: list = []
        self.holds = False  # an article or main element inside
        self.chars = self.links = 0
        self.points = 0.0

    @property
    def density(self) -> float:
        return self.links / self.chars if self.chars else 0.0

    @property
    def score(self) -> float:
        weight = 2.0 if self.tag == "article" else 1.25 if self.likely else 1.0
        return self.points * (1 - self.density) * weight + (25.0 if self.tag == "article" else 0.0)


def _names(value: str) -> Iterator[str]:
    """Words of a class or identifier, without those after "no", "with" and the like."""
    for name in value.split():
        before = ""
        for word in _WORD.findall(name):
            word = word.lower()
            if before not in ABOUT:
                yield word
            before = word


def _fate(tag: str, attributes: dict[str, str]) -> tuple[int, bool]:
    """What an element's kind, role and names say about it; whether it may be the article."""
    if tag == "form":
        return DROP_FORM, False
    if tag in DROPPED:
        return DROP, False
    if tag == "header":
        return HEADINGS_ONLY, False
    if not attributes:
        return KEEP, tag == "main"
    style = attributes.get("style", "").replace(" ", "").lower()
    if (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").lower() == "true"
        or "display:none" in style
        or "visibility:hidden" in style
    ):
        return DROP, False
    role = attributes.get("role", "").lower()
    if role in ROLES:
        return DROP, False
    words = {*_names(attributes.get("class", "")), *_names(attributes.get("id", ""))}
    if words & AROUND:
        return DROP_HINT, False
    if words & HEADER_WORDS:
        return HEADINGS_ONLY, False
    body = attributes.get("itemprop", "").lower() == "articlebody"
    return KEEP, tag == "main" or role == "main" or body or bool(words & LIKELY)


def _attributes(text: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes of a start tag and the place after it; -1 if the tag isn't closed."""
    found: dict[str, str] = {}
    while True:
        m = _ATTRIBUTE.match(text, at)
        if not m:
            return found, -1
        at = m.end()
        if m[1]:
            return found, at
        value = next((v for v in m.group(3, 4, 5) if v is not None), "")
        found.setdefault(m[2].lower(), html.unescape(value) if "&" in value else value)


class _Builder:
    """The tree of a page, from its tags in order."""

    def __init__(self) -> None:
        self.root = Node("body", None)
        self.open = [self.root]
        self.blocks = [self.root]
        self.counts: dict[str, int] = {}

    def close(self, upto: Node) -> None:
        """Close the open elements from the innermost to this one."""
        while True:
            node = self.open.pop()
            self.counts[node.tag] -= 1
            if self.blocks[-1] is node:
                self.blocks.pop()
            if node is upto:
                return

    def text(self, text: str) -> None:
        self.open[-1].parts.append(text)

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in BLOCK:
            if self.blocks[-1].tag == "p":
                self.close(self.blocks[-1])
            closes = CLOSES.get(tag, ())
            while self.blocks[-1].tag in closes:
                self.close(self.blocks[-1])
        if tag == "br":
            self.text("\n")
            return
        if tag in VOID:
            if tag == "hr":
                self.open[-1].parts.append(Node("hr", self.open[-1]))
            return
        if len(self.open) >= MAX_DEPTH:
            if tag in BLOCK:  # still ends the block before it
                self.open[-1].parts.append(Node("hr", self.open[-1]))
            return
        fate, likely = _fate(tag, attributes)
        node = Node(tag, self.open[-1], fate, likely)
        self.open[-1].parts.append(node)
        self.open.append(node)
        if tag not in INLINE:
            self.blocks.append(node)
        self.counts[tag] = self.counts.get(tag, 0) + 1
        if (tag in ("article", "main") or attributes.get("role") == "main") and fate == KEEP:
            above = node.parent
            while above and not above.holds:
                above.holds = True
                above = above.parent

    def end(self, tag: str) -> None:
        if tag == "br":
            self.text("\n")
        elif tag == "p" and not self.counts.get("p"):
            self.open[-1].parts.append(Node("hr", self.open[-1]))
        elif self.counts.get(tag):
            for node in reversed(self.open):
                if node.tag == tag:
                    self.close(node)
                    return
                if node.tag in CELLS and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                    return


def parse(text: str) -> Node:
    """The tree of a page. Head, body and html are not elements of it, only what they hold."""
    builder, at, size = _Builder(), 0, len(text)
    while at < size:
        m = _MARKUP.search(text, at)
        upto = m.start() if m else size
        if upto > at:
            piece = text[at:upto]
            builder.text(html.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        if m[1]:
            # "<!-->" and "<!--->" are whole comments.
            end = _COMMENT_END.search(text, m.end() - 2)
            at = end.end() if end else size
        elif not m[3]:
            end = text.find(">", m.end() - 1)
            at = end + 1 if end >= 0 else size
        else:
            tag = m[3].lower()
            attributes, at = _attributes(text, m.end())
            if at < 0:
                break  # a tag that is never closed is no text
            if m[2]:
                builder.end(tag)
            elif tag in RAW:
                end = _RAW_END[tag].search(text, at)
                if not end:
                    break
                _, at = _attributes(text, end.end())
                if at < 0:
                    break
            elif tag not in ("html", "head", "body"):
                builder.start(tag, attributes)
    return builder.root


def _settle(nodes: list[Node], forms: bool, hints: bool) -> None:
    """Make the final choice which nodes go, given whether forms and named parts may stay."""
    for node in nodes:
        if node.fate == DROP_FORM:
            node.fate = KEEP if node.holds or forms else DROP
        elif node.fate == DROP_HINT:
            # What holds the article is a frame around it, whatever its name.
            wrapper = node.holds or (hints and any(isinstance(p, Node) and p.fate != KEEP for p in node.parts))
            node.fate = KEEP if wrapper else DROP
        elif node.fate == HEADINGS_ONLY:
            above = node.parent
            while above and above.tag != "article":
                above = above.parent
            if node.holds:
                node.fate = KEEP
            elif not above:
                node.fate = DROP


def _preorder(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return out


def _kept(root: Node) -> list[Node]:
    """Nodes that stay, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.fate == DROP:
            continue
        out.append(node)
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return out


def _score(nodes: list[Node]) -> None:
    """Characters, link characters and points of every node, from the innermost out."""
    flow = {}  # by block: characters, link characters and commas of its own text
    for node in reversed(nodes):
        own = [p for p in node.parts if isinstance(p, str)]
        chars = sum(len(t) for text in own for t in text.split())
        node.chars += chars
        if node.tag == "a":
            node.links = node.chars
        inline = node.tag in INLINE and node.parent is not None
        commas = sum(len(_COMMA.findall(t)) for t in own)
        mine = flow.pop(id(node), None) or [0, 0, 0]
        mine = [mine[0] + chars, mine[1], mine[2] + commas]
        if node.tag == "a":
            mine[1] = mine[0]
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.links += node.links
        if inline:
            above = flow.setdefault(id(node.parent), [0, 0, 0])
            for k in range(3):
                above[k] += mine[k]
        elif mine[0] and node.tag not in HEADINGS and node.fate == KEEP:
            share = 1 - mine[1] / mine[0]
            give = (1 + mine[2] + min(mine[0] / 100, 3.0)) * share
            above, level = node.parent or node, 0
            while above is not None and level < LEVELS:
                if above.tag not in INLINE:
                    above.points += give / (1 if level == 0 else 2 if level == 1 else 3 * level)
                    level += 1
                above = above.parent


def _choose(nodes: list[Node]) -> list[Node]:
    """The best container and the siblings kept with it, in page order."""
    root = nodes[0]
    scored = [n for n in nodes if n.points > 0]
    if scored:
        best = max(scored, key=lambda n: n.score)  # the first in page order of equals
    else:
        best = next((n for n in nodes if n.tag == "article" and n.chars), root)
    above = best
    while above is not None:
        if above.tag == "article":
            best = above
        above = above.parent
    if best.parent is None:
        return [best]
    least = max(SIBLING_LEAST, SIBLING_SHARE * best.score)
    has_title = any(n.tag == "h1" for n in _kept(best))
    chosen, before = [], True
    for node in best.parent.parts:
        if node is best:
            chosen.append(node)
            before = False
        elif not isinstance(node, Node) or node.fate != KEEP:
            continue
        elif node.tag in ("h1", "h2"):
            if before and not has_title and node.density < 0.33:
                chosen.append(node)
        elif node.tag == "p" and best.tag != "article":
            if node.density < 0.25 and node.chars:
                chosen.append(node)
        elif node.points > 0 and node.score >= least and node.density < 0.5:
            chosen.append(node)
    return chosen


def _blocks(chosen: list[Node]) -> Iterator[str]:
    """Texts of the blocks of some nodes, in page order, with single spaces."""
    run: list[str] = []
    for top in chosen:
        lists = top.tag != "article"  # outside an article a list of links is a menu
        stack: list = [(top, False, False)]
        while stack:
            part, headings, leaving = stack.pop()
            if isinstance(part, str):
                if not headings:
                    run.append(part)
                continue
            block = part.tag in BLOCK
            if block and run:
                text = " ".join("".join(run).split())
                run.clear()
                if text:
                    yield text
            if leaving or part.fate == DROP:
                continue
            if lists and part.tag in ("ul", "ol", "dl", "table") and part.density >= 0.5:
                continue
            headings = (headings or part.fate == HEADINGS_ONLY) and part.tag not in HEADINGS
            if block:
                stack.append((part, headings, True))
            stack.extend((p, headings, False) for p in reversed(part.parts))
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            yield text


def main_text(page: str | None) -> str:
    """The article of a page; its blocks joined by line ends, "" if there is none."""
    if not page:
        return ""
    for forms, hints in ((False, False), (True, False), (True, True)):
        root = parse(page)
        _settle(_preorder(root), forms, hints)
        nodes = _kept(root)
        _score(nodes)
        if root.chars:
            return "\n".join(_blocks(_choose(nodes)))
    return ""


ADDED = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """One row per input row: its other columns, text and n_chars (code points of the text).

    Defined cases: a null or empty page, and one without an article, give an empty text;
    a page of any length is read whole; malformed markup is read as browsers do, unclosed
    elements included; repeated rows stay; an empty table gives no rows. The html column is
    left out, and a column named text or n_chars is replaced.
    """
    taken = {f.name.lower() for f in ADDED} | {html_col.lower()}
    kept = [f for f in pages.schema.fields if f.name.lower() not in taken]
    names = [f"c{i}" for i in range(len(kept) + len(ADDED))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            texts = [main_text(page) for page in batch.column(0).to_pylist()]
            out = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *out], names)

    rows = pages.select(
        whole(f"`{html_col}`").alias("html"),
        *(F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)),
    )
    fields = [*kept, *ADDED]
    plain = [T.StructField(n, f.dataType) for n, f in zip(names, fields, strict=True)]
    return rows.mapInArrow(run, T.StructType(plain)).toDF(*(f.name for f in fields))
