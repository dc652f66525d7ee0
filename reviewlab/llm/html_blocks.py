"""Text blocks of a web page with what their place in the page says about them."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

# Element and attribute names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style textarea title iframe noembed noframes xmp"
#: Their content is no text of the page.
HIDDEN = set("audio button canvas datalist head math noscript object option select svg template video".split())
CONTAINERS = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figure footer form header"
    " hgroup html li main menu nav ol section table tbody td tfoot th thead tr ul".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
BLOCKS = CONTAINERS | HEADINGS | set("caption figcaption hr legend p pre search summary".split())
#: An opening tag of the first kind ends open ones of the second, but not beyond the third.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
}
_TABLE = {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"}

# Words of class, id and role attributes. A part of an attribute counts as a whole word.
ARTICLE_WORDS = set("article articlebody blogpost content entry main maincontent post story".split())
#: Readers' comments: never the article, whatever they hold.
COMMENT_WORDS = set("comment commentlist comments disqus replies reply respond".split())
#: Menus, headers, footers, sidebars, notices, adverts and forms, unless the page's article lies inside.
ASIDE_WORDS = set(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs complementary"
    " contentinfo consent cookie cookies dialog footer form gdpr header login masthead menu menubar modal nav navbar"
    " navigation newsletter notice outbrain overlay pager pagination paywall popular popup promo promoted promotion"
    " recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe subscription"
    " taboola toc toolbar topbar trending widget widgets".split()
)
_OUTSIDE_TAGS, _ASIDE_TAGS = {"nav", "footer", "aside", "menu"}, {"form", "dialog", "fieldset"}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(RAW.split())})\b[^>]*>.*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|</?[A-Za-z!?][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_TELLING = re.compile("class|id|role|itemprop|style|hidden", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: What has, or lacks, an element of some name is none itself.
_OF_OTHERS = re.compile(r"\b(?:has|have|no|not|with|without|is|hide|show|toggle)[-_ ]+[a-z]+")

#: What an element says of the text inside; MIXED has words of both kinds, such as a part of an article.
SILENT, ARTICLE, ASIDE, OUTSIDE, MIXED = range(5)


class Element:
    """An open or closed element; `says` is its own mark, `holds` whether an article element lies inside (2) or
    one that is called so (1)."""

    __slots__ = ("tag", "parent", "depth", "says", "holds")

    def __init__(self, tag: str, parent: Element | None, says: int):
        self.tag, self.parent, self.says, self.holds = tag, parent, says, 0
        self.depth = parent.depth + 1 if parent else 0


class Block(NamedTuple):
    """One block of text: its element, the container around it, the number of elements between it and the
    block before, and its characters inside links."""

    text: str
    element: Element
    parent: Element
    near: int
    linked: int


def mark(tag: str, rest: str, in_article: bool) -> tuple[int, bool]:
    """What an opening tag says, and whether the element is hidden."""
    words, hidden = set(), tag in HIDDEN
    for name, value in _ATTRIBUTE.findall(rest) if _TELLING.search(rest) else ():
        name, value = name.lower(), value.strip("\"'")
        if name in ("hidden", "aria-hidden"):
            hidden |= value.lower() != "false"
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif name in ("class", "id", "role", "itemprop"):
            words.update(_WORD.findall(_OF_OTHERS.sub(" ", _CAMEL.sub(" ", value).lower())))
    if tag in ("html", "body"):
        return SILENT, False
    if tag in _OUTSIDE_TAGS or (tag != "main" and words & COMMENT_WORDS):
        return OUTSIDE, hidden
    article = tag in ("article", "main") or bool(words & ARTICLE_WORDS)
    aside = tag in _ASIDE_TAGS or bool((words | {tag} & {"header"}) & (ASIDE_WORDS - ({"header"} if in_article else set())))
    if article and aside:
        return ARTICLE if tag in ("article", "main") else MIXED, hidden
    return ARTICLE if article else ASIDE if aside else SILENT, hidden


class _Reader:
    """Open elements while a page is read from left to right."""

    def __init__(self):
        self.open = [Element("", None, SILENT)]
        self.opened: Counter[str] = Counter()
        self.hidden: list[Element] = []
        self.articles, self.links = 0, 0
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked, self.lowest, self.last_depth = 0, 0, 0

    def flush(self) -> None:
        """End the current block."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                own = self.open[-1]
                for own in reversed(self.open):
                    if own.tag in BLOCKS or not own.tag:
                        break
                parent = own if own.tag in CONTAINERS or not own.tag else own.parent
                near = own.depth + self.last_depth - 2 * min(self.lowest, own.depth)
                self.blocks.append(Block(text, own, parent, near, self.linked))
                self.lowest = self.last_depth = own.depth
            self.linked = 0

    def text(self, raw: str) -> None:
        if not self.hidden:
            part = html.unescape(raw) if "&" in raw else raw
            self.parts.append(part)
            if self.links:
                self.linked += len(part.strip())

    def close(self, tags: set[str], until: set[str]) -> None:
        """Close the innermost open element of `tags` and all inside it, unless one of `until` comes first."""
        if not any(self.opened[tag] for tag in tags):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                if self.open[at].tag in BLOCKS:
                    self.flush()
                for gone in reversed(self.open[at:]):
                    self.opened[gone.tag] -= 1
                    self.articles -= gone.says == ARTICLE
                    self.links -= gone.tag == "a"
                    if self.hidden and gone is self.hidden[-1]:
                        self.hidden.pop()
                del self.open[at:]
                self.lowest = min(self.lowest, at - 1)
                return
            if self.open[at].tag in until:
                return

    def start(self, tag: str, rest: str) -> None:
        if tag in BLOCKS:
            self.flush()
            if tag == "body" or self.hidden and self.hidden[-1].tag == "head" and tag != "head":
                self.close({"head"}, set())
            self.close({"p"}, CONTAINERS)
            if tag in _ENDS:
                ends, until = _ENDS[tag]
                self.close(ends, until)
            if tag in HEADINGS:
                self.close(HEADINGS, CONTAINERS)
        elif tag == "br":
            self.text(" ")
        elif tag == "a":
            self.close({"a"}, BLOCKS)
        if tag in VOID:
            return
        says, hidden = mark(tag, rest, self.articles > 0)
        own = Element(tag, self.open[-1], says)
        self.open.append(own)
        self.opened[tag] += 1
        self.articles += says == ARTICLE
        self.links += tag == "a"
        if hidden:
            self.hidden.append(own)

    def end(self, tag: str) -> None:
        if tag == "p":
            self.close({"p"}, CONTAINERS - {"p"})
        elif tag in HEADINGS:
            self.close(HEADINGS, CONTAINERS)
        elif tag == "li":
            self.close({"li"}, {"ul", "ol", "menu"})
        elif tag in _TABLE:
            self.close({tag}, {"table"} - {tag})
        elif tag in BLOCKS or tag in HIDDEN:
            self.close({tag}, _TABLE)
        elif tag not in VOID:
            self.close({tag}, BLOCKS)


def page_blocks(page: str) -> list[Block]:
    """The visible text blocks of a page in page order; ill-formed markup never fails."""
    reader = _Reader()
    for token in _TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            reader.text(text)
        elif (tag := token["tag"]) is not None:
            tag = tag.lower()
            if token["end"]:
                reader.end(tag)
            else:
                reader.start(tag, token["rest"])
    reader.flush()
    for block in reader.blocks:
        _tell_holders(block.element)
    return reader.blocks


def _tell_holders(element: Element | None) -> None:
    """Mark what lies around an article that nothing inside it calls something else."""
    while element is not None and element.says not in (ARTICLE, OUTSIDE, ASIDE):
        element = element.parent
    if element is None or element.says != ARTICLE:
        return
    kind = 2 if element.tag in ("article", "main") else 1
    element = element.parent
    while element is not None and element.holds < kind:
        element.holds = kind
        element = element.parent


def places(blocks: list[Block]) -> Iterator[int]:
    """SILENT, ARTICLE or OUTSIDE for each block, by its ancestors; once per element."""
    known: dict[int, int] = {}
    for block in blocks:
        path, element = [], block.element
        while element is not None and id(element) not in known:
            path.append(element)
            element = element.parent
        place = SILENT if element is None else known[id(element)]
        for element in reversed(path):
            apart = (element.says == ASIDE and element.holds < 2) or (element.says == MIXED and not element.holds)
            if element.says == OUTSIDE or apart:
                place = OUTSIDE
            elif element.says == ARTICLE and place != OUTSIDE:
                place = ARTICLE
            known[id(element)] = place
        yield place
