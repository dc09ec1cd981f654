"""Leaf blocks of a page: the runs of text between block-level tags, with the open elements around them."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg annotation annotation-xml head title iframe object textarea select datalist audio video canvas".split())
# Anything else directly in a head ends it.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# An opening tag ends these open elements, as far as no element of the second set lies between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_ENDS_P = BLOCK - {"button", "label", "legend", "option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "summary", "figcaption"}
_SPACE = re.compile(r"\s+")
_TOKEN = re.compile(r"[a-z]+")


@dataclass
class Element:
    tag: str
    #: Features of the element and those around it, the same object for all blocks inside.
    path: tuple[str, ...] = ()
    in_link: bool = False
    silent: bool = False


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int  # characters inside links


@dataclass
class _Open:
    parts: list[str] = field(default_factory=list)
    linked: int = 0


class _Reader(HTMLParser):
    """Reads a page in time linear in its length: where tags are open is known by name, and not looked for in the stack."""

    def __init__(self, names: frozenset[str] | None) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._names = names
        self._stack = [Element("")]
        self._places: defaultdict[str, list[int]] = defaultdict(list)
        self._open = _Open()

    def _flush(self) -> None:
        if self._open.parts:
            text = _SPACE.sub(" ", "".join(self._open.parts)).strip()
            if text:
                self.blocks.append(Block(self._where, text, self._open.linked))
            self._open = _Open()

    def _pop_to(self, index: int) -> None:
        if any(e.tag in BLOCK and not e.silent for e in self._stack[index:]):
            self._flush()
        for element in self._stack[index:]:
            self._places[element.tag].pop()
        del self._stack[index:]

    def _push(self, element: Element) -> None:
        self._places[element.tag].append(len(self._stack))
        self._stack.append(element)

    def _find(self, tags: Iterable[str], until: Iterable[str]) -> int:
        """Where the innermost of ``tags`` is open, 0 if one of ``until`` lies inside it."""
        found = max((self._places[t][-1] for t in tags if self._places[t]), default=0)
        return found if found and all(self._places[t][-1] < found for t in until if self._places[t]) else 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self._stack[-1].silent and self._find({"annotation-xml"}, {"math"}):
            if tag not in VOID:  # ends nothing outside, and no block
                self._push(Element(tag, silent=True))
            return
        if tag == "body" and (at := self._find({"head"}, set())):
            self._pop_to(at)
        elif tag not in IN_HEAD and self._stack[-1].tag == "head":
            self._pop_to(len(self._stack) - 1)
        if tag in BLOCK:
            self._flush()
            if tag in _ENDS_P and (at := self._find({"p"}, {"button", "td", "th", "table"})):
                self._pop_to(at)
        if tag in _ENDS:
            while at := self._find(*_ENDS[tag]):
                self._pop_to(at)
        if tag in VOID:
            if tag in ("br", "wbr", "img", "input") and self._open.parts:
                self._open.parts.append(" ")
            return
        above = self._stack[-1]
        own = [f"tag:{tag}"] if tag in BLOCK else []
        for name, value in attrs:
            if value and name in ("class", "id", "role", "itemprop", "aria-label", "data-component"):
                own += [f"name:{t}" for t in _TOKEN.findall(value.lower()) if self._names is None or t in self._names]
        path = above.path + tuple(f for f in own if f not in above.path) if own else above.path
        self._push(Element(tag, path, above.in_link or tag == "a", above.silent or tag in SILENT))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # in HTML the slash means nothing but for void elements

    def handle_endtag(self, tag: str) -> None:
        if at := self._find({tag}, set()):
            self._pop_to(at)
        elif tag in BLOCK:
            self._flush()

    def handle_data(self, data: str) -> None:
        if self._stack[-1].tag == "head" and not data.isspace():
            self._pop_to(len(self._stack) - 1)
        here = self._stack[-1]
        if here.silent:
            return
        if not self._open.parts:
            if data.isspace():
                return
            # Inline elements tell nothing about where a block is, so its first text stands for all of it.
            self._where = here.path
        self._open.parts.append(data)
        if here.in_link:
            self._open.linked += len(data)


def blocks(html: str, names: frozenset[str] | None = None) -> list[Block]:
    """Blocks in page order, white space inside them turned into single spaces, references decoded.

    Of the names of elements only ``names`` are kept, if given, which bounds what is known of a block's place.
    """
    last = html.rfind("<")
    if last > html.rfind(">") and html[last + 1 : last + 2].isalpha():
        html = html[:last]  # a page that ends inside a tag: the tag is dropped, as browsers do
    reader = _Reader(names)
    reader.feed(html)
    reader.close()
    reader._flush()
    return reader.blocks
