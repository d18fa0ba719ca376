"""Leaf blocks of a web page: runs of text between block-level tags, with what stands above them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Set
from html import unescape
from typing import NamedTuple

# Text of these is no text of the page, up to the end tag. Where it is missing the first two go on to the page's end, as in
# a browser; the others are passed over as single tags, so that no text is lost.
_RAW = "script|style"
_SILENT = {
    tag: re.compile(rf"</{tag}\s*>", re.I)
    for tag in "template noscript title svg math iframe object canvas audio video".split()
}
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<({_RAW})\b(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<rest>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/<>]*+)(?P<rest2>[^<>]*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr picture source".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag ends an open one of these, up to the nearest of the second set.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_KEEPS_P = _INLINE | {"br", "input", "button", "select", "option", "textarea"}
_SCOPE = frozenset({"td", "th", "table", "button", "body", "html"})


class Place(NamedTuple):
    """What stands above a block."""

    above: frozenset[str]  # tags
    names: frozenset[str]  # parts of class, id and role
    own: tuple[str, ...]  # the innermost two block-level tags
    depth: int


class Block(NamedTuple):
    text: str
    place: Place
    linked: int  # code points inside links


_ROOT = Place(frozenset(), frozenset(), (), 0)


class _Open:
    """The open elements. Tags are counted, so looking for one that is not open costs nothing."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, Place]] = []
        self.number: Counter[str] = Counter()

    def place(self) -> Place:
        return self.stack[-1][1] if self.stack else _ROOT

    def push(self, tag: str, names: set[str]) -> None:
        at = self.place()
        self.number[tag] += 1
        above = at.above if tag in at.above else at.above | {tag}
        names_ = at.names if names <= at.names else at.names | names
        own, depth = (at.own, at.depth) if tag in _INLINE else ((*at.own, tag)[-2:], at.depth + 1)
        self.stack.append((tag, Place(above, names_, own, depth)))

    def close(self, ends: Set[str], barrier: Set[str]) -> None:
        """Closes down to the innermost of ``ends``, unless one of ``barrier`` stands before it."""
        if not any(self.number[tag] for tag in ends):
            return
        at = len(self.stack) - 1
        while self.stack[at][0] not in ends:
            if self.stack[at][0] in barrier:
                return
            at -= 1
        for tag, _ in self.stack[at:]:
            self.number[tag] -= 1
        del self.stack[at:]


def leaf_blocks(html: str) -> list[Block]:
    """The blocks with text, in page order; white space is one space, character references are decoded."""
    open_ = _Open()
    blocks: list[Block] = []
    pending: list[str] = []
    links: list[str] = []

    def text_of(piece: str) -> None:
        pending.append(piece)
        if open_.number["a"]:
            links.append(piece)

    def flush() -> None:
        if pending:
            text = " ".join(unescape("".join(pending)).split())
            if text:
                linked = len(" ".join(unescape("".join(links)).split())) if links else 0
                blocks.append(Block(text, open_.place(), linked))
            pending.clear()
            links.clear()

    at = 0
    unended: set[str] = set()
    while (token := _TOKEN.search(html, at)) is not None:
        if token.start() > at:
            text_of(html[at : token.start()])
        at = token.end()
        tag = token["tag"] or token["tag2"]
        if tag is None:
            continue
        tag, closing, attributes = tag.lower(), token["end"] or token["end2"], token["rest"] or token["rest2"] or ""
        if tag == "br":
            pending.append("\n")
            continue
        if tag in _SILENT:
            # Foreign elements are closed by a slash before the bracket.
            if not closing and not attributes.endswith("/") and tag not in unended:
                end = _SILENT[tag].search(html, at)
                at = end.end() if end else at
                if not end:
                    unended.add(tag)
            continue
        if tag not in _INLINE:
            flush()
        if closing:
            open_.close({tag}, _SCOPE if tag in _INLINE else frozenset())
            continue
        if tag not in _KEEPS_P:
            open_.close({"p"}, _SCOPE)
        if tag in _ENDS:
            open_.close(*_ENDS[tag])
        if tag in _VOID or attributes.endswith("/"):
            continue
        names: set[str] = set()
        for m in _ATTRIBUTE.finditer(attributes) if attributes else ():
            names.update(_PART.findall((m[2] or m[3] or m[4] or "").lower()))
        open_.push(tag, names)
    if at < len(html):
        text_of(html[at:])
    flush()
    return blocks
