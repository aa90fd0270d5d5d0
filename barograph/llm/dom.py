"""Leaf blocks of an HTML page.

A block is what a browser shows as one run of text: the text between two borders of block elements, with the inline
elements in it. Pages are read leniently: elements that browsers close by themselves are closed, an end tag without its
start is passed over, and a page may break off anywhere. The work grows with the page's length, however it is nested.

``read`` keeps a state for every open element, made from its parent's by a function of the caller, so that features of all
ancestors need no walk up the tree.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from typing import NamedTuple, TypeVar

State = TypeVar("State")

# Elements of HTML by how browsers treat them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title xmp iframe noembed noframes".split())
UNSEEN = set("template svg".split())
BLOCKS = set(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td textarea "
    "tfoot th thead tr ul".split()
)
INSIDE_P = set("body button head html legend noscript optgroup option select tbody td textarea tfoot th thead tr".split())
# An element of the first column ends an open one of the second, up to one of the third.
ENDS = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "table tr"),
    "th": ("td th", "table tr"),
    "tbody": ("tbody thead tfoot", "table"),
    "thead": ("tbody thead tfoot", "table"),
    "tfoot": ("tbody thead tfoot", "table"),
    "option": ("option", "select"),
    "optgroup": ("optgroup", "select"),
}
_ENDS = {tag: (set(a.split()), set(b.split())) for tag, (a, b) in ENDS.items()}
_AROUND_P = set("button td th table caption html".split())

_START = re.compile(r"""<([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+)>""")
_END = re.compile(r"</([a-zA-Z][^\s/>]*+)[^>]*+>")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in RAW}
_LETTER = re.compile(r"[a-zA-Z]")


class Block(NamedTuple):
    text: str
    state: object  # of the innermost element that begins or ends lines
    tag: str  # of that element
    parent: int  # a number for the element around it
    linked: int  # characters of the text inside links, before white space is joined
    length: int  # characters of all of it


class _Open(NamedTuple):
    tag: str
    block: bool
    unseen: bool
    in_link: bool
    number: int
    state: object


def read(page: str, root: State, enter: Callable[[State, str, str], State]) -> list[Block]:
    """The page's blocks that have text. ``enter(parent's state, tag, attributes)`` gives an element's state."""
    found: list[Block] = []
    stack = [_Open("", True, False, False, 0, root)]
    frames = [0]  # places of the block elements in the stack
    places: dict[str, list[int]] = {}  # of the open elements by tag
    held: list[str] = []
    linked = length = number = 0

    def close_block() -> None:
        nonlocal held, linked, length
        if held:
            words = "".join(held).split()
            if words:
                own = stack[frames[-1]]
                around = stack[frames[-2]].number if len(frames) > 1 else 0
                found.append(Block(" ".join(words), own.state, own.tag, around, linked, length))
            held, linked, length = [], 0, 0

    def pop_to(at: int) -> None:
        """Closes the elements from place ``at`` on."""
        if frames[-1] >= at:
            close_block()
        for x in stack[at:]:
            places[x.tag].pop()
        del stack[at:]
        while frames[-1] >= at:
            frames.pop()

    def last(tags: set[str], until: set[str]) -> int:
        """The innermost open element of ``tags`` that isn't around one of ``until``; 0 for none."""
        at = max(places[t][-1] if places.get(t) else 0 for t in tags)
        return at if at and all(places[t][-1] < at for t in until if places.get(t)) else 0

    def add(text: str) -> None:
        nonlocal linked, length
        top = stack[-1]
        if text and not top.unseen:
            held.append(html.unescape(text) if "&" in text else text)
            length += len(text)
            if top.in_link:
                linked += len(text)

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            add(page[at:])
            break
        if mark > at:
            add(page[at:mark])
        after = page[mark + 1 : mark + 3]
        if _LETTER.match(after):
            m = _START.match(page, mark)
            if not m:  # the page ends inside the tag
                break
            at, tag, attributes = m.end(), m[1].lower(), m[2]
            if tag == "br":
                add(" ")
                continue
            block = tag in BLOCKS
            if block:
                close_block()
                if places.get("p") and tag not in INSIDE_P and (p := last({"p"}, _AROUND_P)):
                    pop_to(p)
                if tag in _ENDS and (old := last(*_ENDS[tag])):
                    pop_to(old)
            if tag in RAW:
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else size
            elif tag not in VOID and not attributes.endswith("/") or block and tag != "hr":
                top = stack[-1]
                number += 1
                stack.append(_Open(tag, block, top.unseen or tag in UNSEEN, top.in_link or tag == "a", number, enter(top.state, tag, attributes)))
                places.setdefault(tag, []).append(len(stack) - 1)
                if block:
                    frames.append(len(stack) - 1)
        elif after[:1] == "/" and _LETTER.match(after[1:]):
            m = _END.match(page, mark)
            if not m:
                break
            at, tag = m.end(), m[1].lower()
            old = places[tag][-1] if places.get(tag) else 0
            if old and (tag in BLOCKS or old > frames[-1]):
                pop_to(old)
            elif tag == "p":
                close_block()
        elif after[:1] == "!" and page.startswith("<!--", mark):
            end = page.find("-->", mark + 2)
            at = end + 3 if end >= 0 else size
        elif after[:1] in ("!", "?", "/"):
            end = page.find(">", mark)
            at = end + 1 if end >= 0 else size
        else:
            add("<")
            at = mark + 1
    close_block()
    return found
