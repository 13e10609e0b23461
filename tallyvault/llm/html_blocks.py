"""HTML pages as sequences of leaf blocks: each with its tag path, its text and its link share.

A block is the text between two block-level tags; inline tags and ``<br>`` don't end it.
Character references are decoded and runs of white space become one space.  Scripts, styles
and the like, comments and tags give no text; they run to the page's end if nothing ends
them.  Pictures, players and selections give none up to their own end tag or, if that is
first, their parent's; one without an end tag hides nothing.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

#: Elements whose content is never text of the page, nor tags.
RAW = "script|style|template|textarea"
#: Elements whose content isn't shown as text, but may hold tags.
HIDDEN = frozenset("svg iframe select canvas audio video".split())
#: Elements that end the block before them.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
section summary table tbody td tfoot th thead title tr ul button label""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an open paragraph, list item, cell, ... ends at; a start tag closes its like up to the container.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
CONTAINERS = frozenset("""html body article aside div footer form header main nav section table ul ol dl td th blockquote
fieldset figure details""".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>]|\Z).*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*+)*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?][^>]*>|([^<]+|<)", re.S | re.I)
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDES = re.compile(rf"</(?:{'|'.join(sorted(HIDDEN))})[\s/>]", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Path:
    """An open element and those around it; blocks and elements below share it, so that depth costs no copies."""

    __slots__ = ("element", "parent", "marks", "features")

    def __init__(self, element: str = "", parent: Path | None = None):
        self.element, self.parent = element, parent
        self.marks = self.features = None  # room for what a reader derives from the path

    def __iter__(self) -> Iterator[str]:
        """The elements from the innermost out; none for a page's outside."""
        node = self
        while node.parent is not None:
            yield node.element
            node = node.parent


class Block(NamedTuple):
    path: Path  # one entry per open element: the tag and the parts of its class, id and role
    text: str
    linked: float  # share of characters inside links


class OpenTags:
    """The names of the open elements, and at which depths each name is open."""

    def __init__(self):
        self.names: list[str] = []
        self.at: defaultdict[str, list[int]] = defaultdict(list)

    def __contains__(self, tag: str) -> bool:
        return bool(self.at.get(tag))

    def push(self, tag: str) -> None:
        self.at[tag].append(len(self.names))
        self.names.append(tag)

    def cut(self, depth: int) -> None:
        while len(self.names) > depth:
            self.at[self.names.pop()].pop()


def _element(tag: str, attributes: str) -> str:
    if "=" not in attributes:
        return tag
    parts: list[str] = []
    for _, a, b, c in _MARKS.findall(attributes):
        parts += [x.lower() for x in _PARTS.findall(a or b or c)]
    return " ".join([tag, *parts])


def _hidden_ends(tokens: list[re.Match]) -> dict[int, int]:
    """Place of the end tag for each place of a hidden element's start tag that has one."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {tag: [] for tag in HIDDEN}
    for k, m in enumerate(tokens):
        tag = (m[3] or m[6] or "").lower()
        if tag not in HIDDEN:
            continue
        if m[2] or m[5]:
            if opened[tag]:
                ends[opened[tag].pop()] = k
        elif not (tag == "svg" and (m[4] or m[7] or "").endswith("/")):
            opened[tag].append(k)
    return ends


def blocks(html: str) -> list[Block]:
    out: list[Block] = []
    opened = OpenTags()
    paths = [Path()]  # the page's outside, then one for each open element
    containers: list[int] = []  # their depths
    pieces: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked, links
        if pieces:
            raw = "".join(pieces)
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(paths[-1], text, min(1.0, linked / len(raw))))
            pieces.clear()
        linked = 0

    def close(depth: int) -> None:
        opened.cut(depth)
        del paths[depth + 1:]
        while containers and containers[-1] >= depth:
            containers.pop()

    tokens, ends = _TOKEN.finditer(html), {}
    if _HIDES.search(html):
        tokens = list(tokens)
        ends = _hidden_ends(tokens)
    hidden = -1  # place of the end tag of the hidden element that is open
    inside = OpenTags()  # block elements open in it
    for k, m in enumerate(tokens):
        if hidden >= 0:
            tag, ending = (m[3] or m[6] or "").lower(), bool(m[2] or m[5])
            if k < hidden and not (ending and tag in opened and tag not in inside):
                if tag in BLOCK:
                    if not ending:
                        inside.push(tag)
                    elif tag in inside:
                        inside.cut(inside.at[tag][-1])
                continue
            hidden = -1
            inside.cut(0)
        elif k in ends:
            hidden = ends[k]
            continue
        if (text := m[8]) is not None:
            pieces.append(text)
            linked += len(text) * (links > 0)
            continue
        name = m[3] or m[6]
        if name is None:
            continue
        tag, ending = name.lower(), bool(m[2] or m[5])
        if tag == "a":
            links = 0 if ending else 1
        elif tag == "br":
            pieces.append(" ")
        if tag not in BLOCK:
            continue
        flush()
        links = 0
        if ending:
            if tag in opened:
                close(opened.at[tag][-1])
            continue
        closes = ("p", *CLOSES.get(tag, ()))
        around = len(containers)
        while around and opened.names[containers[around - 1]] in closes:
            around -= 1
        stop = containers[around - 1] if around else -1
        first = [opened.at[x][at] for x in closes if x in opened and (at := bisect_right(opened.at[x], stop)) < len(opened.at[x])]
        if first:
            close(min(first))
        if tag == "body" and "head" in opened:
            close(opened.at["head"][0])
        if tag not in VOID:
            if tag in CONTAINERS:
                containers.append(len(opened.names))
            opened.push(tag)
            paths.append(Path(_element(tag, m[4] or m[7] or ""), paths[-1]))
    flush()
    return out
