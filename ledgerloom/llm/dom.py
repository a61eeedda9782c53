"""A page as a tree of elements and text runs, for content extraction.

Handles what real pages hold: missing end tags, raw text elements, comments,
character references, broken markup. Nothing is dropped but what is not text
of the page (scripts, styles, the head, form fields, comments, markup).
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from dataclasses import dataclass, field
from functools import lru_cache

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<", re.S)
START = re.compile(r"<[a-zA-Z][^\s/>]*")
MARK = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
SILENT = frozenset(
    "head script style template iframe select option datalist textarea canvas audio video".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul caption legend".split())
#: An element's start ends an open one of these, unless a border lies between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
        "body": {"head"}}
BORDER = frozenset("ul ol dl table article section main div body aside nav header footer form blockquote td th".split())
#: Elements that do not end an open paragraph although they are blocks.
INSIDE_P = frozenset(("html", "body"))


@dataclass
class Node:
    parent: int
    tag: str  # "#text" for a run of text
    attributes: dict[str, str]
    run: int = -1  # block of a text
    words: int = 0
    linked: int = 0
    text: list[str] = field(default_factory=list)


@lru_cache(maxsize=20_000)
def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


class TagEnds:
    """Where start tags end, without reading the rest of the page for each.

    A tag ends at the first > outside of quotes. Reading on from any > or
    quote, outside of quotes, always comes to the same end, so the ends are
    worked out once, from the last such character backwards.
    """

    def __init__(self, page: str):
        self.marks = [m.start() for m in MARK.finditer(page)]
        self.end: list[int | None] = [None] * (len(self.marks) + 1)
        following = {'"': len(self.marks), "'": len(self.marks)}
        for k in range(len(self.marks) - 1, -1, -1):
            char = page[self.marks[k]]
            if char == ">":
                self.end[k] = self.marks[k]
            else:
                partner = following[char]
                self.end[k] = self.end[partner + 1] if partner < len(self.marks) else None
                following[char] = k

    def after(self, at: int) -> int | None:
        return self.end[bisect_left(self.marks, at)]


def parse(page: str) -> list[Node]:
    """Nodes in page order, parents first; node 0 is the page.

    Takes time in proportion to the page, broken markup or not: open elements
    are found by their places, and once a start tag has turned out to have no
    end, the ends of all tags are known (``TagEnds``) before one is read.
    """
    nodes = [Node(-1, "#page", {})]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements and the node that stands for each
    places: dict[str, list[int]] = {}  # of the open elements of each kind
    blocks_open: list[int] = []
    run, links, silent = 0, 0, 0
    texts: dict[tuple[int, int], Node] = {}

    def put(text: str) -> None:
        if silent or not text:
            return
        owner = stack[-1][1]
        node = texts.get((run, owner))
        if node is None:
            if text.isspace():
                # white space between the parts of one run separates them
                if nodes[-1].run == run:
                    nodes[-1].text.append(" ")
                return
            node = Node(owner, "#text", {}, run)
            texts[run, owner] = node
            nodes.append(node)
        node.text.append(text)
        words = len(text.split())
        node.words += words
        node.linked += words if links else 0

    def close(depth: int) -> None:
        nonlocal run, links, silent
        while len(stack) > depth:
            tag, _ = stack.pop()
            places[tag].pop()
            if tag in BLOCK:
                blocks_open.pop()
                run += 1
            links -= tag == "a"
            silent -= tag in SILENT

    def close_last(tags: set[str] | frozenset[str], border: frozenset[str]) -> None:
        k = max((places[t][-1] for t in tags if places.get(t)), default=0)
        if k and k > max((places[t][-1] for t in border if places.get(t)), default=0):
            close(k)

    at, end = 0, len(page)
    ends: TagEnds | None = None
    start: re.Match | None = None
    while at < end:
        if ends is not None:
            if start is not None and start.start() < at:
                start = START.search(page, at)
            if start is not None and ends.after(start.end()) is None and TOKEN.search(page, at, start.start()) is None:
                # a tag without an end is text
                put(html.unescape(page[at:start.start() + 1]))
                at = start.start() + 1
                continue
        m = TOKEN.search(page, at)
        if m is None:
            put(html.unescape(page[at:]))
            break
        if m.start() > at:
            put(html.unescape(page[at:m.start()]))
        at = m.end()
        if m.group(2):
            tag = m.group(2).lower()
            if tag == "br" or tag == "wbr":
                if tag == "br":
                    put(" ")
                continue
            if tag in BLOCK:
                if tag not in INSIDE_P:
                    close_last({"p"}, BORDER)
                run += 1
            if tag in ENDS:
                close_last(ENDS[tag], BORDER - ENDS[tag])
            if tag == "a":
                close_last({"a"}, BORDER)
            if tag in VOID:
                continue
            known = attributes(m.group(3)) if m.group(3).strip(" /\t\r\n") else {}
            owner = stack[-1][1]
            if tag in BLOCK or tag in SILENT or any(k in known for k in ("class", "id", "role", "hidden")):
                if not silent and tag not in SILENT:
                    nodes.append(Node(owner, tag, known))
                    owner = len(nodes) - 1
            places.setdefault(tag, []).append(len(stack))
            if tag in BLOCK:
                blocks_open.append(len(stack))
            stack.append((tag, owner))
            links += tag == "a"
            silent += tag in SILENT
            if tag in RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                if not silent:
                    put(page[at:stop.start() if stop else end])
                at = stop.end() if stop else end
                close(len(stack) - 1)
        elif m.group(1):
            tag = m.group(1).lower()
            if tag in VOID or not places.get(tag):
                run += tag == "p"
                continue
            k = places[tag][-1]
            if tag in BLOCK or not blocks_open or blocks_open[-1] < k:
                close(k)  # else a stray end of an inline element
        elif m.group() == "<":
            put("<")
            if ends is None and START.match(page, m.start()):
                ends, start = TagEnds(page), START.search(page, at)
    return nodes


def blocks(nodes: list[Node], keep) -> list[str]:
    """The text of each block in page order, from the text nodes that
    ``keep(k)`` accepts; white space becomes one space, empty blocks go."""
    out: list[list[str]] = []
    last = -1
    for k, node in enumerate(nodes):
        if node.tag == "#text" and keep(k):
            if node.run != last:
                out.append([])
                last = node.run
            out[-1] += node.text
    return [t for t in (" ".join("".join(parts).split()) for parts in out) if t]
