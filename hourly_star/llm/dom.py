"""Pages as trees of block elements, for many pages at once."""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

# Element names with a meaning of their own in HTML.
BLOCKS = frozenset(
    "html body article section nav aside header footer main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead "
    "tbody tfoot tr td th caption blockquote pre figure figcaption form fieldset legend label address details "
    "summary dialog menu hr center noscript hgroup search button select textarea".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
FOREIGN = frozenset("svg math".split())  # a slash before the end of the tag closes them
RAW = frozenset("script style title template iframe noembed svg".split())  # what is inside is no text
CLOSES_P = BLOCKS - frozenset("html body td th button label select textarea legend summary".split())
CONTROLS = frozenset("input select textarea button option".split())
SELF_CLOSING = {  # an open element that a start tag of the key ends, and where the search for it stops
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
_TAG = re.compile(r"</?([a-zA-Z][^\s/><]*)")
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_PLAIN = re.compile(r"[^>\"']*")
_NAMED = re.compile(r"(?:^|[\s\"'])(class|id|role|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_BREAKS = re.compile(r"[\s\"'>]")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_TEXT_SIGNS = re.compile(r"[.,;:!?]")

FEATURES = 1 << 13
DEEPEST = 512  # elements further down become siblings, as in browsers
GROUPS = {"p": 0, "li": 1, "ul": 1, "ol": 1, "td": 2, "tr": 2, "tbody": 2, "table": 2,
          "h1": 3, "h2": 3, "h3": 3, "h4": 3, "h5": 3, "h6": 3}  # kinds of children; others are 4
N_GROUPS = 5


@dataclass
class Forest:
    """Block elements of some pages, parents before children, and their runs of text."""

    labelled: bool = True  # drawn pages; on others data-y is an attribute like any other
    kind: list[str] = field(default_factory=list)
    page: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)  # -1 at a page's root
    depth: list[int] = field(default_factory=list)
    group: list[int] = field(default_factory=list)
    label: list[int] = field(default_factory=list)  # of a labelled page, else -1
    names: list[list[int]] = field(default_factory=list)  # features of the start tag
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters inside links
    links: list[int] = field(default_factory=list)
    signs: list[int] = field(default_factory=list)
    controls: list[int] = field(default_factory=list)
    runs: list[tuple[int, list[str]]] = field(default_factory=list)  # (element, pieces) in page order

    def add(self, page: int, parent: int, name: str, attrs: str) -> int:
        if parent >= 0 and self.depth[parent] >= DEEPEST:
            parent = self.parent[parent]
        features = [_hash("t:" + name), _hash(f"u:{name}:{self.kind[parent]}" if parent >= 0 else "u:")]
        label = self.label[parent] if parent >= 0 else -1
        if attrs:
            for key, *values in _NAMED.findall(attrs):
                value = "".join(values)
                if key.lower() == "data-y":
                    if self.labelled:
                        label = int(value)
                else:
                    features += [_hash("n:" + part.lower()) for part in _PARTS.findall(value)]
        self.kind.append(name)
        self.page.append(page)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.group.append(GROUPS.get(name, N_GROUPS - 1))
        self.label.append(label)
        self.names.append(features)
        for counts in (self.chars, self.linked, self.links, self.signs, self.controls):
            counts.append(0)
        return len(self.page) - 1

    def parse(self, page: int, source: str) -> None:
        """Add a page; tags need not be closed or nested well. Time grows with the length alone."""
        root = self.add(page, -1, "html", "")
        opened = _Open(root)
        run_of = -1
        position = 0
        for start, stop, closing, name, attrs in _tags(source):
            if start > position:
                run_of = self._text(source[position:start], opened, run_of)
            position = stop
            if not name:
                continue
            if closing:
                if name != "html" and opened.last(name) >= 0:
                    opened.cut(opened.last(name))
                    if name in BLOCKS:
                        run_of = -1
                elif name == "p" and opened.last("p") < 0:
                    run_of = -1
                continue
            node = opened.nodes[-1]
            if name in CONTROLS:
                self.controls[node] += 1
            if _self_closed(name, attrs):
                continue
            if name in VOID:
                if name == "br" and run_of == node:
                    self.runs[-1][1].append("\n")
                if name == "hr":
                    run_of = -1
                continue
            if name in RAW:
                continue
            if name in CLOSES_P and opened.last("p") > max(map(opened.last, ("td", "th", "button"))):
                opened.cut(opened.last("p"))
            if name in SELF_CLOSING:
                ends, walls = (max(map(opened.last, names)) for names in SELF_CLOSING[name])
                if ends > walls:
                    opened.cut(ends)
            if name in ("html", "head"):
                continue
            if name == "a":
                self.links[opened.nodes[-1]] += 1
            if name in BLOCKS:
                opened.push(name, self.add(page, opened.nodes[-1], name, attrs))
                run_of = -1
            else:
                opened.push(name, opened.nodes[-1])
        if position < len(source):
            self._text(source[position:], opened, run_of)

    def _text(self, piece: str, opened: _Open, run_of: int) -> int:
        """Add text to the nearest block element; the element of the run it is part of."""
        node = opened.nodes[-1]
        if run_of != node:
            self.runs.append((node, []))
        self.runs[-1][1].append(piece)
        size = len(piece.strip())
        if size:
            self.chars[node] += size
            self.signs[node] += len(_TEXT_SIGNS.findall(piece))
            if opened.last("a") >= 0:
                self.linked[node] += size
        return node


class _Open:
    """The open elements of a page, with the nearest block element of each, and where each name is."""

    def __init__(self, root: int) -> None:
        self.names, self.nodes = ["html"], [root]
        self.places: dict[str, list[int]] = {}

    def push(self, name: str, node: int) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.nodes.append(node)

    def last(self, name: str) -> int:
        """Place of the innermost open element of the name, -1 if there is none."""
        places = self.places.get(name)
        return places[-1] if places else -1

    def cut(self, place: int) -> None:
        """Close the element at the place and all within it."""
        for name in self.names[place:]:
            self.places[name].pop()
        del self.names[place:], self.nodes[place:]


def _tags(source: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, closing, name, attributes) of every piece of markup, in one scan forward.

    The name is empty where nothing is opened or closed. The content of a RAW element
    is part of its start tag. A tag ends at the first > outside of quotes; up to a quote
    that is never closed, at the first >. What would be a tag but has no > is text.
    """
    last_end = source.rfind(">")
    broken = -1  # tags that begin before it end at their first >
    position = 0
    while (start := source.find("<", position)) >= 0:
        tag = _TAG.match(source, start)
        other = None if tag and start < last_end else _OTHER.match(source, start)
        if other:
            yield start, other.end(), False, "", ""
        if not tag or start > last_end:
            position = other.end() if other else start + 1
            continue
        if start < broken:
            end = source.find(">", tag.end())
            attrs = source[tag.end():end]
        else:
            end = _quoted_end(source, tag.end())
            attrs = source[tag.end():end] if source[end:end + 1] == ">" else ""
            if source[end:end + 1] != ">":
                broken, end = end + 1, source.find(">", tag.end())
        name, closing = tag[1].lower(), source[start + 1] == "/"
        position = end + 1
        if name in RAW and not closing and not _self_closed(name, attrs):
            inner = re.compile(rf"</{name}[\s/>]", re.I).search(source, position)
            position = source.find(">", inner.start()) + 1 or len(source) if inner else len(source)
        yield start, position, closing, name, attrs


def _quoted_end(source: str, position: int) -> int:
    """Place of the first > outside of quotes; else of the quote that is never closed, or the end."""
    while True:
        position = _PLAIN.match(source, position).end()
        if position == len(source) or source[position] == ">":
            return position
        closed = source.find(source[position], position + 1)
        if closed < 0:
            return position
        position = closed + 1


def _self_closed(name: str, attrs: str) -> bool:
    """Whether a slash closes the tag, one that is no part of a value without quotes."""
    if name not in FOREIGN or not attrs.endswith("/"):
        return False
    tail = _BREAKS.split(attrs)[-1]
    return "=" not in tail[:-1] and not attrs[:len(attrs) - len(tail)].rstrip().endswith("=")


def _hash(text: str) -> int:
    known = _hashes.get(text)
    if known is None:
        known = zlib.crc32(text.encode("utf-8", "surrogatepass")) % FEATURES
        if len(_hashes) < 100_000:
            _hashes[text] = known
    return known


_hashes: dict[str, int] = {}


def levels(forest: Forest) -> list[np.ndarray]:
    """Elements by depth, roots first."""
    depth = np.array(forest.depth)
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(depth) else []


def features(forest: Forest, by_depth: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(element, feature) pairs: names, and how much text, links and controls an element holds."""
    parent = np.array(forest.parent)
    own = np.array([forest.chars, forest.linked, forest.links, forest.signs, forest.controls], float)
    whole = own.copy()
    for nodes in reversed(by_depth[1:]):
        for row in whole:
            np.add.at(row, parent[nodes], row[nodes])
    root = parent < 0
    page_chars = whole[0][root][np.searchsorted(np.flatnonzero(root), np.arange(len(root)), side="right") - 1]
    chars = np.maximum(whole[0], 1)
    columns = {
        "own": np.digitize(own[0], [1, 20, 60, 150, 400]),
        "whole": np.digitize(whole[0], [1, 20, 60, 150, 400, 1500]),
        "density": np.where(whole[0] > 0, np.digitize(whole[1] / chars, [.01, .2, .5, .8, .99]), 6),
        "links": np.digitize(whole[2], [1, 2, 4, 10]),
        "signs": np.where(whole[0] > 0, np.digitize(whole[3] / chars, [.003, .01, .02, .05]), 6),
        "controls": np.digitize(whole[4], [1, 2, 4]),
        "share": np.digitize(whole[0] / np.maximum(page_chars, 1), [.01, .05, .15, .4, .7, .9]),
    }
    columns["both"] = columns["own"] * 8 + columns["signs"]
    columns["text"] = columns["whole"] * 8 + columns["density"]
    elements = [np.repeat(np.arange(len(parent)), [len(n) for n in forest.names])]
    numbers = [np.fromiter((f for n in forest.names for f in n), np.int64)]
    for name, values in columns.items():
        codes = np.array([_hash(f"{name}:{v}") for v in range(64)])
        elements.append(np.arange(len(parent)))
        numbers.append(codes[values])
    return np.concatenate(elements), np.concatenate(numbers)


def text_of(forest: Forest, kept: np.ndarray, pages: int) -> list[str]:
    """The text of the kept elements of each page: references decoded, white space made one space."""
    blocks: list[list[str]] = [[] for _ in range(pages)]
    for node, pieces in forest.runs:
        if kept[node]:
            raw = "".join(pieces)
            words = (html.unescape(raw) if "&" in raw else raw).split()
            if words:
                blocks[forest.page[node]].append(" ".join(words))
    return [" ".join(b) for b in blocks]
