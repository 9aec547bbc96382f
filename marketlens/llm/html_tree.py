"""Block trees of web pages: a forgiving reader of tags, and trees condensed for alignment.

Only block elements become nodes; inline markup vanishes into the text of its block. Siblings alike are merged, so a tree
stays small however many paragraphs a page has. Nesting beyond ``DEPTH`` falls to the ancestor at that depth.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from typing import NamedTuple

# Element names of HTML.
BLOCKS = frozenset("""
address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select
summary table tbody td template textarea tfoot th thead title tr ul iframe object svg canvas video audio
""".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figure figcaption table thead tbody tfoot tr td th".split())
#: An element is closed by the start of one of these, up to the element that holds it.
CLOSED_BY = {
    "p": BLOCKS - {"option", "optgroup", "button", "iframe", "object", "svg", "canvas", "video", "audio", "noscript", "template",
                   "textarea", "select", "title", "head", "html", "body"},
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot", "thead"}), "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}), "option": frozenset({"option", "optgroup"}),
    "thead": frozenset({"tbody", "tfoot"}), "tbody": frozenset({"tbody", "tfoot"}),
}
TABLE_PARTS = frozenset("tr td th thead tbody tfoot".split())
#: Open elements above these are not looked at when a start tag closes others.
STOPS = frozenset("table td th caption button ul ol menu dir dl select template".split())
TABLE_STOPS = frozenset({"table", "template"})
IN_HEAD = frozenset("title meta link style script base noscript template".split())

DEPTH = 100
LOOK_UP = 100  # open elements that a start tag may close
CACHED = 1 << 12  # start tags and labels kept, as they repeat on pages
SAME_SIBLINGS = 8  # plain containers that stay apart under one parent; further ones join the last of them

_TAG = re.compile(
    r"<(?:!--(?P<comment>)|(?P<other>[!?])|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>)")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_DIGITS = re.compile(r"\d+")


@functools.lru_cache(maxsize=CACHED)
def label_of(tag: str, names: tuple[str, ...]) -> str:
    """What an aligned node must have in common; digits do not count."""
    return ".".join([tag, *sorted({_DIGITS.sub("", n) for n in names})])


class Node:
    """A block element: tag, names (class and id words), role, label, parent, children."""

    __slots__ = ("tag", "names", "role", "parent", "children", "depth", "number", "label")

    def __init__(self, tag: str, names: tuple[str, ...] = (), role: str = "", parent: "Node | None" = None):
        self.tag, self.names, self.role, self.parent = tag, names, role, parent
        self.children: list[Node] = []
        self.depth = parent.depth + 1 if parent else 0
        self.number = -1
        self.label = label_of(tag, names) if names else tag


class Block(NamedTuple):
    """A stretch of text in one block element, white space made even, and how many of its characters stand in links."""

    node: Node
    text: str
    linked: int


def _attributes(rest: str) -> tuple[tuple[str, ...], str]:
    """Names and role of a start tag; only short ones are kept, so that the memory is bounded."""
    if not rest or rest.isspace():
        return (), ""
    return _cached(rest) if len(rest) <= 256 else _parsed(rest)


def _parsed(rest: str) -> tuple[tuple[str, ...], str]:
    names, role = [], ""
    for m in _ATTRIBUTE.finditer(rest):
        key = m[1].lower()
        if key in ("class", "id"):
            names += html.unescape(m[2] or m[3] or m[4] or "").lower().split()
        elif key in ("role", "itemprop"):
            role += " " + (m[2] or m[3] or m[4] or "").lower()
    return tuple(names), role.strip()


_cached = functools.lru_cache(maxsize=CACHED)(_parsed)


class _Reader:
    """Open elements, the text since the last block border, and the blocks so far."""

    def __init__(self):
        self.root = Node("")
        self.open: list[tuple[str, Node]] = [("", self.root)]
        self.count: Counter[str] = Counter()
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.linked, self.link_at = 0, 0  # characters in links; how many elements were open at the link's start

    def add(self, piece: str) -> None:
        """Text between tags."""
        if piece:
            if "&" in piece:
                piece = html.unescape(piece)
            self.text.append(piece)
            if self.link_at:
                self.linked += len("".join(piece.split()))

    def finish(self, node: Node | None = None) -> None:
        """A block border: the text so far belongs to the innermost open element."""
        if not self.text:
            self.linked = 0
            return
        words = " ".join("".join(self.text).split())
        if words:
            self.blocks.append(Block(node or self.open[-1][1], words, self.linked))
        self.text.clear()
        self.linked = 0

    def _close(self, k: int) -> None:
        for tag, _ in self.open[k:]:
            self.count[tag] -= 1
        del self.open[k:]
        if self.link_at > k:
            self.link_at = 0

    def start(self, tag: str, rest: str) -> None:
        """A block element begins; it may end others."""
        if tag in ("html", "body") and self.count[tag]:
            return
        if self.count["head"] and tag not in IN_HEAD:
            self._close(max(k for k, (t, _) in enumerate(self.open) if t == "head"))
        stops = TABLE_STOPS if tag in TABLE_PARTS else STOPS
        for k in range(len(self.open) - 1, max(0, len(self.open) - LOOK_UP), -1):
            over = self.open[k][0]
            if tag in CLOSED_BY.get(over, ()):
                self._close(k)
            elif over in stops:
                break
        if tag not in VOID:
            parent = self.open[-1][1]
            node = parent if parent.depth >= DEPTH else Node(tag, *_attributes(rest), parent)
            if node is not parent:
                parent.children.append(node)
            self.open.append((tag, node))
            self.count[tag] += 1

    def end(self, tag: str) -> None:
        """An end tag closes the innermost open element of its name in the same table cell; others mean nothing."""
        if not self.count[tag] or tag in ("html", "body"):
            return
        for k in range(len(self.open) - 1, 0, -1):
            over = self.open[k][0]
            if over == tag:
                self._close(k)
                return
            if over in ("table", "td", "th", "caption") and tag not in TABLE_PARTS and tag != "table":
                return


def read(page: str) -> tuple[Node, list[Block]]:
    """The root (no tag) of a page's block tree, and its texts in page order."""
    reader, at, lower = _Reader(), 0, None
    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            reader.add(page[at:])
            break
        reader.add(page[at:m.start()])
        at = m.end()
        if m["comment"] is not None or m["other"]:
            close = "-->" if m["comment"] is not None else ">"
            end = page.find(close, at)
            at = len(page) if end < 0 else end + len(close)
            continue
        tag, ends = m["name"].lower(), bool(m["end"])
        if not ends and tag in RAW:
            # Text of these holds no markup; only the matching end tag ends it.
            lower = page.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at)
            end = len(page) if end < 0 else end
            raw, at = page[at:end], page.find(">", end) + 1 or len(page)
            if tag not in ("script", "style"):
                reader.finish()
                node = Node(tag, *_attributes(m["rest"]), reader.open[-1][1])
                node.parent.children.append(node)
                reader.add(raw)
                reader.finish(node)
        elif tag == "br":
            reader.text.append(" ")
        elif tag == "a":
            reader.link_at = 0 if ends else len(reader.open)
        elif tag in BLOCKS:
            reader.finish()
            if ends:
                reader.end(tag)
            else:
                reader.start(tag, m["rest"])
    reader.finish()
    return reader.root, reader.blocks


def condense(root: Node) -> list[tuple[int, str]]:
    """The tree with like siblings merged, as (depth, label) in page order; sets the number of every node's place in it.

    Siblings with the same label become one node if the label says something (a class, an id, a flow element) or if they
    stand next to each other; plain containers in between stay apart, up to ``SAME_SIBLINGS`` of them.
    """
    out: list[tuple[int, str]] = []
    stack = [(0, root.label, [root])]
    while stack:
        depth, label, members = stack.pop()
        for node in members:
            node.number = len(out)
        out.append((depth, label))
        groups: list[tuple[str, list[Node]]] = []
        seen: dict[str, list[int]] = {}
        for node in members:
            for child in node.children:
                name = child.label
                places = seen.setdefault(name, [])
                plain = "." not in name and child.tag not in FLOW
                if places and (not plain or places[-1] == len(groups) - 1 or len(places) >= SAME_SIBLINGS):
                    groups[places[-1]][1].append(child)
                else:
                    places.append(len(groups))
                    groups.append((name, [child]))
        stack += [(depth + 1, name, nodes) for name, nodes in reversed(groups)]
    return out
