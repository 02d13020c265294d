"""A small HTML tree: block elements as nodes, with the text that stands directly in them."""

from __future__ import annotations

import html
import re
from bisect import bisect_right

# Element groups of the HTML standard.
BLOCKS = frozenset(
    """address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript object ol optgroup
    option p pre search section select summary svg table tbody td template textarea tfoot th thead tr ul video audio
    canvas script style title""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_ENDS_P = BLOCKS - frozenset("button canvas iframe noscript object script style svg template title video audio".split())
# A start tag ends the open elements named here, unless one of the scope stands between.
_LISTS, _TABLES = frozenset({"ul", "ol", "menu", "dir"}), frozenset({"table"})
_CLOSES = {
    "li": ({"li"}, _LISTS),
    "dt": ({"dt", "dd"}, frozenset({"dl"})),
    "dd": ({"dt", "dd"}, frozenset({"dl"})),
    "option": ({"option"}, frozenset({"select"})),
    "tr": ({"tr", "td", "th"}, _TABLES),
    "td": ({"td", "th"}, _TABLES | {"tr"}),
    "th": ({"td", "th"}, _TABLES | {"tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, _TABLES),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, _TABLES),
}
_REST = (
    r"|<([a-zA-Z][^\s/>]*+)([^>]*+)>"  # start tag with a stray quote
    r"|</([a-zA-Z][^\s/>]*+)[^>]*+>"  # end tag
    r"|<[!?/][^>]*+>"  # doctype and the like
)
_COMMENT = r"<!--(?:>|->|.*?(?:--!?>|(\Z)))"
_TAG = r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
_TOKEN = re.compile(_COMMENT + _TAG + _REST, re.S)
# For the rest of a page with a quote that is never closed: quotes mean nothing there.
_LOOSE = re.compile(_COMMENT + r"|(?!)()()" + _REST, re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Node:
    """A block element. ``runs`` are ``(place in the page, text, in a link)``."""

    __slots__ = ("tag", "names", "parent", "runs", "links")

    def __init__(self, tag: str, names: str, parent: int):
        self.tag, self.names, self.parent = tag, names, parent
        self.runs: list[tuple[int, str]] = []
        self.links = 0


def names_of(attributes: str) -> str:
    """Values of class, id, role and itemprop, in lower case."""
    if "=" not in attributes:
        return ""
    return " ".join([(a or b or c).lower() for _, a, b, c in _ATTRIBUTE.findall(attributes)])


def parse(page: str) -> list[Node]:
    """Nodes in page order; node 0 is the page itself, every other has an earlier parent."""
    nodes = [Node("html", "", -1)]
    open_tags: list[tuple[str, int]] = [("html", 0)]  # tag, node of the nearest block
    places: dict[str, list[int]] = {"html": [0]}  # where the open elements of a tag stand
    blocks = [0]  # where the open blocks stand
    links = 0
    place = 0

    def text(piece: str) -> None:
        nonlocal place
        if piece and not piece.isspace():
            node = nodes[open_tags[-1][1]]
            node.runs.append((place, html.unescape(piece) if "&" in piece else piece))
            if links:
                node.links += len(piece)
        elif piece and (runs := nodes[open_tags[-1][1]].runs) and runs[-1][0] == place:
            runs.append((place, " "))

    def pop(depth: int) -> None:
        nonlocal links, place
        while len(open_tags) > depth:
            tag, _ = open_tags.pop()
            places[tag].pop()
            if tag == "a":
                links -= 1
            elif tag in BLOCKS:
                blocks.pop()
                place += 1

    def close(tags: set[str], scope: frozenset[str]) -> None:
        """End open elements of ``tags`` up to the nearest one of ``scope``."""
        floor = max([places[t][-1] for t in scope if places.get(t)], default=0)
        above = [own[i] for t in tags if (own := places.get(t)) and (i := bisect_right(own, floor)) < len(own)]
        if above:
            pop(min(above))

    at, token = 0, _TOKEN
    # No tag ends behind the last ">", so nothing is looked for there, again and again.
    last = page.rfind(">") + 1
    while found := token.search(page, at, last):
        text(page[at : found.start()])
        at = found.end()
        if found[1] is not None:  # a comment that is not closed takes the rest
            return nodes
        if found[4]:
            token = _LOOSE
        tag = (found[2] or found[4] or "").lower()
        if tag:
            attributes = found[3] or found[5] or ""
            if tag in _ENDS_P and places.get("p"):
                close({"p"}, _SCOPE)
            if tag in _CLOSES:
                close(*_CLOSES[tag])
            if tag == "br":
                text(" ")
                continue
            if tag in VOID:
                place += tag == "hr"
                continue
            if tag in ("html", "body") and places.get(tag):
                continue
            block = tag in BLOCKS
            if block:
                nodes.append(Node(tag, names_of(attributes), open_tags[-1][1]))
                place += 1
            if attributes.endswith("/") and not block:
                continue
            places.setdefault(tag, []).append(len(open_tags))
            if block:
                blocks.append(len(open_tags))
            open_tags.append((tag, len(nodes) - 1 if block else open_tags[-1][1]))
            links += tag == "a"
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
                stop = end.start() if end else len(page)
                text(page[at:stop])
                at = stop
        elif found[6] and places.get(tag := found[6].lower()):
            if tag in ("html", "body"):
                continue
            depth = places[tag][-1]
            # An inline end tag does not end blocks that were opened after it.
            if tag in BLOCKS or not (blocks and blocks[-1] > depth):
                pop(depth)
    rest = page[at:].split("<!--")[0]
    text(rest[: rest.rfind("<")] if re.search(r"<[a-zA-Z/!?][^<]*\Z", rest) else rest)
    return nodes


_SCOPE = frozenset("table td th caption button object template".split())
