"""A page as a tree: block elements and, below them, the text runs between block borders."""

from __future__ import annotations

import html
import re

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Element kinds of HTML.
RAW = frozenset("script style textarea title iframe noframes noembed".split())  # their text isn't shown
FOREIGN = frozenset(("svg", "math"))  # '/>' ends an element inside
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\t\n\f\r />])", re.I) for tag in (*RAW, "xmp", *FOREIGN)}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSE_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hgroup hr main menu nav ol p pre search section table ul xmp".split()
)
BLOCK = CLOSE_P | frozenset(
    "html head body li dd dt dir center tr td th tbody thead tfoot caption option select optgroup button label legend summary"
    " dialog canvas video audio map".split()
)
#: a start tag of the key ends open elements of the second set, up to one of the third
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
BARRIER = frozenset("table td th caption button html".split())  # an end tag inside doesn't reach beyond


class Node:
    """An element (text is None) or a text run; size and linked count the characters in it and those in links."""

    __slots__ = ("attrs", "linked", "main", "parent", "size", "tag", "text")

    def __init__(self, parent: int, tag: str, attrs: str = "", text: str | None = None, linked: int = 0, main: bool | None = None):
        self.parent, self.tag, self.attrs, self.text, self.linked, self.main = parent, tag, attrs, text, linked, main
        self.size = len(text or "")


def _names(attrs: str) -> tuple[str, bool | None]:
    """Class, id and role of a tag in lower case; data-main marks labelled seed pages."""
    found, main = [], None
    for name, a, b, c in _ATTRIBUTE.findall(attrs):
        if name == "data-main":
            main = (a or b or c) == "1"
        else:
            found.append(a or b or c)
    return " ".join(found), main


def parse(page: str | None) -> list[Node]:
    """Nodes in page order, each after its parent; the first is the root.

    Missing end tags are implied where HTML implies them, end tags without a
    start are ignored, and a page may break off anywhere.  Text of ``RAW``
    elements is left out up to their end tag, that of xmp is taken as it stands;
    math, svg, object, noscript and template are ordinary inline elements.
    """
    nodes = [Node(-1, "root", main=False)]
    if not page:
        return nodes
    open_: list[tuple[str, int]] = [("root", 0)]
    count: dict[str, int] = {}
    text: list[str] = []
    linked = links = 0
    at, size = 0, len(page)
    foreign = 0  # open svg and math elements
    ends: dict[str, int] = {}

    def end_of(tag: str) -> int:
        """Place of the next end tag of ``tag``; the page's end without one."""
        if ends.get(tag, -1) < at:
            m = _RAW_END[tag].search(page, at)
            ends[tag] = m.start() if m else size
        return ends[tag]

    def add(run: str) -> None:
        nonlocal linked
        text.append(run)
        if links:
            linked += len(run)

    def flush() -> None:
        nonlocal linked
        if text:
            run = "".join(text)
            if "&" in run:
                run = html.unescape(run)
            run = " ".join(run.split())
            if run:
                parent = open_[-1][1]
                nodes.append(Node(parent, nodes[parent].tag, "", run, linked, nodes[parent].main))
            text.clear()
        linked = 0

    def pop() -> None:
        count[open_.pop()[0]] -= 1

    def close(tags: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        """End the outermost open element of ``tags`` above one of ``until``."""
        if not any(count.get(t) for t in tags):
            return
        k, found = len(open_) - 1, 0
        while k and open_[k][0] not in until:
            if open_[k][0] in tags:
                found = k
            k -= 1
        while found and len(open_) > found:
            pop()

    while m := _TOKEN.search(page, at):
        start = m.start()
        if start > at:
            add(page[at:start])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            if foreign and page.startswith("<![CDATA[", start):
                add(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        tag = tag.lower()
        closed = foreign and page.endswith("/>", start, at)
        if m["end"] or m["end2"]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in FOREIGN:
                foreign = max(0, foreign - 1)
                if tag == "svg":
                    text.append(" ")
            elif tag in BLOCK and count.get(tag):
                flush()
                k = len(open_) - 1
                while k and open_[k][0] != tag and open_[k][0] not in BARRIER:
                    k -= 1
                if open_[k][0] == tag:
                    while len(open_) > k:
                        pop()
                        links = 0
            elif tag in BLOCK:
                flush()
            continue
        if tag in RAW:
            # inside svg and math such an element can't reach beyond them
            if not foreign or not closed and end_of(tag) < min(end_of(t) for t in FOREIGN):
                at = end_of(tag)
            text.append(" ")
            continue
        if tag in FOREIGN:
            if not page.endswith("/>", start, at):
                foreign += 1
            if tag == "svg":
                text.append(" ")
            continue
        if tag == "br" or foreign and tag == "text":
            text.append(" ")
            continue
        if tag == "a" and not closed:
            links += 1
        if tag not in BLOCK or tag in VOID:
            if tag == "hr":
                flush()
                close({"p"}, BARRIER)
            continue
        flush()
        foreign = 0  # HTML blocks end svg and math
        if tag in CLOSE_P:
            close({"p"}, BARRIER)
        if tag in ENDS:
            close(*ENDS[tag])
        names, main = _names(m["attrs"] or m["attrs2"] or "") if (m["attrs"] or m["attrs2"]) else ("", None)
        parent = open_[-1][1]
        nodes.append(Node(parent, tag, names, main=nodes[parent].main if main is None else main))
        open_.append((tag, len(nodes) - 1))
        count[tag] = count.get(tag, 0) + 1
        if tag == "xmp":
            end = end_of(tag)
            add(html.escape(page[at:end], quote=False))
            at = end
    if at < size:
        add(page[at:])
    flush()
    for node in nodes[:0:-1]:
        nodes[node.parent].size += node.size
        nodes[node.parent].linked += node.linked
    return nodes
