"""A page as a tree of blocks: elements that break lines, with the runs of text between the breaks as leaves."""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

# Fixed names of HTML: elements that start a new block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split()
)
# Elements whose text is never shown as text of the page, or belongs to a control.
SILENT = frozenset(
    "audio button canvas datalist head iframe math noembed noframes noscript object option script select style svg "
    "template textarea title video".split()
)
# An open element of the first kind ends where one of the second kind starts, unless one of the third is between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
PARAGRAPH = ({"p"}, {"table", "td", "th", "caption", "button", "object", "template"})
NAMES = ("class", "id", "role", "itemprop", "aria-label")
_words = re.compile(r"[A-Z]?[a-z]+|[A-Z]+").findall


class Node:
    """A block (``tag``, ``words`` of its names) or, with ``text``, a run; ``parent`` is a place in the list."""

    __slots__ = ("parent", "tag", "words", "hidden", "text", "linked", "chars", "prose", "state")

    def __init__(self, parent: int, tag: str, words=frozenset(), hidden=False, text=None, linked=0):
        self.parent, self.tag, self.words, self.hidden = parent, tag, words, hidden
        self.text, self.linked, self.state = text, linked, None
        self.chars = self.prose = 0


class Page(HTMLParser):
    """Reads markup as browsers do, as far as blocks go: nothing raises, elements left open end with their block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node(-1, "#page")]
        self.stack: list[tuple[str, int]] = []  # (tag, its block), inline elements with the block around them
        self.open: Counter[str] = Counter()
        self.silent = self.links = 0
        self.parts: list[str] = []
        self.linked = 0

    def block(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def flush(self) -> None:
        """End the run of text, at the border of a block."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                at = self.block()
                self.nodes.append(Node(at, self.nodes[at].tag, text=text, linked=min(self.linked, len(text))))
            self.parts, self.linked = [], 0

    def _pop(self) -> None:
        tag, _ = self.stack[-1]
        if tag in BLOCKS or "-" in tag:
            self.flush()
        self.stack.pop()
        self.open[tag] -= 1
        self.silent -= tag in SILENT
        self.links -= tag == "a"

    def _end_open(self, tags: set[str], fence: set[str]) -> None:
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in fence:
                return

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCKS or "-" in tag
        if tag == "body" and self.open["head"]:
            self._end_open({"head"}, set())
        if block:
            self._end_open(*PARAGRAPH)
        if tag in ENDS:
            self._end_open(*ENDS[tag])
        if block:
            self.flush()
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        at = self.block()
        if block and not self.silent:
            given = {k: v or "" for k, v in attrs}
            words = frozenset(w.lower() for k in NAMES for w in _words(given.get(k, "")))
            style = given.get("style", "").replace(" ", "").lower()
            hidden = "hidden" in given or "display:none" in style or given.get("aria-hidden") == "true"
            self.nodes.append(Node(at, tag, words, hidden))
            at = len(self.nodes) - 1
        self.stack.append((tag, at))
        self.open[tag] += 1
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash at the end of a tag means nothing in HTML

    def handle_endtag(self, tag):
        if tag == "br":
            self.parts.append(" ")
        if not self.open[tag]:
            return
        inline = tag not in BLOCKS and "-" not in tag and tag not in SILENT
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name == tag:
                if inline and any(t in BLOCKS or "-" in t for t, _ in self.stack[i + 1 :]):
                    del self.stack[i]  # the blocks opened inside stay open
                    self.open[tag] -= 1
                    self.links -= tag == "a"
                    return
                while len(self.stack) > i:
                    self._pop()
                return

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.linked += len(" ".join(data.split()))


def tree(html: str) -> list[Node]:
    """The nodes in page order, a parent before its children; only those with text, the root always first.

    ``chars``, ``linked`` (in links) and ``prose`` (in runs of eight words or more, mostly outside of links) are summed
    over all that stands below a node.
    """
    page = Page()
    page.feed(html)
    page.close()
    page.flush()
    nodes = page.nodes
    for node in nodes:
        if node.text is not None:
            node.chars = len(node.text)
            if node.text.count(" ") >= 7 and 2 * node.linked < node.chars:
                node.prose = node.chars
    for node in reversed(nodes[1:]):
        above = nodes[node.parent]
        above.chars += node.chars
        above.linked += node.linked
        above.prose += node.prose
    place, kept = {-1: -1}, []
    for i, node in enumerate(nodes):
        if node.chars or not i:
            place[i] = len(kept)
            node.parent = place[node.parent]
            kept.append(node)
    return kept
