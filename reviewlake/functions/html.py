"""Outline of an HTML page: the elements and text pieces the review rules look at.

Only the tolerant reading of tags happens here, in Arrow batches. Which elements
are reviews, and what their fields are, is decided by column expressions over
the outline (``operators.extract``).
"""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column

from .arrow import udf_in_parts

# nodes: kept elements in document order. The next `size` nodes lie inside a
# node; its text is pieces[p0:p1]; `only` is the text of an element whose one
# child is a string (or, again, such an element).
OUTLINE_TYPE = (
    "struct<nodes: array<struct<tag: string, attrs: map<string,string>, size: int,"
    " p0: int, p1: int, only: string>>, pieces: array<string>, error: string>"
)

# What the review rules ask for.
TAGS = {"a", "p", "h2", "h3", "h4", "img", "strong", "time"}
ATTRS = {
    "alt",
    "aria-label",
    "class",
    "content",
    "data-consumer-country-flag",
    "data-consumer-profile-reviews-link",
    "data-rating",
    "data-review-content",
    "data-review-id",
    "data-reviewid",
    "data-service-review-id",
    "data-service-review-rating",
    "datetime",
    "href",
    "id",
    "itemprop",
    "itemtype",
    "rel",
    "title",
}

# HTML standard: elements without content, elements whose text is not shown as
# text, and optional end tags (a start tag in the set ends the open element,
# looked for no further up than the given limits).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content the parser takes for text, or may in some version of Python.
RAW_TEXT = set("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
#: A tag of nothing but a name, as most are.
PLAIN = re.compile("<(/?)([a-zA-Z][a-zA-Z0-9]*)>")
HIDDEN = {"script", "style", "template", "rt", "rp"}
BLOCKS = set(
    "address article aside blockquote body center details dialog dir div dl dd dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html"
    " li main menu nav ol p pre search section summary table tbody td tfoot th thead"
    " tr ul".split()
)
# Parsers at large also end a heading where one of these begins.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
HEADING_ENDS = {"p", "li", "table", "form", "fieldset"} | HEADINGS
_CELL = {"table", "td", "th", "caption", "button", "object", "template", "html"}
_NOT_IN_P = set("body html caption dd dt li tbody td tfoot th thead tr".split())
ENDS = {t: [("p", _CELL)] for t in BLOCKS - _NOT_IN_P}
ENDS |= {
    "li": [("li", {"ul", "ol", "menu", *_CELL}), ("p", _CELL)],
    "dt": [(t, {"dl", *_CELL}) for t in ("dd", "dt", "p")],
    "dd": [(t, {"dl", *_CELL}) for t in ("dd", "dt", "p")],
    "td": [(t, {"table", "tr"}) for t in ("td", "th")],
    "th": [(t, {"table", "tr"}) for t in ("td", "th")],
    "tr": [("tr", {"table"})],
    "tbody": [(t, {"table"}) for t in ("thead", "tbody", "tfoot")],
    "thead": [(t, {"table"}) for t in ("thead", "tbody", "tfoot")],
    "tfoot": [(t, {"table"}) for t in ("thead", "tbody", "tfoot")],
    "option": [("option", {"select"})],
    "optgroup": [("optgroup", {"select"})],
}


class _Outline(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = []
        self.pieces: list[str] = []
        self._text: list[str] = []
        self._hidden = 0
        # Open elements: tag, node index, number of children, the only string.
        self._open: list[list] = [["", -1, 0, None]]
        # The depths at which each tag, and any block, is open: whatever the depth,
        # the nearest one is at hand.
        self._depths: dict[str, list[int]] = {}
        self._blocks: list[int] = []

    def updatepos(self, i: int, j: int) -> int:
        return j  # nobody asks for line numbers

    def parse_starttag(self, i: int) -> int:
        end = self._plain_tags(i)
        return end if end > i else super().parse_starttag(i)

    def parse_endtag(self, i: int) -> int:
        end = i if self.cdata_elem else self._plain_tags(i)
        return end if end > i else super().parse_endtag(i)

    def _plain_tags(self, i: int) -> int:
        """Handles the plain tags that follow each other from ``i``; where they end."""
        while plain := PLAIN.match(self.rawdata, i):
            tag = plain[2].lower()
            if plain[1]:
                self.handle_endtag(tag)
            elif tag in RAW_TEXT:
                break
            else:
                self.handle_starttag(tag, ())
            i = plain.end()
        return i

    def handle_data(self, data: str) -> None:
        self._text.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()
        self._add_child(data)

    def handle_starttag(self, tag: str, attrs: Sequence) -> None:
        self._flush()
        for ended, limits in ENDS.get(tag, ()):
            self._end_nearest(ended, limits)
        if tag in HEADING_ENDS and self._open[-1][0] in HEADINGS:
            self._pop()
        kept = {}
        for name, value in attrs:
            if name in ATTRS and name not in kept:
                kept[name] = value or ""
        index = -1
        if kept or tag in TAGS:
            index = len(self.nodes)
            at = len(self.pieces)
            self.nodes.append([tag, kept, 0, at, at, None])
        if tag in VOID:
            self._add_child(None)
            return
        self._hidden += tag in HIDDEN
        for places in self._places(tag):
            places.append(len(self._open))
        self._open.append([tag, index, 0, None])

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        self._end_nearest(tag, () if tag in BLOCKS else BLOCKS)

    def finish(self) -> None:
        self.close()
        self._flush()
        while len(self._open) > 1:
            self._pop()

    def _end_nearest(self, tag: str, limits) -> None:
        depth = self._nearest(self._depths.get(tag))
        if not depth:
            return
        if limits is BLOCKS:
            limit = self._nearest(self._blocks)
        else:
            limit = max((self._nearest(self._depths.get(name)) for name in limits), default=0)
        if depth >= limit:
            while len(self._open) > depth:
                self._pop()

    @staticmethod
    def _nearest(places: list[int] | None) -> int:
        return places[-1] if places else 0

    def _places(self, tag: str) -> list[list[int]]:
        own = self._depths.setdefault(tag, [])
        return [own, self._blocks] if tag in BLOCKS else [own]

    def _pop(self) -> None:
        tag, index, _, only = self._open.pop()
        for places in self._places(tag):
            places.pop()
        self._hidden -= tag in HIDDEN
        if index >= 0:
            node = self.nodes[index]
            node[2] = len(self.nodes) - index - 1
            node[4] = len(self.pieces)
            if tag == "a":
                node[5] = only
        self._add_child(only)

    def _add_child(self, only: str | None) -> None:
        parent = self._open[-1]
        parent[2] += 1
        parent[3] = only if parent[2] == 1 else None

    def _flush(self) -> None:
        if self._text:
            text = "".join(self._text)
            self._text.clear()
            self._add_child(text)
            shown = text.strip()
            if shown and not self._hidden:
                self.pieces.append(shown)


def _outlines(html: pa.Array) -> pa.Array:
    nodes, node_ends = [], [0]
    pieces, piece_ends = [], [0]
    errors = []
    for value in html:
        page = _Outline()
        error = None
        try:
            page.feed(value.as_py() or "")
            page.finish()
        except Exception as ex:  # one unreadable page must not stop the others
            page, error = _Outline(), f"{type(ex).__name__}: {ex}"
        nodes += page.nodes
        node_ends.append(len(nodes))
        pieces += page.pieces
        piece_ends.append(len(pieces))
        errors.append(error)
    tags, attrs, sizes, starts, ends, only = zip(*nodes) if nodes else [()] * 6
    node_array = pa.StructArray.from_arrays(
        [
            pa.array(tags, pa.string()),
            pa.array([list(a.items()) for a in attrs], pa.map_(pa.string(), pa.string())),
            pa.array(sizes, pa.int32()),
            pa.array(starts, pa.int32()),
            pa.array(ends, pa.int32()),
            pa.array(only, pa.string()),
        ],
        names=["tag", "attrs", "size", "p0", "p1", "only"],
    )
    return pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array(node_ends, pa.int32()), node_array),
            pa.ListArray.from_arrays(
                pa.array(piece_ends, pa.int32()), pa.array(pieces, pa.string())
            ),
            pa.array(errors, pa.string()),
        ],
        names=["nodes", "pieces", "error"],
    )


def outline(html: Column) -> Column:
    """The page's outline; a null page has an empty one."""
    return udf_in_parts(_outlines, OUTLINE_TYPE)(html)


# The helpers travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
