"""The main text of HTML pages, by two passes over their blocks.

A page is cut into blocks: runs of text without a block-level tag, or two line breaks,
between them. Blocks in elements that never hold running text (scripts, forms, menus, page
headers and footers, asides, and elements named as adverts, notices, comments and the like)
are left out at once. The others are judged twice:

1. By their own measures. A block of which links make up more than ``LINKS`` is out. One of
   ``LENGTH`` characters or more, of whose words at least ``STOP_WORDS`` are stop words, is
   in. Everything else is undecided: headings, short blocks, prose without stop words.
2. By their surroundings. An undecided block inherits the label of the nearest decided one;
   of two at the same distance, the one that is in. The borders of an article count as
   decided blocks that are in, so that short articles need no long block.

Where a page marks an article (``article``, else ``main``), blocks outside of it are out,
unless only those outside are in by their own measures. Pages are read one by one in the
tasks, each in time proportional to its length; nothing is shuffled.

Defined results: a null or empty page has an empty text; markup that is cut off or never
closed ends with the page; character references are decoded once, unknown ones are left; a
block's white space (of any script) becomes one space; repeated rows get the same result;
input columns named as a result column are replaced, others are carried along.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import table

#: Share of a block's characters in links, its length, and its share of stop words.
LINKS, LENGTH, STOP_WORDS = 0.5, 70, 0.15

# Frequent function words of English, German, French and Spanish.
STOP = set(
    """
    a and are as at be but by for from have in is it not of on or that the they this to was which with you
    als an auch auf das dem den der des die ein eine es für im ist mit nicht sich sie und von zu
    au avec ce dans de du elle en est et il la le les ne par pas plus pour que qui se sur un une
    al como con del el la las lo los más no o para por se su y
    """.split()
)
# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
BLOCK = set(
    """
    address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt
    fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li
    main menu nav noscript object ol optgroup option p pre search section select summary svg table tbody td
    template tfoot th thead title tr ul video audio canvas label
    """.split()
)
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: An element of the key, if innermost, ends where one of these begins.
ENDS = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}}
ENDS |= {"th": ENDS["td"], "tr": {"tr"}, "option": {"option", "optgroup"}}

# Elements that hold no running text, by tag, role, and the first or last part of a class or id.
OUT_TAGS = set(
    """
    aside audio button canvas dialog fieldset form head label legend menu nav noscript object search select
    svg template video
    """.split()
)
OUT_ROLES = set(
    """
    alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar
    """.split()
)
OUT_NAMES = set(
    """
    ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies
    copyright disqus footer masthead menu modal nav navbar navigation newsletter notice notices pager
    pagination popup promo promoted promotion recommended related replies reply respond share sharing
    sidebar signup social sponsor sponsored subscribe subscription teaser teasers toolbar widget
    """.split()
)
#: The first part of a class that says what the element does not have.
NOT = {"has", "no", "with", "without"}
#: Of an article's own names, those that say it is none.
NO_ARTICLE = {"ad", "ads", "advert", "comment", "comments", "promo", "related", "reply", "sponsored", "teaser"}

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/<>]*)(?P<attrs>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?=[/A-Za-z])[^<>]*\Z",
    re.DOTALL,
)
_ATTR = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_EDGES = re.compile(r"^\W+|\W+$")


@dataclass
class Block:
    """Text with its markup's circumstances; ``region`` is the number of its article, 0 for none."""

    text: str
    linked: int
    heading: bool
    region: int
    article: bool


@dataclass
class Reader:
    """Cuts a page into blocks; those in elements that are left out are dropped."""

    blocks: list[Block] = field(default_factory=list)
    #: Open block-level elements: tag, whether left out, region, whether that is an article.
    open: list[tuple[str, bool, int, bool]] = field(default_factory=lambda: [("", False, 0, False)])
    names: Counter = field(default_factory=Counter)
    pieces: list[tuple[str, bool]] = field(default_factory=list)
    heading: bool = False
    link: bool = False
    link_depth: int = 0
    breaks: int = 0
    regions: int = 0

    def read(self, page: str) -> list[Block]:
        at = 0
        lower = None
        while found := _MARKUP.search(page, at):
            self.text(page[at : found.start()])
            at, tag = found.end(), (found["tag"] or "").lower()
            if not tag:
                continue
            if found["end"]:
                self.end(tag)
                continue
            self.start(tag, found["attrs"])
            if tag in RAW:
                if lower is None:
                    lower = page.lower() if page.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), page)
                at = lower.find(f"</{tag}", at)
                at = len(page) if at < 0 else at
        self.text(page[at:])
        self.flush()
        return self.blocks

    def text(self, text: str) -> None:
        if text:
            if not text.isspace():
                self.breaks = 0
            self.pieces.append((text, self.link))

    def flush(self) -> None:
        if self.pieces:
            _, out, region, article = self.open[-1]
            if not out:
                text = " ".join(html.unescape("".join(t for t, _ in self.pieces)).split())
                if text:
                    linked = len("".join(html.unescape("".join(t for t, link in self.pieces if link)).split()))
                    self.blocks.append(Block(text, linked, self.heading, region, article))
            self.pieces = []
        self.breaks = 0

    def start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.pieces.append((" ", self.link))
            self.breaks += 1
            if self.breaks > 1:
                self.flush()
        elif tag == "a":
            self.link, self.link_depth = "href" in attrs.lower(), len(self.open)
        elif tag in BLOCK:
            self.flush()
            if tag in ENDS.get(self.open[-1][0], ()):
                self.close()
            self.heading = tag in HEADING
            if tag not in VOID and not attrs.endswith("/"):
                self.open.append(self.opened(tag, attrs))
                self.names[tag] += 1

    def opened(self, tag: str, attrs: str) -> tuple[str, bool, int, bool]:
        _, out, region, article = self.open[-1]
        left_out = self.left_out(tag, attrs, bool(region))
        if not left_out and (tag == "article" and not article or tag == "main" and not region):
            self.regions += 1
            region, article = self.regions, tag == "article"
        return tag, out or left_out, region, article

    def left_out(self, tag: str, attrs: str, inside: bool) -> bool:
        if tag in OUT_TAGS or tag == "footer" or tag == "header" and not inside:
            return True
        if not attrs.strip() or tag in ("html", "body", "main"):
            return False
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
        words = f"{given.get('class', '')} {given.get('id', '')}".split()
        parts = [[p.lower() for p in _PARTS.findall(w)] or [""] for w in words]
        if "hidden" in given or given.get("aria-hidden") == "true" or given.get("role", "").lower() in OUT_ROLES:
            return True
        if re.search(r"display\s*:\s*none", given.get("style", "")):
            return True
        if tag == "article":
            return any(NO_ARTICLE & {p[0], p[-1]} for p in parts)
        return any(OUT_NAMES & {p[0], p[-1]} for p in parts if p[0] not in NOT)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link = False
        elif tag in BLOCK:
            self.flush()
            self.heading = False
            if self.names[tag]:
                while self.close() != tag:
                    pass

    def close(self) -> str:
        tag = self.open.pop()[0]
        self.names[tag] -= 1
        if len(self.open) < self.link_depth:
            self.link = False
        return tag


def own_label(block: Block) -> bool | None:
    """Whether a block is in, by its own measures; None: undecided."""
    shown = len(block.text.replace(" ", ""))
    if block.linked > LINKS * shown:
        return False
    if block.heading or len(block.text) < LENGTH:
        return None
    words = block.text.split()
    stops = sum(w in STOP or _EDGES.sub("", w) in STOP for w in map(str.lower, words))
    return True if stops >= STOP_WORDS * len(words) else None


def inherited(labels: list[bool | None], inside: bool) -> list[bool]:
    """The labels, undecided ones taken from the nearest decided one.

    ``inside``: the borders count as decided; without them, and with nothing decided, all are in.
    """
    edge = True if inside else None

    def nearest(labels: list[bool | None]) -> list[tuple[float, bool | None]]:
        """Distance and label of the last decided one up to each place."""
        out, at, last = [], -1, edge
        for i, label in enumerate(labels):
            if label is not None:
                at, last = i, label
            out.append((float("inf") if last is None else i - at, last))
        return out

    before, after = nearest(labels), nearest(labels[::-1])[::-1]
    chosen = []
    for a, b in zip(before, after):
        if a[1] is None and b[1] is None:
            chosen.append(True)
        else:
            chosen.append(bool(a[1]) if a[0] < b[0] else bool(b[1]) if b[0] < a[0] else bool(a[1] or b[1]))
    return chosen


def main_text(page: str) -> str:
    """The blocks of a page that are in, one a line."""
    blocks = Reader().read(page)
    labels = [own_label(b) for b in blocks]
    # Articles before other regions, these before pages without any.
    for belongs in (lambda b: b.article, lambda b: b.region > 0):
        marked = [belongs(b) for b in blocks]
        if any(marked) and (
            any(m and x for m, x in zip(marked, labels)) or not any(x for m, x in zip(marked, labels) if not m)
        ):
            break
    else:
        marked = []
    if not marked:
        return "\n".join(b.text for b, ok in zip(blocks, inherited(labels, False)) if ok)
    lines = []
    kept = [(b, label) for b, label, m in zip(blocks, labels, marked) if m]
    for _, group in groupby(kept, key=lambda x: x[0].region):
        run = list(group)
        lines += [b.text for (b, _), ok in zip(run, inherited([label for _, label in run], True)) if ok]
    return "\n".join(lines)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, their main text, and ``n_chars``, its code points."""
    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars")]
    # By number, as any name may be taken.
    given = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col("html").alias("page"))
    fields = [pages.schema[c] for c in kept]
    out = StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())])
    names = out.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, page = batch.columns
            texts = [main_text(p.as_py() or "") for p in page]
            new = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=names)

    return given.mapInArrow(run, out)


def op12_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {"op12_block_rules": (op12_block_rules, None)}
