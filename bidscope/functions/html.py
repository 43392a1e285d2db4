"""HTML as an array of nodes in document order, so that Columns can query it.

Python does the one thing Spark cannot: find the tags. What a page means is decided by Columns
over the nodes, in ``bidscope.operators.pages``.
"""

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidscope.functions.text import collapse, strip

# Elements that never have content.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr"
    " basefont bgsound command frame image isindex nextid spacer".split()
)
# Elements whose text is not page text.
SILENT = frozenset(("script", "style", "template", "rt", "rp"))
# Attributes that are kept.
ATTRIBUTES = ("id", "name", "value", "class", "headers", "href")

# A node: its place, its parent, the last node inside it, and the nearest enclosing table row.
_NUMBERS = ("at", "parent", "last", "row")
_TEXTS = ("tag", *ATTRIBUTES, "text")
_NODES = T.ArrayType(
    T.StructType(
        [T.StructField(name, T.IntegerType()) for name in _NUMBERS]
        + [T.StructField(name, T.StringType()) for name in _TEXTS]
    )
)


# A start or end tag whose meaning does not depend on what follows it.
_PLAIN_START = re.compile(
    r"""<[a-zA-Z][a-zA-Z0-9]*(?:[ \t\r\n]+[a-zA-Z][\w:-]*(?:="[^"<>]*"|='[^'<>]*'|=[\w:.#-]+)?)*[ \t\r\n]*/?>""", re.ASCII
)
_PLAIN_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)[ \t\r\n]*>")
# A script or style without anything like an end tag inside.
_RAW_ELEMENT = re.compile(r"(<(script|style)(?=[ \t\r\n>])[^<>]*>)[^<]*(?:<(?!/)[^<]*)*</\2[ \t\r\n]*>", re.ASCII | re.IGNORECASE)
# Where a page is cut: scripts and styles as a whole, and everything else that looks like a tag.
_PIECES = re.compile(
    r"(<(?:script|style)(?=[ \t\r\n>])[^<>]*>[^<]*(?:<(?!/)[^<]*)*</(?:script|style)[ \t\r\n]*>|<[^<>]*>)",
    re.ASCII | re.IGNORECASE,
)
#: Distinct tags remembered at once.
_REMEMBERED = 1 << 12
#: Pages are read in slices of about this many bytes, so memory does not follow the batch.
SLICE_BYTES = 1 << 21
# What a piece of a page does.
_OPENS, _STANDS, _ENDS, _REMARKS, _NOTHING = range(5)
_NO_ATTRIBUTES = (None,) * len(ATTRIBUTES)


class _Reader(HTMLParser):
    """Collects the nodes of many pages, a list per number and the kind of each node.

    Pages repeat their tags, so a plain tag is taken apart once and then known by its characters. A
    page of plain tags and texts is cut by one pattern; any other is left to the parser.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.starts, self.probe = {}, None
        self.clear()

    def clear(self) -> None:
        """Forget the nodes, and the tags if there were many."""
        self.parents, self.lasts, self.rows, self.nodes, self.contents = [], [], [], [], []
        if not self.starts or len(self.kinds) > _REMEMBERED:
            # Tag and attributes of each kind of node; nodes of the first two kinds have a content.
            self.kinds = {("#text", *_NO_ATTRIBUTES): 0, ("#comment", *_NO_ATTRIBUTES): 1}
            self.starts = {}

    @property
    def texts(self) -> list[tuple]:
        """Tag, attributes and text of each node."""
        kinds, contents = list(self.kinds), iter(self.contents)
        return [(*kinds[n], next(contents) if n < 2 else None) for n in self.nodes]

    def read(self, page: str) -> int:
        """Take in one page; returns how many nodes there are so far."""
        self.first, contents = len(self.nodes), len(self.contents)
        if not self._read_plain(page):
            for found in (self.parents, self.lasts, self.rows, self.nodes):
                del found[self.first :]
            del self.contents[contents:]
            self.reset()
            # Of every open element: its place, its tag, and the table row of what it holds.
            self.open, self.silent = [], 0
            self.feed(page)
            self.close()
            self._close_to(0)
        return len(self.nodes)

    def _read_plain(self, page: str) -> bool:
        """The same nodes as the parser's, or False at the first piece that is not plain."""
        first, silent, parent, row = self.first, 0, -1, -1
        parents, lasts, rows, nodes, contents = self.parents, self.lasts, self.rows, self.nodes, self.contents
        known, at, above = self.starts, 0, []
        tag = None
        pieces = iter(_PIECES.split(page))
        for text in pieces:
            if text and not text.isspace():
                if "<" in text:
                    return False
                if "&" in text:
                    text = unescape(text)
                if not silent and not text.isspace():
                    parents.append(parent)
                    lasts.append(at)
                    rows.append(row)
                    nodes.append(0)
                    contents.append(text)
                    at += 1
            piece = next(pieces, None)
            if piece is None:
                break
            does = known.get(piece)
            if does is None:
                does = self._learnt(piece)
                if does is None:
                    return False
            action, value, kind = does
            if action == _ENDS:
                if value != tag:
                    depth = len(above) - 1
                    while depth >= 0 and above[depth][1] != value:
                        depth -= 1
                    if depth < 0:  # an end tag without a start is ignored
                        continue
                    # An element further out: those inside it are closed with it.
                    while len(above) > depth:
                        lasts[first + parent] = at - 1
                        silent -= tag in SILENT
                        parent, tag, row = above.pop()
                lasts[first + parent] = at - 1
                silent -= tag in SILENT
                parent, tag, row = above.pop()
            elif action == _NOTHING:
                pass
            else:
                parents.append(parent)
                lasts.append(at)
                rows.append(row)
                nodes.append(kind)
                if action == _OPENS:
                    above.append((parent, tag, row))
                    parent, tag = at, value
                    if value == "tr":
                        row = at
                    silent += value in SILENT
                elif action == _REMARKS:
                    contents.append(value)
                at += 1
        while above:
            lasts[first + parent] = at - 1
            parent, tag, row = above.pop()
        return True

    def _learnt(self, piece: str) -> tuple | None:
        """What a piece of a page does, its tag or text, and its kind; None where that is not plain."""
        if piece.startswith("<!--"):
            # Not remembered: remarks need not repeat.
            return (_REMARKS, piece[4:-3], 1) if len(piece) > 6 and piece.endswith("-->") else None
        if piece[:9].lower() == "<!doctype":
            return _NOTHING, None, None
        if len(self.starts) >= _REMEMBERED:
            self.starts.clear()
        end = _PLAIN_END.fullmatch(piece)
        if end is not None:
            does = self.starts[piece] = _ENDS, end[1].lower(), None
            return does
        raw = _RAW_ELEMENT.fullmatch(piece)
        start = raw[1] if raw is not None else piece
        if not _PLAIN_START.fullmatch(start):
            return None
        if self.probe is None:
            self.probe = _Reader()
        probe = self.probe
        probe.clear()
        probe.first, probe.open, probe.silent = 0, [], 0
        probe.reset()
        probe.feed(start)
        if (probe.cdata_elem is None) != (raw is None) or len(probe.nodes) != 1:
            return None
        kind = list(probe.kinds)[probe.nodes[0]]
        # A script's text is no page text, so the whole of it stands for one node.
        does = _OPENS if probe.open and raw is None else _STANDS, kind[0], self._kind(kind)
        if raw is None:
            self.starts[piece] = does
        return does

    def _kind(self, kind: tuple) -> int:
        return self.kinds.setdefault(kind, len(self.kinds))

    def _add(self, kind: tuple, text: str | None = None) -> tuple:
        """A node inside the innermost open element; its place and its table row."""
        at = len(self.nodes) - self.first
        parent, _, row = self.open[-1] if self.open else (-1, None, -1)
        self.parents.append(parent)
        self.lasts.append(at)
        self.rows.append(row)
        self.nodes.append(self._kind(kind))
        if text is not None:
            self.contents.append(text)
        return at, row

    def _close_to(self, depth: int) -> None:
        last = len(self.nodes) - self.first - 1
        for at, tag, _ in self.open[depth:]:
            self.lasts[self.first + at] = last
            self.silent -= tag in SILENT
        del self.open[depth:]

    def handle_starttag(self, tag, attrs, closed=False):
        # Of a repeated attribute the last one counts; one without a value is empty.
        kept = {name: value or "" for name, value in attrs}
        at, row = self._add((tag, *[kept.get(name) for name in ATTRIBUTES]))
        if tag not in VOID:
            self.open.append((at, tag, at if tag == "tr" else row))
            self.silent += tag in SILENT
            if closed:
                self._close_to(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, closed=True)

    def handle_endtag(self, tag):
        # Closes everything opened inside; an end tag without a start is ignored.
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][1] == tag:
                self._close_to(depth)
                return

    def handle_data(self, data):
        if not self.silent and not data.isspace():  # blank text never counts
            self._add(("#text", *_NO_ATTRIBUTES), data)

    def handle_comment(self, data):
        self._add(("#comment", *_NO_ATTRIBUTES), data)


def _read_pages(pages: list[str | None], reader: _Reader | None = None) -> pa.Array:
    reader, offsets = reader or _Reader(), [0]
    reader.clear()
    for page in pages:
        offsets.append(reader.read(page) if page else offsets[-1])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], np.diff(offsets))
    numbers = [pa.array(values, pa.int32()) for values in (at, reader.parents, reader.lasts, reader.rows)]
    kinds = np.array(reader.nodes, np.int32)
    columns = [pa.array(values, pa.string()).take(pa.array(kinds)) for values in zip(*reader.kinds)]
    has_text = kinds < 2
    columns.append(pa.array(reader.contents, pa.string()).take(pa.array(np.cumsum(has_text) - 1, mask=~has_text)))
    nodes = pa.StructArray.from_arrays([*numbers, *columns], [*_NUMBERS, *_TEXTS])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), nodes)


def _slices(pages: pa.Array) -> Iterator[pa.Array]:
    """The pages in runs of about ``SLICE_BYTES``, one page at least."""
    sizes = pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False)
    ends = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES)) + 1
    for start, end in pairwise([0, *ends.tolist(), len(pages)]):
        yield pages.slice(start, end - start)


def html_nodes(html: Column) -> Column:
    """The nodes of each page, in document order; none for an empty page."""

    @F.arrow_udf(_NODES)
    def read(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = _Reader()
        for batch in pages:
            for some in _slices(batch):
                yield _read_pages(some.to_pylist(), reader)

    return read(html)


# A run of nodes is a slice of a page, so it knows the position ("at") of its first node.


def subtree(nodes: Column, node: Column) -> Column:
    """The node itself, then everything inside it."""
    return F.slice(nodes, node["at"] - F.get(nodes, F.lit(0))["at"] + 1, node["last"] - node["at"] + 1)


def inside(nodes: Column, node: Column) -> Column:
    """Everything inside the node."""
    return F.slice(nodes, node["at"] - F.get(nodes, F.lit(0))["at"] + 2, node["last"] - node["at"])


def first(nodes: Column, test) -> Column:
    return F.get(F.filter(nodes, test), F.lit(0))


def has_token(value: Column, token: str) -> Column:
    """Whether a space-separated attribute has the token."""
    return value.rlike(rf"(?:^|\s){re.escape(token)}(?:\s|$)")


def strings(nodes: Column) -> Column:
    """The stripped texts of a run of nodes, empty ones left out."""
    texts = F.transform(F.filter(nodes, lambda n: n["tag"] == "#text"), lambda n: strip(n["text"]))
    return F.filter(texts, lambda text: text != "")


def joined_text(nodes: Column, node: Column) -> Column:
    """Text of a node: stripped pieces joined without separator, white space collapsed."""
    return collapse(F.array_join(strings(inside(nodes, node)), ""))


def clean_text(nodes: Column, node: Column) -> Column:
    """Text of a node; null when there is none."""
    return F.nullif(joined_text(nodes, node), F.lit(""))
