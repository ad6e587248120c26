"""The one Python step: markup of a page to flat, nested-set numbered elements.

``parse_page`` runs as an Arrow UDF over batches of pages. It only turns markup into
elements and pieces of text; which links, headings and sections count is decided
afterwards by Column expressions (``snapledger.operators.pages``), and so is what the
rows and cells of a table mean (``snapledger.functions.grids``).

An element has its own number ``ix`` and the number ``last`` of its last descendant,
so the descendants of ``e`` are exactly the slice ``e.ix + 1 .. e.last``. Rows and cells
have the number of their ``table``, rows the section (``part``) they stand in. Tables that
are asked for are given apart, their rows and cells nested, so that nobody looks for them
among all elements.

Tokens are found by one pattern: the event parser of the standard library looks through
the rest of the page again for each tag that does not end, which takes a broken page of
some hundred kilobytes minutes, and drops what follows an open script.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections import defaultdict
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

ELEMENT = (
    "struct<ix:int,last:int,tag:string,href:string,cls:string,colspan:string,rowspan:string,"
    "nth:int,first:int,end:int,raw_first:int,raw_end:int,table:int,part:string>"
)
# A table as its rows, a row as its cells; the text of a cell is pieces[raw_first:raw_end].
CELL = "struct<colspan:string,rowspan:string,plain:boolean,raw_first:int,raw_end:int>"
GRID = f"struct<rows:array<struct<part:string,cells:array<{CELL}>>>>"
PAGE = (
    "struct<error:string,texts:array<string>,pieces:array<string>,"
    f"elements:array<{ELEMENT}>,grids:array<{GRID}>>"
)

INTS, TEXTS = pa.int32(), pa.string()
ELEMENT_FIELDS = {
    "ix": INTS, "last": INTS, "tag": TEXTS, "href": TEXTS, "cls": TEXTS, "colspan": TEXTS,
    "rowspan": TEXTS, "nth": INTS, "first": INTS, "end": INTS, "raw_first": INTS, "raw_end": INTS,
    "table": INTS, "part": TEXTS,
}
CELL_FIELDS = {
    "colspan": TEXTS, "rowspan": TEXTS, "plain": pa.bool_(), "raw_first": INTS, "raw_end": INTS,
}

# Which tables of a page are read.
FIRST, LAST, EVERY = "first", "last", "every"

# Elements that are kept, and those whose text is collected.
CONTAINERS = frozenset(["div", "table", "thead", "tbody", "tfoot", "tr"])
TEXT_TAGS = frozenset(["a", "h1", "span", "td", "th"])
KEPT = CONTAINERS | TEXT_TAGS
CELLS = frozenset(["td", "th"])
SECTIONS = frozenset(["thead", "tbody", "tfoot"])
ROW = frozenset(["tr"])
ROW_OR_CELL = ROW | CELLS
TABLE_TAGS = ROW_OR_CELL | SECTIONS | {"table"}
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

# Elements without content, which are never open.
VOID = frozenset(
    ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param"]
    + ["source", "track", "wbr"]
)

# Block elements, whose start ends an open paragraph.
BLOCKS = HEADINGS | frozenset(
    ["address", "article", "aside", "blockquote", "center", "div", "dl", "fieldset", "footer"]
    + ["form", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"]
)

# Open elements that the end tag of an inline element does not reach past.
WALLS = BLOCKS | CONTAINERS | CELLS | {"li", "dt", "dd"}

# Characters of markup whose elements are held as Python objects at a time.
CHUNK = 4_000_000

# What a start tag closes when it is open, looked for no further than the second set.
ONLY_TABLE = frozenset(["table"])
CELL_OR_TABLE = CELLS | ONLY_TABLE
IMPLIED_END = {
    **dict.fromkeys(BLOCKS, (frozenset(["p"]), CELL_OR_TABLE)),
    **dict.fromkeys(CELLS, (CELLS, ONLY_TABLE)),
    **dict.fromkeys(SECTIONS, (SECTIONS, ONLY_TABLE)),
    **dict.fromkeys(["dt", "dd"], (frozenset(["dt", "dd"]), CELL_OR_TABLE | {"dl"})),
    "a": (frozenset(["a"]), CELL_OR_TABLE),
    "li": (frozenset(["li"]), CELL_OR_TABLE | {"ol", "ul"}),
    "tr": (ROW, ONLY_TABLE),
}
# What an end tag does not reach past: the cell or table it stands in.
END_WITHIN = {
    **dict.fromkeys(BLOCKS | {"li", "dt", "dd"}, CELL_OR_TABLE),
    **dict.fromkeys(CELLS | SECTIONS | ROW, ONLY_TABLE),
    "table": frozenset(),
    "a": CELL_OR_TABLE,
}
# Other elements neither are kept nor end anything, so they are never open.
TRACKED = KEPT | frozenset(IMPLIED_END)
NOTHING: dict = {}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>\"']|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")


def attributes(source):
    """Attribute names to values; the first of a repeated name counts."""
    found = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), entities.unescape(double or single or bare))
    return found


class Element:
    """One kept element while its page is read; its text is ``pieces[first:end]``."""

    __slots__ = ("ix", "last", "tag", "given", "nth", "first", "end", "table", "part")

    def __init__(self, ix, tag, given, first):
        self.ix = self.last = ix
        self.tag = tag
        self.given = given
        self.nth = None
        self.first = self.end = first
        self.table = self.part = None


def read_elements(markup, wanted=KEPT):
    """Elements of ``wanted`` tags and pieces of text, both in document order.

    Text is kept where a wanted element collects it. For each tag the places of its open
    elements are known, so what a tag ends is found without walking the open elements,
    however many they are.
    """
    elements, pieces, seen = [], [], {}
    names, nodes, reading = [], [], 0
    # Below the places of each tag is one that stands before all others.
    places = {tag: [-1] for tag in TRACKED}
    rows, tables = places["tr"], places["table"]
    wanted = KEPT & wanted

    def close(upto):
        nonlocal reading
        last, end = len(elements) - 1, len(pieces)
        while len(names) > upto:
            name, node = names.pop(), nodes.pop()
            places[name].pop()
            if node is not None:
                node.last, node.end = last, end
                if name in TEXT_TAGS:
                    reading -= 1

    def start(tag, source):
        nonlocal reading
        node = None
        if tag in wanted:
            given = attributes(source) if "=" in source else NOTHING
            node = Element(len(elements), tag, given, len(pieces))
            elements.append(node)
            if tag in TEXT_TAGS:
                reading += 1
            if tag == "a":
                href = given.get("href")
                node.nth = seen.get(href, 0)
                seen[href] = node.nth + 1
            elif tag in ROW_OR_CELL and (table := tables[-1]) >= 0:
                section = max(places["thead"][-1], places["tbody"][-1], places["tfoot"][-1])
                node.part = names[section] if section > table else "tbody"
                if nodes[table] is not None:
                    node.table = nodes[table].ix
        places[tag].append(len(names))
        names.append(tag)
        nodes.append(node)

    # Text and the groups of the token after it, in turn; the last text has no token.
    parts = TOKEN.split(markup)
    for piece, ending, tag, source in zip(parts[::5], parts[2::5], parts[3::5], parts[4::5]):
        if reading and piece:
            pieces.append(entities.unescape(piece) if "&" in piece else piece)
        if tag is None:
            continue
        if tag not in places:
            tag = tag.lower()
            if tag not in places:
                continue
        if ending:
            at = places[tag][-1]
            if at >= 0 and (at == len(names) - 1 or not hidden(at, tag, names, places)):
                close(at)
            continue
        if tag in IMPLIED_END:
            tags, within = IMPLIED_END[tag]
            at = -1
            for other in tags:
                if places[other][-1] > at:
                    at = places[other][-1]
            if at >= 0 and not any(places[other][-1] > at for other in within):
                close(at)
            if names:
                if tag in HEADINGS and names[-1] in HEADINGS:
                    close(len(names) - 1)
                elif tag in CELLS and names[-1] != "tr" and rows[-1] <= tables[-1]:
                    start("tr", "")
        start(tag, source)
    if reading:
        pieces.append(entities.unescape(parts[-1]))
    close(0)
    return elements, pieces


def hidden(at, tag, names, places):
    """Above the open element ``at`` is one that the end tag of ``tag`` does not reach past."""
    within = END_WITHIN.get(tag)
    if within is not None:
        return any(places[other][-1] > at for other in within)
    # Links do not nest, so a wall is the next one or the one after.
    return any(names[i] in WALLS for i in range(at + 1, len(names)))


def page_texts(pieces):
    """Pieces of text that are not blank, and how many there are before each piece."""
    texts, before = [], []
    for piece in pieces:
        before.append(len(texts))
        if bare := piece.strip():
            texts.append(bare)
    return texts, [*before, len(texts)]


def write_elements(out, elements, before, tags):
    """Add elements of ``tags`` to the output, numbered anew with the same nesting.

    The text of an element is a slice of the page's texts, and one of its pieces, so text
    is never copied however deep elements nest.
    """
    upto, kept = [], []
    for element in elements:
        if element.tag in tags:
            kept.append(element)
        upto.append(len(kept))
    for ix, element in enumerate(kept):
        given, table, span = element.given, element.table, (0, 0, 0, 0)
        if element.tag in TEXT_TAGS:
            span = (before[element.first], before[element.end], element.first, element.end)
        names = given.get("class")
        out.extend(
            (
                ix,
                upto[element.last] - 1,
                element.tag,
                given.get("href"),
                None if names is None else " ".join(names.split()),
                given.get("colspan"),
                given.get("rowspan"),
                element.nth,
                *span,
                upto[table] - 1 if table is not None and elements[table].tag in tags else None,
                element.part,
            )
        )


def wanted_tables(elements, before, which):
    """Rows of the tables with any text, in document order: ``(row, its cells)`` of each.

    A cell always stands in the row of its table that was started last.
    """
    tables, full = {}, set()
    for element in elements:
        table = element.table
        if table is None:
            continue
        if element.tag == "tr":
            tables.setdefault(table, []).append((element, []))
        else:
            tables[table][-1][1].append(element)
            if before[element.first] < before[element.end]:
                full.add(table)
    found = sorted(full)
    if which in (FIRST, LAST):
        found = found[:1] if which == FIRST else found[-1:]
    return [tables[table] for table in found]


class Pages:
    """Output of several pages as flat lists of values, with list lengths."""

    def __init__(self):
        self.errors, self.texts, self.pieces = [], [], []
        self.counts = {"texts": [], "pieces": [], "elements": [], "grids": [], "rows": [], "cells": []}
        self.elements, self.parts, self.cells = [], [], []

    def add(self, markup, tags, tables):
        """One page, with its ``tables`` if any are asked for. What goes wrong stays with it."""
        error, texts, pieces, elements, grids = None, [], [], [], []
        if not markup or markup.isspace():
            error = "empty page"
        else:
            try:
                wanted = tags | TABLE_TAGS if tables else tags
                elements, found = read_elements(markup, wanted)
                texts, before = page_texts(found)
                if tables:
                    grids = wanted_tables(elements, before, tables)
                    pieces = found if grids else []
            except Exception as problem:
                error, texts, elements = f"{type(problem).__name__}: {problem}", [], []
        size = len(self.elements)
        if elements and tags:
            write_elements(self.elements, elements, before, tags)
        if not tags & TEXT_TAGS:
            texts = []
        self.errors.append(error)
        self.texts += texts
        self.pieces += pieces
        self.counts["texts"].append(len(texts))
        self.counts["pieces"].append(len(pieces))
        self.counts["elements"].append((len(self.elements) - size) // len(ELEMENT_FIELDS))
        self.counts["grids"].append(len(grids))
        for rows in grids:
            self.add_table(rows)

    def add_table(self, rows):
        self.counts["rows"].append(len(rows))
        for row, cells in rows:
            self.parts.append(row.part)
            self.counts["cells"].append(len(cells))
            for cell in cells:
                given = cell.given
                self.cells.extend(
                    (given.get("colspan"), given.get("rowspan"), cell.tag == "td", cell.first, cell.end)
                )

    def array(self):
        elements = struct(by_field(self.elements, ELEMENT_FIELDS))
        cells = struct(by_field(self.cells, CELL_FIELDS))
        rows = {"part": pa.array(self.parts, TEXTS), "cells": lists(cells, self.counts["cells"])}
        grids = struct({"rows": lists(struct(rows), self.counts["rows"])})
        return struct(
            {
                "error": pa.array(self.errors, TEXTS),
                "texts": lists(pa.array(self.texts, TEXTS), self.counts["texts"]),
                "pieces": lists(pa.array(self.pieces, TEXTS), self.counts["pieces"]),
                "elements": lists(elements, self.counts["elements"]),
                "grids": lists(grids, self.counts["grids"]),
            }
        )


def by_field(values, fields):
    """Arrays of the fields whose values stand in turn."""
    return {n: pa.array(values[i :: len(fields)], k) for i, (n, k) in enumerate(fields.items())}


def struct(columns):
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def lists(values, lengths):
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(lengths)], INTS), values)


def page_reader(tags, tables):
    """Arrow UDF from markup to a ``PAGE`` struct with the elements of ``tags`` only.

    ``tables`` says which tables it has as well, with all raw pieces of text; none if it is
    ``None``. It is declared nondeterministic so that no filter on its result is pushed below it,
    which would parse every page twice.
    """
    tags = frozenset(tags)

    @F.arrow_udf(PAGE)
    def parse_page(markup: pa.Array) -> pa.Array:
        # Python objects take far more memory than Arrow arrays, so a batch is
        # converted in pieces of about CHUNK characters.
        done, pages, size = [], Pages(), 0
        for page in markup.cast(pa.binary()):
            text = page.as_py()
            # Bytes that are no UTF-8 must not fail the other pages of the batch.
            text = None if text is None else text.decode("utf-8", "replace")
            pages.add(text, tags, tables)
            size += len(text or "")
            if size >= CHUNK:
                done.append(pages.array())
                pages, size = Pages(), 0
        return pa.concat_arrays([*done, pages.array()])

    return parse_page.asNondeterministic()


# Pickled by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
