"""Page extraction: a table of pages in, rows out.

``parse`` runs the markup reader once per page and adds the column ``page``.
Everything after it is Column expressions on that nested column. What belongs to one
page stays in its row, so none of these operators shuffles.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions import grids, html, text

# Cell texts that count as missing in a page table.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# First cells that mark a heading or total row of a grouped table.
SUMMARY_MARKETS = ["market", "total", "summary"]

# Label fragment and field of a label/value section, first match counts.
RELEASE_LABELS = [
    ("distributor", "distributor"),
    ("opening", "opening"),
    ("release date", "release_date"),
    ("mpaa", "rating"),
    ("running time", "runtime"),
    ("genres", "genres"),
    ("widest release", "widest_release"),
]
RELEASE_NOTE = "See full company information"


def parse(
    pages: DataFrame, html_col: str = "html", tags=html.KEPT, tables: str | None = grids.EVERY
) -> DataFrame:
    """Replace the markup by the parsed ``page``.

    ``tags`` and ``tables`` say what is needed, so that nothing else is copied out of
    the Python worker. Pages that cannot be parsed keep their row with ``page.error``.
    """
    others = [c for c in pages.columns if c != html_col]
    read = html.page_reader(tags, tables)(F.col(html_col)).alias("page")
    found = grids.tables_of(F.col("page"), tables)
    page = F.col("page").dropFields("pieces", "grids").withField("tables", found)
    # An array of one is exploded so that tables are built once, whatever uses them.
    return pages.select(*others, read).select(*others, F.explode(F.array(page)).alias("page"))


def parse_failures(parsed: DataFrame, dataset: str, item: Column) -> DataFrame:
    """``(dataset, item, error)`` of the pages that could not be parsed."""
    return parsed.where(F.col("page.error").isNotNull()).select(
        F.lit(dataset).alias("dataset"),
        item.cast("string").alias("item"),
        F.col("page.error").alias("error"),
    )


def _has_class(element: Column, wanted: str) -> Column:
    """The class list is, or has, ``wanted``."""
    return (element["cls"] == wanted) | F.array_contains(F.split(element["cls"], " "), wanted)


def _elements(tag: str, wanted: str | None = None) -> Column:
    return F.filter(
        "page.elements",
        lambda e: (e["tag"] == tag) & (_has_class(e, wanted) if wanted else F.lit(True)),
    )


def _inside(element: Column) -> Column:
    """Descendants of ``element``: those numbered after it, up to its last."""
    return grids.pick(F.col("page.elements"), element["ix"] + 1, element["last"] + 1)


def _text(element: Column, between: str = "") -> Column:
    """Text of an element: its part of the page's texts."""
    return F.array_join(grids.pick(F.col("page.texts"), element["first"], element["end"]), between)


def _carry(parsed: DataFrame) -> list[str]:
    return [c for c in parsed.columns if c != "page"]


def heading(wanted: str | None = None) -> Column:
    """Text of the first ``h1`` with a class (any class when not given)."""
    return _text(F.get(_elements("h1", wanted), 0))


def links(parsed: DataFrame, prefix: str, base_url: str = "") -> DataFrame:
    """First anchor per target below ``prefix``: ``pos, href, url, text``.

    ``pos`` counts the page's matching anchors in document order. The reader has
    numbered repeated targets within the page, so keeping the first needs no shuffle.
    """
    matching = F.filter("page.elements", lambda e: (e["tag"] == "a") & e["href"].startswith(prefix))
    found = F.transform(
        matching,
        lambda a: F.struct(
            a["href"].alias("href"), a["nth"].alias("nth"), _text(a, " ").alias("text")
        ),
    )
    return (
        parsed.select(*_carry(parsed), F.posexplode(found).alias("pos", "a"))
        .where(F.col("a.nth") == 0)
        .select(
            *_carry(parsed),
            "pos",
            F.col("a.href").alias("href"),
            text.absolute_url(base_url, F.col("a.href")).alias("url"),
            text.blank_to_null(F.col("a.text")).alias("text"),
        )
    )


def labelled_link(prefix: str, label: str, base_url: str = "") -> Column:
    """URL of the first anchor that reads ``label``, else of the first starting with it."""
    matching = F.filter("page.elements", lambda e: (e["tag"] == "a") & e["href"].startswith(prefix))
    exact = F.filter(matching, lambda a: _text(a) == label)
    loose = F.filter(matching, lambda a: _text(a, " ").startswith(label))
    best = F.coalesce(F.get(exact, 0), F.get(loose, 0))
    return text.absolute_url(base_url, best["href"])


def table_rows(parsed: DataFrame) -> DataFrame:
    """All tables to ``table_ix, row_ix, cells``; heading rows come first.

    Here, and only here, a cell is repeated over all columns that it spans.
    """
    carry = _carry(parsed)
    tables = parsed.select(*carry, F.posexplode("page.tables").alias("table_ix", "t"))
    parts = F.array(F.struct(F.lit(0).alias("above"), F.col("t.head").alias("rows")),
                    F.struct(_count("t.head").alias("above"), F.col("t.body").alias("rows")))
    rows = (
        tables.select(*carry, "table_ix", F.col("t.width").alias("_width"), F.explode(parts).alias("_p"))
        .select(*carry, "table_ix", "_width", F.col("_p.above").alias("_above"), F.explode("_p.rows").alias("_r"))
        .select(*carry, "table_ix", "_width", "_above", "_r", F.explode(_repeats("_r")).alias("_nth"))
    )
    filled = F.flatten(F.transform("_r.cells", lambda c: F.array_repeat(c["text"], c["width"])))
    rest = F.array_repeat(F.lit(""), F.col("_width") - F.size(filled))
    row_ix = F.col("_above") + F.col("_r.ix") + F.col("_nth")
    return rows.select(*carry, "table_ix", row_ix.alias("row_ix"), F.concat(filled, rest).alias("cells"))


def _repeats(row: str) -> Column:
    """0, 1, ... for the times that a row stands in its table."""
    return F.sequence(F.lit(0), F.col(f"{row}.times") - 1)


def _count(rows: str) -> Column:
    return F.aggregate(rows, F.lit(0), lambda n, row: n + row["times"])


def first_table() -> Column:
    return F.get("page.tables", 0)


def last_table() -> Column:
    return F.try_element_at("page.tables", F.lit(-1))


def has_columns(table: Column, required: Iterable[str]) -> Column:
    """The table of a page has every required column."""
    return F.size(absent_columns(table, required)) == 0


def absent_columns(table: Column, required: Iterable[str]) -> Column:
    names = F.transform(table["names"], lambda n: n["name"])
    return F.array_except(F.array(*[F.lit(c) for c in sorted(required)]), names)


def _position(table: Column, name: str) -> Column:
    """Where a column stands in the table; ``X.2`` may be inside a run of columns ``X``."""
    exact = F.transform(F.filter(table["names"], lambda n: n["name"] == name), lambda n: n["at"])
    found = F.get(exact, 0)
    repeated = re.fullmatch(r"(?s)(.*)\.(\d+)", name)
    if repeated and int(repeated.group(2)) <= grids.MOST:
        base, nth = repeated.group(1), int(repeated.group(2))
        within = F.filter(
            table["names"],
            lambda n: (n["base"] == base) & (n["nth"] <= nth) & (F.lit(nth) - n["nth"] < n["width"]),
        )
        found = F.coalesce(found, F.get(F.transform(within, lambda n: n["at"] + nth - n["nth"]), 0))
    return found


def _present(value: Column) -> Column:
    return F.when(~value.isin(MISSING_CELLS), value)


def _extras() -> Column:
    """Cells under headings that are not declared, by the name of their first column."""

    def under(heading):
        cells = F.filter(
            "_cells",
            lambda c: (c["at"] < heading["at"] + heading["width"])
            & (heading["at"] < c["at"] + c["width"]),
        )

        def entry(c):
            nth = heading["nth"] + F.greatest(c["at"] - heading["at"], F.lit(0))
            later = F.concat(heading["base"], F.lit("."), nth.cast("string"))
            name = F.when(nth == heading["nth"], heading["name"]).otherwise(later)
            return F.struct(name.alias("key"), _present(c["text"]).alias("value"))

        return F.transform(cells, entry)

    entries = F.filter(F.flatten(F.transform("_others", under)), lambda e: e["value"].isNotNull())
    # A heading that reads like another's repeat is kept once.
    once = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, F.lit(1), i), lambda before: before["key"] == e["key"]),
    )
    return F.map_from_entries(once)


def table_records(parsed: DataFrame, table: Column, columns: Iterable[str]) -> DataFrame:
    """Body rows of one table per page: ``row_ix``, the declared ``columns`` and ``extras``.

    Declared columns that a page lacks are null, and so are missing texts. Whatever else
    the table has goes to the map ``extras``, by name, so that pages never decide the
    schema. The page's own columns always win: a column named like one of them, in any
    case, is only in ``extras``. Where a declared column stands is looked up once per
    page.
    """
    carry = _carry(parsed)
    taken = {c.lower() for c in [*carry, "row_ix", "extras"]}
    declared = [c for c in columns if c.lower() not in taken]
    places = {f"_at{i}": _position(table, name) for i, name in enumerate(declared)}
    others = F.filter(table["names"], lambda n: ~n["name"].isin(declared))

    def value(place):
        return _present(grids.text_at(F.col("_cells"), F.col(place)))

    return (
        parsed.where(F.size(table["body"]) > 0)
        .select(
            *carry,
            *[at.alias(name) for name, at in places.items()],
            others.alias("_others"),
            F.explode(table["body"]).alias("_r"),
        )
        .select(
            *carry,
            *places,
            "_others",
            F.col("_r.cells").alias("_cells"),
            F.col("_r.ix").alias("_ix"),
            F.explode(_repeats("_r")).alias("_nth"),
        )
        .select(
            *carry,
            (F.col("_ix") + F.col("_nth")).alias("row_ix"),
            *[value(place).alias(name) for place, name in zip(places, declared)],
            _extras().alias("extras"),
        )
    )


def sections(wanted: str) -> Column:
    """``array<struct<label, value>>`` from the first two spans of each section."""
    spans = F.transform(
        _elements("div", wanted), lambda d: F.filter(_inside(d), lambda e: e["tag"] == "span")
    )
    return F.transform(
        F.filter(spans, lambda s: F.size(s) >= 2),
        lambda s: F.struct(
            text.label_key(_text(F.get(s, 0))).alias("label"),
            _text(F.get(s, 1), " ").alias("value"),
        ),
    )


def label_value(pairs: Column, field: str, rules=RELEASE_LABELS) -> Column:
    """Value of the last pair whose first matching rule is that of ``field``."""
    fragments = [fragment for fragment, _ in rules]
    at = [name for _, name in rules].index(field)

    def belongs(pair):
        hit = pair["label"].contains(fragments[at])
        for fragment in fragments[:at]:
            hit = hit & ~pair["label"].contains(fragment)
        return hit

    return F.try_element_at(F.filter(pairs, belongs), F.lit(-1))["value"]


def release_metadata(parsed: DataFrame, section_class: str, title_class: str | None) -> DataFrame:
    """One record per page from its label/value sections, also when it has none."""
    carry = _carry(parsed)
    fields = parsed.where(F.col("page.error").isNull()).select(
        *carry, heading(title_class).alias("movie_title"), sections(section_class).alias("pairs")
    )
    value = {name: label_value(F.col("pairs"), name) for _, name in RELEASE_LABELS}
    return fields.select(*carry, "movie_title", *[v.alias(n) for n, v in value.items()]).select(
        *carry,
        "movie_title",
        text.strip_phrase(F.col("distributor"), RELEASE_NOTE).alias("distributor"),
        text.opening_amount(F.col("opening")).alias("opening_amount"),
        text.opening_theaters(F.col("opening")).alias("opening_theaters"),
        "release_date",
        "rating",
        "runtime",
        text.squeeze_space(F.col("genres")).alias("genres"),
        text.first_number(F.col("widest_release")).alias("widest_release"),
    )


def grouped_rows(parsed: DataFrame, table_class: str, title_class: str | None) -> DataFrame:
    """Rows of region tables: ``region, market, release_date, opening, total_gross, movie_title``.

    A table's region is its first heading cell across four columns. Tables without
    one or with the worldwide total are left out, as are heading and total rows.
    """
    carry = _carry(parsed)
    tables = F.transform(
        _elements("table", table_class),
        lambda t: F.struct(
            _text(
                F.get(F.filter(_inside(t), lambda e: (e["tag"] == "th") & (e["colspan"] == "4")), 0)
            ).alias("region"),
            F.slice(F.filter(_inside(t), lambda e: e["tag"] == "tr"), 2, t["last"] + 1).alias("rows"),
        ),
    )
    regional = F.filter(
        tables, lambda t: (t["region"] != "") & (F.lower(t["region"]) != "worldwide")
    )
    rows = F.flatten(
        F.transform(
            regional,
            lambda t: F.transform(
                t["rows"],
                lambda r: F.struct(
                    t["region"].alias("region"),
                    F.transform(
                        F.filter(_inside(r), lambda e: e["tag"].isin("td", "th")),
                        lambda c: F.struct(_text(c).alias("joined"), _text(c, " ").alias("spaced")),
                    ).alias("cells"),
                ),
            ),
        )
    )
    full = F.filter(rows, lambda r: F.size(r["cells"]) >= 3)
    third = text.digits_or_null(F.get("r.cells", 2)["joined"])
    is_wide = F.size("r.cells") >= 4
    market = F.get("r.cells", 0)["spaced"]
    return (
        parsed.select(*carry, heading(title_class).alias("movie_title"), F.explode(full).alias("r"))
        .where((market != "") & ~F.lower(market).isin(SUMMARY_MARKETS))
        .select(
            *carry,
            F.col("r.region").alias("region"),
            market.alias("market"),
            text.text_or_null(F.get("r.cells", 1)["joined"]).alias("release_date"),
            F.when(is_wide, third).alias("opening"),
            F.when(is_wide, text.digits_or_null(F.get("r.cells", 3)["joined"]))
            .otherwise(third)
            .alias("total_gross"),
            "movie_title",
        )
    )
