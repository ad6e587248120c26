"""Tables of a page as Column expressions over its rows and cells.

The reader (``snapledger.functions.html``) gives the tables that are asked for, each as
rows of cells with their raw attributes and pieces of text. Which rows are headings, where
spans put a cell and what its column is called is decided here, inside the page's row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapledger.functions.html import EVERY, FIRST, LAST  # noqa: F401

NAME = "struct<name:string,base:string,nth:int,at:int,width:int>"
CELLS_OF = "array<struct<at:int,width:int,text:string>>"
ROWS = f"array<struct<ix:int,times:int,cells:{CELLS_OF}>>"
TABLES = f"array<struct<width:int,names:array<{NAME}>,head:{ROWS},body:{ROWS}>>"
PLACED = "array<struct<at:int,width:int,text:string,more:int>>"
NAMED = "array<struct<name:string,base:string,nth:bigint,at:int,width:int,step:int>>"

# Fixed value: the most rows that a cell spans in HTML.
MAX_ROWSPAN = 65534

# Largest number that a position can be.
MOST = 2**31 - 1

# White space of any script, and what becomes one blank in a cell.
WHITE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
BREAKS = rf"[\r\n]+|{WHITE}{{2,}}"
# What has to be in a text before either is looked for.
UNEVEN = rf"[\r\n]|{WHITE}{{2}}|^{WHITE}|{WHITE}\z"
# Breaks are single by then, so an edge has two characters at most.
EDGES = rf"^{WHITE}{{1,2}}|{WHITE}{{1,2}}\z"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, and not copied as elements of arrays are."""
    return F.aggregate(none_of("array<int>"), value, lambda known, _: known, use)


def none_of(kind: str) -> Column:
    return F.array().cast(kind)


def pick(values: Column, first: Column, end: Column) -> Column:
    """Elements ``first .. end - 1``, one by one: a slice would read the whole array first."""
    places = F.sequence(first, end - 1)
    return F.when(first < end, F.transform(places, lambda i: F.get(values, i))).when(first >= end, F.array())


def tables_of(page: Column, which: str | None) -> Column:
    """The tables that the reader gave, in document order."""
    if which is None:
        return none_of(TABLES)
    return F.transform(page["grids"], lambda t: _table(page, t))


def _span(value: Column) -> Column:
    """A span as written: its leading digits, 1 where there are none or they are 0."""
    number = F.regexp_extract(value, rf"^{WHITE}*([0-9]+)", 1)
    size = F.greatest(F.least(F.coalesce(number.try_cast("bigint"), F.lit(MOST)), F.lit(MOST)), F.lit(1))
    return F.when(value.isNull() | (number == ""), 1).otherwise(size.cast("int"))


def _cell_text(page: Column, cell: Column) -> Column:
    """All text of a cell, breaks and runs of white space as one blank."""
    first, end = cell["raw_first"], cell["raw_end"]
    text = F.when(end - first == 1, F.get(page["pieces"], first)).otherwise(
        F.array_join(pick(page["pieces"], first, end), "")
    )
    return let(
        text,
        lambda t: F.when(
            t.rlike(UNEVEN), F.regexp_replace(F.regexp_replace(t, BREAKS, " "), EDGES, "")
        ).otherwise(t),
    )


def _table(page: Column, table: Column) -> Column:
    def cells(row):
        return F.transform(
            row["cells"],
            lambda c: F.struct(
                _span(c["colspan"]).alias("width"),
                F.least(_span(c["rowspan"]), F.lit(MAX_ROWSPAN)).alias("depth"),
                _cell_text(page, c).alias("text"),
                c["plain"].alias("plain"),
            ),
        )

    rows = F.transform(table["rows"], lambda r: F.struct(r["part"].alias("part"), cells(r).alias("cells")))

    def part(rows, name):
        return F.filter(rows, lambda r: r["part"] == name)

    def plain(rows):
        """Number of heading rows above the first row with a plain cell."""
        at = F.array_position(
            F.transform(rows, lambda r: F.exists(r["cells"], lambda c: c["plain"])), F.lit(True)
        )
        return F.when(at == 0, F.size(rows)).otherwise(at.cast("int") - 1)

    def split(rows):
        """Without ``thead`` the first rows of headings alone are the head."""

        def by_cells(body):
            return let(
                plain(body),
                lambda n: F.struct(
                    F.slice(body, F.lit(1), n).alias("head"),
                    F.slice(body, n + 1, F.size(body)).alias("body"),
                ),
            )

        given = F.struct(part(rows, "thead").alias("head"), part(rows, "tbody").alias("body"))
        parts = F.when(F.exists(rows, lambda r: r["part"] == "thead"), given).otherwise(
            let(part(rows, "tbody"), by_cells)
        )
        three = let(parts, lambda p: F.array(p["head"], p["body"], part(rows, "tfoot")))
        return let(F.transform(three, _filled), joined)

    def joined(filled):
        """Rows of the foot are numbered on behind the body."""
        head, body, foot = (F.get(filled, i) for i in range(3))
        foot = F.transform(foot, lambda r: r.withField("ix", r["ix"] + _count(body)))
        return F.struct(head.alias("head"), F.concat(body, foot).alias("body"))

    def named(parts):
        widest = F.array_max(F.transform(F.concat(parts["head"], parts["body"]), _end))
        return let(
            F.coalesce(widest, F.lit(0)),
            lambda width: F.struct(
                width.alias("width"),
                _names(parts["head"], parts["body"], width).alias("names"),
                parts["head"].alias("head"),
                parts["body"].alias("body"),
            ),
        )

    return let(let(rows, split), named)


def _count(rows: Column) -> Column:
    return F.aggregate(rows, F.lit(0), lambda n, row: n + row["times"])


def _end(row: Column) -> Column:
    """Where the last cell of a row ends, 0 without cells."""
    last = F.try_element_at(row["cells"], F.lit(-1))
    return F.coalesce(last["at"] + last["width"], F.lit(0))


def text_at(cells: Column, at: Column) -> Column:
    """Text of the cell over column ``at``; without spans it is the cell of that number."""
    over = F.filter(cells, lambda c: (c["at"] <= at) & (at - c["at"] < c["width"]))
    same = F.get(cells, at)
    return F.when(same["at"] == at, same["text"]).otherwise(F.get(over, 0)["text"])


def _place(cells: Column, waiting: Column | None = None) -> Column:
    """Cells of a row side by side, with the ``waiting`` ones that hang into it from above."""

    def put(state, at, cell, more, nth):
        width = F.least(cell["width"], F.lit(MOST) - at)
        placed = F.struct(
            at.alias("at"), width.alias("width"), cell["text"].alias("text"), more.alias("more")
        )
        return F.struct(
            (at + width).alias("at"),
            nth.alias("nth"),
            F.concat(state["out"], F.array(placed)).alias("out"),
        )

    def coming(state):
        return F.slice(waiting, state["nth"] + 1, F.size(waiting))

    def reached(state):
        """What hangs at or before the place of the next cell comes first."""
        return F.aggregate(
            coming(state),
            state,
            lambda s, w: F.when(
                w["at"] <= s["at"], put(s, s["at"], w, w["more"], s["nth"] + 1)
            ).otherwise(s),
        )

    def step(state, cell):
        if waiting is None:
            return put(state, state["at"], cell, cell["depth"], state["nth"])
        return let(reached(state), lambda s: put(s, s["at"], cell, cell["depth"], s["nth"]))

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("nth"), none_of(PLACED).alias("out"))
    done = F.aggregate(cells, start, step)
    if waiting is None:
        return done["out"]
    return let(
        done,
        lambda s: F.aggregate(
            coming(s), s, lambda z, w: put(z, F.greatest(z["at"], w["at"]), w, w["more"], z["nth"])
        ),
    )["out"]


def _bare(placed: Column) -> Column:
    return F.transform(
        placed, lambda c: F.struct(c["at"].alias("at"), c["width"].alias("width"), c["text"].alias("text"))
    )


def _row(ix: Column, times: Column, cells: Column) -> Column:
    return F.struct(ix.alias("ix"), times.alias("times"), _bare(cells).alias("cells"))


def _filled(rows: Column) -> Column:
    """Rows as ``ix``, ``times`` and ``cells`` of ``at``, ``width`` and ``text``.

    A cell also stands in the rows that it hangs into. Column spans stay widths, whatever
    their number, and cells that hang below the last row make rows that are written
    once with the times they repeat, so no text is copied for a large span. Where no cell
    hangs, each row is placed by itself.
    """

    def step(state, row):
        return let(
            _place(row["cells"], state["hanging"]),
            lambda placed: F.struct(
                F.transform(
                    F.filter(placed, lambda c: c["more"] > 1),
                    lambda c: c.withField("more", c["more"] - 1),
                ).alias("hanging"),
                F.concat(
                    state["out"], F.array(_row(F.size(state["out"]), F.lit(1), placed))
                ).alias("out"),
            ),
        )

    def below(state):
        ix = F.size(state["out"])

        def row(levels, more, i):
            before = F.when(i == 0, 0).otherwise(F.get(levels, i - 1))
            left = F.filter(state["hanging"], lambda c: c["more"] >= more)
            return let(before, lambda b: _row(ix + b, more - b, left))

        levels = F.array_sort(F.array_distinct(F.transform(state["hanging"], lambda c: c["more"])))
        return F.concat(
            state["out"], let(levels, lambda ls: F.transform(ls, lambda more, i: row(ls, more, i)))
        )

    def apart(row, ix):
        side_by_side = F.transform(
            row["cells"],
            lambda c, i: F.struct(i.alias("at"), c["width"].alias("width"), c["text"].alias("text")),
        )
        even = F.forall(row["cells"], lambda c: c["width"] == 1)
        cells = F.when(even, side_by_side).otherwise(_bare(_place(row["cells"])))
        return F.struct(ix.alias("ix"), F.lit(1).alias("times"), cells.alias("cells"))

    state = F.struct(none_of(PLACED).alias("hanging"), none_of(ROWS).alias("out"))
    hangs = F.exists(rows, lambda r: F.exists(r["cells"], lambda c: c["depth"] > 1))
    return F.when(hangs, F.aggregate(rows, state, step, below)).otherwise(
        F.transform(rows, apart)
    )


def _names(head: Column, body: Column, width: Column) -> Column:
    """Names of runs of columns: ``(name, base, nth, at, width)``.

    Several heading rows are joined by a blank, no heading row numbers the columns
    from 0, an empty name becomes ``Unnamed: i`` and a repeated one gets ``.n``. A run
    of columns under the same headings is one entry, ``name`` being that of its first;
    ``nth`` columns of the same ``base`` stand before it.
    """
    edges = F.flatten(
        F.transform(
            head,
            lambda r: F.flatten(F.transform(r["cells"], lambda c: F.array(c["at"], c["at"] + c["width"]))),
        )
    )
    short = (F.size(head) == 0) | F.exists(head, lambda r: _end(r) < width)
    cells = F.flatten(F.transform(body, lambda r: F.transform(r["cells"], lambda c: c["at"])))
    cells = F.when(short, cells).otherwise(none_of("array<int>"))
    any_starts = F.array_sort(
        F.array_distinct(F.filter(F.concat(edges, cells, F.array(F.lit(0))), lambda at: at < width))
    )
    # Where every row ends at its number of cells, each column is a run of its own.
    even = F.forall(F.concat(head, body), lambda r: _end(r) == F.size(r["cells"]))
    starts = F.when(even & (width > 0), F.sequence(F.lit(0), width - 1)).otherwise(any_starts)

    def heading(at):
        over = F.transform(head, lambda r: text_at(r["cells"], at))
        return F.array_join(F.array_distinct(F.filter(over, lambda x: x.isNotNull() & (x != ""))), " ")

    def runs(starts):
        return F.transform(
            starts,
            lambda at, i: F.struct(
                at.alias("at"),
                (F.coalesce(F.get(starts, i + 1), width) - at).alias("width"),
                heading(at).alias("base"),
            ),
        )

    def later(label, nth):
        return F.concat(label, F.lit("."), nth.cast("string"))

    def name(out, run):
        blank = run["base"] == ""
        label = F.when(~blank, run["base"]).when(
            F.size(head) > 0, F.concat(F.lit("Unnamed: "), run["at"].cast("string"))
        )

        def free(label, seen):
            """The first number from ``seen`` that no column before is called by."""
            called = F.transform(out, lambda e: e["name"])

            def next_free(names):
                unused = F.get(F.array_except(names, called), 0)
                return seen + F.array_position(names, unused) - 1

            numbers = F.transform(F.sequence(seen, seen + F.size(out)), lambda n: later(label, n))
            taken = F.exists(out, lambda e: e["name"] == later(label, seen))
            return (
                F.when(seen == 0, F.lit(0).cast("bigint"))
                .when(~taken, seen)
                .otherwise(let(numbers, next_free))
            )

        def entry(label, nth):
            return F.struct(
                F.when(nth > 0, later(label, nth)).otherwise(label).alias("name"),
                label.alias("base"),
                nth.alias("nth"),
                run["at"].alias("at"),
                run["width"].alias("width"),
                F.when(blank, 1).otherwise(run["width"]).alias("step"),
            )

        def labelled(label):
            last = F.try_element_at(F.filter(out, lambda e: e["base"] == label), F.lit(-1))
            seen = F.coalesce(let(last, lambda e: e["nth"] + e["step"]), F.lit(0).cast("bigint"))
            nth = let(seen, lambda s: free(label, s))
            return F.concat(out, F.array(let(nth, lambda n: entry(label, n))))

        return let(F.coalesce(label, run["at"].cast("string")), labelled)

    def entries(runs):
        """Names need the ones before only where a heading is repeated or empty."""
        bases = F.transform(runs, lambda run: run["base"])
        apart = let(
            bases,
            lambda b: (F.size(F.array_distinct(b)) == F.size(b)) & ~F.array_contains(b, ""),
        )
        own = F.transform(runs, lambda run: entry_of(run, run["base"]))
        numbered = F.transform(runs, lambda run: entry_of(run, run["at"].cast("string")))
        named = F.aggregate(runs, none_of(NAMED), name)
        any_entries = F.transform(
            named,
            lambda n: F.struct(
                n["name"].alias("name"),
                n["base"].alias("base"),
                F.least(n["nth"], F.lit(MOST)).cast("int").alias("nth"),
                n["at"].alias("at"),
                n["width"].alias("width"),
            ),
        )
        return F.when(F.size(head) == 0, numbered).when(apart, own).otherwise(any_entries)

    def entry_of(run, label):
        return F.struct(
            label.alias("name"),
            label.alias("base"),
            F.lit(0).alias("nth"),
            run["at"].alias("at"),
            run["width"].alias("width"),
        )

    return let(let(starts, runs), entries)
