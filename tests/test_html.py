import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from snapledger.functions import grids, html
from snapledger.operators import pages as page_ops

ALL = html.KEPT


@pytest.fixture
def pages_of(spark):
    """Parsed pages of several markups, in their order."""

    def parsed(markups, tags=(), tables=grids.EVERY):
        frame = spark.createDataFrame(list(enumerate(markups)), "k int, html string")
        rows = page_ops.parse(frame, tags=tags, tables=tables).collect()
        return [r["page"].asDict(recursive=True) for r in sorted(rows, key=lambda r: r["k"])]

    return parsed


def even(table):
    """Names and rows of a table with every span written out."""

    def rows(part):
        cells = [row["cells"] for row in table[part] for _ in range(row["times"])]
        filled = [[c["text"] for c in row for _ in range(c["width"])] for row in cells]
        return [row + [""] * (table["width"] - len(row)) for row in filled]

    names = [
        f"{n['base']}.{n['nth'] + i}" if n["nth"] + i and i else n["name"]
        for n in table["names"]
        for i in range(n["width"])
    ]
    return names, rows("head"), rows("body")


@pytest.fixture
def grid(pages_of):
    def first(markup):
        names, _, body = even(pages_of([markup])[0]["tables"][0])
        return names, body

    return first


def raw(markup, tags=ALL, tables=False):
    pages = html.Pages()
    pages.add(markup, frozenset(tags), tables)
    return pages.array().to_pylist()[0]


def read(markup, tags=ALL):
    page = raw(markup, tags)
    for element in page["elements"]:
        element["strings"] = page["texts"][element["first"] : element["end"]]
    return page


def elements(markup, *tags):
    return read(markup, tags)["elements"]


def test_text_pieces_and_entities():
    (heading,) = elements("<h1 class=' x  y '> Tom &amp; <b>Jerry</b>&nbsp;</h1>", "h1")
    assert heading["strings"] == ["Tom &", "Jerry"]
    assert heading["cls"] == "x y"


def test_comments_scripts_and_styles_are_no_content():
    markup = "<!-- <a href='/c'>c</a> --><script>var a='<a href=\"/s\">';</script><style>a{}</style><a href=/x>x</a>"
    assert [e["href"] for e in elements(markup, "a")] == ["/x"]


def test_attribute_quoting_and_case():
    markup = "<A HREF='/a>b' href=/second>1</A><a data-href='/no' href = \"/c?x=1&amp;y=2\">2</a>"
    assert [e["href"] for e in elements(markup, "a")] == ["/a>b", "/c?x=1&y=2"]


def test_repeated_targets_are_numbered():
    assert [e["nth"] for e in elements("<a href=/x>1</a><a href=/y>2</a><a href=/x>3</a>", "a")] == [0, 0, 1]


def test_unclosed_anchor_ends_at_the_next():
    assert [e["strings"] for e in elements("<a href=/x>one<a href=/y>two", "a")] == [["one"], ["two"]]


def test_end_of_a_block_ends_what_it_left_open():
    spans = elements("<ul><li><span>a<li><span>b</ul><p><span>c<p>d<div><span>e</div>f", "span")
    assert [e["strings"] for e in spans] == [["a"], ["b"], ["c"], ["e"]]


def test_stray_end_tags_close_nothing_outer():
    (span,) = elements("<span>a<div>b</span>c</div>d</span>e", "span")
    assert span["strings"] == ["a", "b", "c", "d"]
    assert elements("<h1>a</td></table></div> b</h1>", "h1")[0]["strings"] == ["a", "b"]


def test_heading_ends_at_the_next_heading():
    assert elements("<h1>a<h2>b</h2>", "h1")[0]["strings"] == ["a"]


def test_void_elements_are_never_open():
    (anchor,) = elements("<a href=/x>a<br>b<img src=y>c</a>d", "a")
    assert anchor["strings"] == ["a", "b", "c"]


def test_nested_elements_keep_their_own_text():
    spans = elements("<span>a<span></span>b<span>c</span>d</span>", "span")
    assert [e["strings"] for e in spans] == [["a", "b", "c", "d"], [], ["c"]]
    assert [(e["ix"], e["last"]) for e in spans] == [(0, 2), (1, 1), (2, 2)]


def test_implied_ends_in_tables(grid):
    names, body = grid("<table><tr><th>A<th>B<tr><td>1<td>2<tr><td>3<td>4</table>")
    assert (names, body) == (["A", "B"], [["1", "2"], ["3", "4"]])


def test_cells_without_row(grid):
    assert grid("<table><td>1<td>2</table>") == (["0", "1"], [["1", "2"]])


def test_heading_from_thead_and_footer_last(grid):
    markup = (
        "<table><tfoot><tr><td>sum</td></tr></tfoot><thead><tr><td>Name</td></tr></thead>"
        "<tbody><tr><th>a</th></tr></tbody></table>"
    )
    assert grid(markup) == (["Name"], [["a"], ["sum"]])


def test_row_and_column_spans(grid):
    markup = (
        "<table><tr><th rowspan=2>A<th colspan=2>B<tr><th>b1<th>b2"
        "<tr><td>1<td rowspan=3>2<td>3<tr><td>x<td>y</table>"
    )
    assert grid(markup) == (["A", "B b1", "B b2"], [["1", "2", "3"], ["x", "2", "y"], ["2", "", ""]])


def test_column_names(grid):
    assert grid("<table><tr><th>x<th><th>x<tr><td>1</table>") == (["x", "Unnamed: 1", "x.1"], [["1", "", ""]])


def test_cell_text_is_squeezed(grid):
    assert grid("<table><tr><td> a\n\n b  c<br>d</table>")[1] == [["a  b cd"]]
    assert grid("<table><tr><td> a\r\nb   c</td></tr></table>")[1] == [["a b c"]]


def test_nested_and_empty_tables(pages_of):
    markup = "<table></table><table><tr><td>o<table><tr><td>i</td></tr></table></td></tr></table>"
    every, first, last = (pages_of([markup], (), which)[0]["tables"] for which in ("every", "first", "last"))
    assert [even(t)[2] for t in every] == [[["oi"]], [["i"]]]
    assert (first, last) == (every[:1], every[1:])


def test_large_spans_are_kept_as_numbers(pages_of):
    markup = "<table>" + "<tr><td rowspan=65534 colspan=2000000000>x</td></tr>" * 2 + "</table>"
    beyond = "<table><tr><td colspan=99999999999>x<td colspan=2>y<tr><td rowspan=0>z</table>"
    page, other = pages_of([markup, beyond])
    assert page["error"] is None
    (table,) = page["tables"]
    assert sum(row["times"] for row in table["body"]) == 65535
    assert len(table["body"]) <= 4
    assert [c["width"] for c in other["tables"][0]["body"][0]["cells"]] == [grids.MOST, 0]
    assert other["tables"][0]["body"][1]["cells"][0]["text"] == "z"


def test_many_rows_and_columns(pages_of):
    tall = "<table>" + "".join(f"<tr><td>{i}<td rowspan={i % 3}>x" for i in range(3000)) + "</table>"
    wide = "<table><tr>" + "<th>a" * 400 + "<tr>" + "<td>1" * 400 + "</table>"
    first, second = (even(page["tables"][0]) for page in pages_of([tall, wide]))
    assert [row[0] for row in first[2][:3]] == ["0", "1", "2"] and len(first[2]) >= 3000
    assert second[0] == ["a", *[f"a.{i}" for i in range(1, 400)]] and second[2] == [["1"] * 400]


def placed(rows):
    """Cells of rows by hand: ``(at, width, text)``, every row written out."""
    rows, hanging, done = list(rows), [], []
    while rows or hanging:
        row, at, after = [], 0, []
        for cell in [*(rows.pop(0) if rows else []), None]:
            while hanging and (cell is None or hanging[0][0] <= at):
                start, *up = hanging.pop(0)
                at = max(at, start)
                row.append((at, *up))
                at += up[0]
            if cell is not None:
                row.append((at, *cell))
                at += cell[0]
        done.append([(at, width, text) for at, width, text, _ in row])
        hanging = [(at, width, text, more - 1) for at, width, text, more in row if more > 1]
    return done


def test_spans_equal_those_placed_by_hand(pages_of):
    draw = random.Random(5)
    tables = [
        [
            [(draw.choice([1, 1, 2, 4]), f"{r}.{c}", draw.choice([1, 1, 1, 2, 5])) for c in range(draw.randint(0, 5))]
            for r in range(draw.randint(1, 7))
        ]
        for _ in range(300)
    ]
    tables = [rows for rows in tables if any(rows)]
    markups = [
        "<table>"
        + "".join(
            "<tr>" + "".join(f"<td colspan={w} rowspan={d}>{text}" for w, text, d in row) for row in rows
        )
        + "</table>"
        for rows in tables
    ]
    for rows, page in zip(tables, pages_of(markups)):
        (table,) = page["tables"]
        # Rows without a cell above the first plain one are heading rows.
        above = next(i for i, row in enumerate(rows) if row)
        body = [[(c["at"], c["width"], c["text"]) for c in r["cells"]] for r in table["body"] for _ in range(r["times"])]
        assert body == placed(rows[above:])
        assert table["width"] == max(at + width for row in body for at, width, _ in row)
        assert sum(n["width"] for n in table["names"]) == table["width"]


def test_depth_and_repetition_have_no_limit(pages_of):
    page = raw("<span>" * 5000 + "x")
    assert page["error"] is None and len(page["elements"]) == 5000
    assert page["texts"] == ["x"] and page["elements"][0]["end"] == 1
    row = "<tr><td>1</td></tr>"
    (deep,) = pages_of(["<b><i><div>" * 4000 + f"<table>{row}</table>" + "<b>" * 3000])
    assert deep["error"] is None and deep["tables"][0]["body"][0]["cells"][0]["text"] == "1"


def test_deep_pages_take_linear_time():
    def seconds(n):
        markup = "<div><a href=/x>y<li>z</a>" * n
        start = time.perf_counter()
        raw(markup)
        return time.perf_counter() - start

    seconds(500)
    assert seconds(16_000) < 16 * max(seconds(4_000), 0.02)


def test_unclosed_markup_takes_linear_time():
    for markup in ("<a " * 50000, '<a href="' * 50000, "<script " * 50000, "<!-- " * 50000):
        assert read(markup)["error"] is None


FRAGMENTS = st.lists(
    st.sampled_from(
        [f"<{t}>" for t in sorted(ALL)]
        + [f"</{t}>" for t in sorted(ALL)]
        + ["<p>", "</b>", "text", " ", "&amp;", "&", "<", ">", "<a href='/x'>", "<td colspan=2>"]
        + ["<td rowspan=2>", "<!--", "-->", "<script>", "</script>", '"', "'", "é "]
    ),
    max_size=40,
)


@settings(max_examples=400, deadline=None)
@given(FRAGMENTS)
def test_any_markup_gives_nested_elements(fragments):
    page = raw("".join(fragments) + ".", ALL, True)
    assert page.get("error") is None
    rows = page["elements"]
    for at, element in enumerate(rows):
        assert element["ix"] == at <= element["last"] < len(rows)
        for inside in rows[at + 1 : element["last"] + 1]:
            assert inside["last"] <= element["last"]
        if element["table"] is not None:
            around = rows[element["table"]]
            assert around["tag"] == "table" and around["ix"] < at <= around["last"]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(FRAGMENTS, min_size=60, max_size=120))
def test_any_markup_gives_even_tables(pages_of, pages):
    for page in pages_of(["".join(fragments) + "." for fragments in pages]):
        assert page["error"] is None
        for table in page["tables"]:
            names, head, body = even(table)
            assert {len(row) for row in head + body} == {len(names)}


@settings(max_examples=200, deadline=None)
@given(FRAGMENTS, st.sets(st.sampled_from(sorted(ALL))))
def test_reading_fewer_tags_gives_the_same_elements(fragments, tags):
    markup = "".join(fragments) + "."
    full = [(e["tag"], e["href"], e["nth"]) for e in read(markup)["elements"] if e["tag"] in tags]
    assert [(e["tag"], e["href"], e["nth"]) for e in read(markup, tags)["elements"]] == full


def test_tables_are_nested_and_leave_no_elements():
    markup = "<a href=/x>l</a><table><tr><td> </table><table><tr><th>A<td colspan=2>b</table><table><td>c</table>"
    first, last, none = (raw(markup, ("a",), which) for which in (grids.FIRST, grids.LAST, None))
    assert [[e["tag"] for e in page["elements"]] for page in (first, last, none)] == [["a"]] * 3
    assert [len(page["grids"]) for page in (first, last, none)] == [1, 1, 0]
    ((row,),) = [grid["rows"] for grid in first["grids"]]
    assert [(c["colspan"], c["plain"]) for c in row["cells"]] == [(None, False), ("2", True)]
    assert ["".join(first["pieces"][c["raw_first"] : c["raw_end"]]) for c in row["cells"]] == ["A", "b"]


@settings(max_examples=300, deadline=None)
@given(FRAGMENTS)
def test_nested_tables_equal_those_of_the_elements(fragments):
    markup = "".join(fragments) + "."
    page = raw(markup, ALL, grids.EVERY)
    assert page["error"] is None or markup.isspace()
    every = page["elements"]

    def cells(table, around):
        inside = every[around["ix"] + 1 : around["last"] + 1]
        return [e for e in inside if e["tag"] in ("td", "th") and e["table"] == table["ix"]]

    def rows(table):
        inside = every[table["ix"] + 1 : table["last"] + 1]
        return [e for e in inside if e["tag"] == "tr" and e["table"] == table["ix"]]

    expected = [
        [(r["part"], [(c["tag"] == "td", c["raw_first"], c["raw_end"]) for c in cells(t, r)]) for r in rows(t)]
        for t in every
        if t["tag"] == "table" and any(c["first"] < c["end"] for c in cells(t, t))
    ]
    found = [
        [(r["part"], [(c["plain"], c["raw_first"], c["raw_end"]) for c in r["cells"]]) for r in grid["rows"]]
        for grid in page["grids"]
    ]
    assert found == expected


def test_only_wanted_tags_become_elements():
    markup = "<table><tr><td><a href='/x'>one</a><td>two</table><div><A>three</div></a>"
    elements, pieces = html.read_elements(markup, frozenset(["a"]))
    assert [(e.tag, e.ix, e.last) for e in elements] == [("a", 0, 0), ("a", 1, 1)]
    assert [pieces[e.first : e.end] for e in elements] == [["one"], ["three"]]
