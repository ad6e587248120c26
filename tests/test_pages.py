import pytest
import site_pages as site
from pyspark.sql import functions as F

from snapledger.functions import html
from snapledger.operators import pages as page_ops
from snapledger.plans import datasets as ds


@pytest.fixture(scope="module")
def parsed(spark):
    pages = spark.createDataFrame(site.rows(), site.SCHEMA).select("page_key", "html")
    return page_ops.parse(pages, tags=html.KEPT)


def of(parsed, key):
    return parsed.where(F.col("page_key") == key)


def test_links_keep_the_first_per_target(parsed):
    rows = page_ops.links(of(parsed, "/year/world/2024/"), "/releasegroup/", site.BASE).collect()
    assert [(r["pos"], r["href"], r["url"], r["text"]) for r in rows] == [
        (0, "/releasegroup/gr1/?ref_=t1", f"{site.BASE}/releasegroup/gr1/?ref_=t1", "Alpha & Omega"),
        (1, "/releasegroup/gr2/?ref_=t2", f"{site.BASE}/releasegroup/gr2/?ref_=t2", "Beta"),
    ]


def test_link_without_text(parsed):
    rows = page_ops.links(of(parsed, "/year/world/2023"), "/releasegroup/gr4").collect()
    assert [(r["pos"], r["text"]) for r in rows] == [(0, None)]


@pytest.mark.parametrize("group, release", [("gr1", "/release/rl1/?ref_=x"), ("gr2", "/release/rl2/"), ("gr3", None)])
def test_labelled_link(parsed, group, release):
    link = page_ops.labelled_link("/release/", "Domestic")
    assert of(parsed, f"/releasegroup/{group}/").select(link).first()[0] == release


def test_heading_by_class(parsed):
    page = of(parsed, "/release/rl1/")
    assert page.select(page_ops.heading(ds.TITLE_CLASS)).first()[0] == "Alpha & Omega"
    assert page.select(page_ops.heading("other")).first()[0] is None


def test_first_and_last_table(parsed):
    page = of(parsed, "/year/world/2023")
    first = page_ops.table_records(page, page_ops.first_table(), ["Release Group", "Foreign"])
    assert first.columns == ["page_key", "row_ix", "Release Group", "Foreign", "extras"]
    assert [r["Release Group"] for r in first.collect()] == ["Gamma", None]
    assert first.first()["extras"] == {"Rank": "1", "Worldwide": "$77", "Domestic": "$7"}
    last = page_ops.table_records(page, page_ops.last_table(), ["0"])
    assert [r["0"] for r in last.collect()] == ["notes"]


def test_table_rows_have_headings_first(parsed):
    rows = page_ops.table_rows(of(parsed, "/release/rl1/")).collect()
    assert [(r["table_ix"], r["row_ix"], r["cells"]) for r in rows] == [
        (0, 0, ["summary"]),
        (1, 0, ["Date", "Daily"]),
        (1, 1, ["Jan 1", "$10"]),
        (1, 2, ["Jan 2", "N/A"]),
    ]


def records(spark, markup, columns, **more):
    pages = spark.createDataFrame([(1, markup)], "k int, html string")
    return page_ops.table_records(page_ops.parse(pages), page_ops.first_table(), columns).collect()


def test_columns_are_declared_and_the_rest_is_extra(spark):
    pages = spark.createDataFrame(
        [(1, "<table><tr><th>a<th>b<tr><td>1<td>2</table>"), (2, "<table><tr><th>b<th>c<tr><td>3<td>4</table>")],
        "k int, html string",
    )
    rows = page_ops.table_records(page_ops.parse(pages), page_ops.first_table(), ["a", "b"]).orderBy("k")
    assert [tuple(r) for r in rows.collect()] == [(1, 0, "1", "2", {}), (2, 0, None, "3", {"c": "4"})]


def test_keys_of_the_page_win(spark):
    (row,) = records(spark, "<table><tr><th>K<th>k<th>Date<th>date<tr><td>1<td>2<td>3<td>4</table>", ["k", "Date"])
    assert row.asDict() == {"k": 1, "row_ix": 0, "Date": "3", "extras": {"K": "1", "k": "2", "date": "4"}}


def test_columns_within_spans(spark):
    markup = (
        "<table><tr><th colspan=3>X<th>Y<th>X<tr><td>1<td colspan=2>2<td>3<td>4"
        "<tr><td colspan=2000000000>5<tr><td>6</table>"
    )
    rows = records(spark, markup, ["X.1", "X.2", "X.3", "Y"])
    assert [tuple(r)[2:6] for r in rows] == [("2", "2", "4", "3"), ("5", "5", "5", "5"), (None,) * 4]
    assert [r["extras"].get("X") for r in rows] == ["1", "5", "6"]


def test_required_columns_per_table(spark):
    pages = spark.createDataFrame(
        [(1, "<table><tr><th>a<th>b<tr><td>1<td>2</table>"), (2, "<table><tr><th>a<tr><td>3<tr><td>4</table>")],
        "k int, html string",
    )
    parsed, first = page_ops.parse(pages), page_ops.first_table()
    assert [r["k"] for r in parsed.where(page_ops.has_columns(first, ["a", "b"])).collect()] == [1]
    refused = ds.refused(parsed, first, "d", F.col("k"), ["a", "b"]).collect()
    assert [tuple(r) for r in refused] == [("d", "2", "missing columns: b")]


def section(label, value):
    return f"<div class='{ds.SECTION_CLASS}'><span>{label}</span><span>{value}</span></div>"


def metadata(spark, markup):
    pages = spark.createDataFrame([("rl1", markup)], "id string, html string")
    return page_ops.release_metadata(page_ops.parse(pages), ds.SECTION_CLASS, ds.TITLE_CLASS).first()


def test_first_matching_rule_wins_and_repeats_overwrite(spark):
    row = metadata(
        spark,
        section("Distributor opening", "D")
        + section("Opening", "$1 2 theaters")
        + section("Opening weekend", "$3 4 theaters")
        + section("Release date (mpaa)", "day")
        + section("MPAA", "PG"),
    )
    assert (row["distributor"], row["opening_amount"], row["opening_theaters"]) == ("D", "3", "4")
    assert (row["release_date"], row["rating"]) == ("day", "PG")


def test_spans_are_taken_in_document_order(spark):
    nested = f"<div class='{ds.SECTION_CLASS}'><p><span>MPAA<span>inner</span></span><span>R</span></p></div>"
    assert metadata(spark, nested)["rating"] == "inner"


def test_nested_sections_both_count(spark):
    inner = section("Genres", "Drama")
    outer = f"<div class='{ds.SECTION_CLASS}'>{inner}</div>"
    assert metadata(spark, outer)["genres"] == "Drama"


def test_other_classes_and_single_spans_are_no_sections(spark):
    row = metadata(
        spark,
        "<div class='a-section'><span>MPAA</span><span>R</span></div>"
        f"<div class='{ds.SECTION_CLASS}'><span>Genres</span></div>" + section("Widest Release", ""),
    )
    assert row.asDict() == {"id": "rl1", **dict.fromkeys(row.asDict().keys() - {"id"})}


def test_grouped_rows_by_width(spark):
    table = (
        f"<table class='{ds.REGION_CLASS}'><tr><th colspan='4'> EMEA </th></tr>"
        "<tr><td>France</td><td>Jan 1</td><td>$5</td><td>$9</td><td>more</td></tr>"
        "<tr><td>Spain</td><td>-</td><td>$9</td></tr><tr><td>Italy</td><td>x</td></tr>"
        "<tr><td>TOTAL</td><td></td><td>$1</td><td>$2</td></tr><tr><td> </td><td>a</td><td>b</td></tr></table>"
    )
    unnamed = table.replace("colspan='4'", "colspan='3'")
    blank = table.replace("EMEA", "")
    pages = spark.createDataFrame([("gr1", table + unnamed + blank)], "id string, html string")
    rows = page_ops.grouped_rows(page_ops.parse(pages), ds.REGION_CLASS, ds.TITLE_CLASS)
    assert [tuple(r)[1:6] for r in rows.collect()] == [
        ("EMEA", "France", "Jan 1", "5", "9"),
        ("EMEA", "Spain", None, None, "9"),
    ]


def test_bytes_that_are_no_text_do_not_fail_the_batch(spark):
    pages = spark.createDataFrame([(1, b"<h1>a\xffb</h1>"), (2, b"<h1>c</h1>")], "k int, html binary")
    for markup in (pages, pages.withColumn("html", F.col("html").cast("string"))):
        titles = page_ops.parse(markup).select("k", page_ops.heading()).collect()
        assert {tuple(row) for row in titles} == {(1, "a\ufffdb"), (2, "c")}


def test_failures_do_not_lose_other_pages(parsed):
    failures = page_ops.parse_failures(parsed, "d", F.col("page_key")).collect()
    assert [tuple(r) for r in failures] == [("d", "/releasegroup/gr4/", "empty page")]
    assert parsed.count() == len(site.PAGES)


def test_page_operators_parse_once_and_never_shuffle(spark, parsed, plan):
    link = page_ops.labelled_link("/release/", "Domestic").alias("link")
    frames = [
        page_ops.links(parsed, "/", site.BASE),
        parsed.select("page_key", page_ops.heading().alias("h"), link),
        page_ops.table_rows(parsed),
        page_ops.table_records(parsed, page_ops.last_table(), ["Date"]),
        page_ops.release_metadata(parsed, ds.SECTION_CLASS, ds.TITLE_CLASS),
        page_ops.grouped_rows(parsed, ds.REGION_CLASS, ds.TITLE_CLASS),
        page_ops.parse_failures(parsed, "d", F.col("page_key")),
    ]
    for frame in frames:
        text = plan(frame)
        assert text.count("ArrowEvalPython") == 1
        assert "Exchange" not in text
