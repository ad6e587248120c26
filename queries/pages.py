"""Page operators, on the driver's pages and on pages rendered from other tables.

A rendered page is a projection of one source row, so rendering needs no grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queries.registry import BASE_URL, RE2_SPACE, escaped, markup, money, query, table
from snapledger.functions import grids
from snapledger.operators import checks
from snapledger.operators import pages as page_ops
from snapledger.plans import datasets as ds
from snapledger.plans import page_index
from snapledger.plans import layers
from snapledger.session import stage


def parse(pages: DataFrame, tags, tables: str | None = None) -> DataFrame:
    return page_ops.parse(pages, tags=tags, tables=tables)


def source(spark, sf_dir, name: str) -> DataFrame:
    """A table of one row group, dealt to all cores before its pages are rendered."""
    return table(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism)


def row(*cells: Column | str, tag: str = "td") -> Column:
    inner = []
    for cell in cells:
        inner += [f"<{tag}>", cell, f"</{tag}>"]
    return markup("<tr>", *inner, "</tr>\n")


def html_table(*rows: Column, attrs: str = "") -> Column:
    return markup(f"<table{attrs}>", *rows, "</table>")


def section(label: str, value: Column | str) -> Column:
    return markup(
        f'<div class="{ds.SECTION_CLASS}"><span>{label}</span><span>', value, "</span></div>"
    )


def group_page() -> Column:
    """Page of a customer as a group: heading, release links, region tables."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")

    def link(ending: str, label: str):
        return markup('<a href="/release/rl', key, ending, '/?ref_=x">', label, "</a>")

    links = (
        F.when(segment == "FURNITURE", markup(link("5", "Domestic <b>wide</b>"), link("", "Domestic")))
        .when(segment == "MACHINERY", markup(link("7", "Original"), link("5", "Domestic wide")))
        .when(segment == "BUILDING", link("", " Domestic\n"))
        .otherwise(markup('<a href="/title/tt', key, '/">Domestic</a>', link("7", "Original")))
    )
    whole = F.floor(F.abs("c_acctbal"))
    head = markup('<tr><th colspan="4">Nation ', F.col("c_nationkey"), "</th></tr>")
    body = [
        row("Market", "Release Date", "Opening", "Gross", tag="th"),
        row(markup("First ", segment), "Jan 1, 2024", money(whole), money(whole * 10)),
        row("Second", "-", "–", "N/A"),
        row("Third", " Feb 2, 2024 ", money(whole)),
        row("Fourth", "left out"),
        row("Total", "", money(whole), money(whole)),
    ]
    kind = f' class="{ds.REGION_CLASS}"'
    worldwide = row(markup('<th colspan="4">Worldwide</th>'))
    return markup(
        f'<h1 class="{ds.TITLE_CLASS} x">', escaped(F.col("c_name")), "</h1>", links,
        html_table(head, *body, attrs=kind),
        html_table(worldwide, row("All", "Jan 1", "$1", "$2"), attrs=kind),
    )


def release_page() -> Column:
    """Page of a part as a release: heading, sections, a summary and a daily table."""
    price = F.floor("p_retailprice")
    theaters = F.format_number(F.col("p_size") * 100, 0)
    sections = [
        section("Distributor", markup(escaped(F.col("p_brand")), "<a>See full company information</a>")),
        section("Opening:", markup(money(price), " <br>\n ", theaters, " theaters")),
        section("Release Date", "Jan 1, 2023"),
        section("Release Date: ", markup("Feb ", F.col("p_size"), ", 2024")),
        section("MPAA", F.when(F.col("p_size") > 25, "PG").otherwise("R")),
        section("Genres", markup(F.col("p_type"), "\n\n    Drama")),
        section("Widest Release", markup(theaters, " theaters")),
        markup(f'<div class="{ds.SECTION_CLASS}"><span>Running Time</span></div>'),
    ]
    summary = html_table(row("Key", "Value"), row("Size", F.col("p_size")))
    daily = html_table(
        row("Date", "DOW", "Daily", "Theaters", tag="th"),
        row("Jan 1", "Friday", money(price), theaters),
        row("Jan 2", "Saturday", money(price * 2), ""),
        row("Jan 3", "Sunday", "-", "N/A"),
    )
    return markup(
        f'<h1 class="{ds.TITLE_CLASS}">', escaped(F.col("p_name")), "</h1>", *sections, summary, daily
    )


def customer_groups(spark, sf_dir) -> DataFrame:
    return source(spark, sf_dir, "customer").select(
        "c_custkey",
        markup(f"{BASE_URL}{page_index.GROUP_PATH}gr", F.col("c_custkey"), "/").alias("url"),
        group_page().alias("html"),
    )


def part_releases(spark, sf_dir) -> DataFrame:
    return source(spark, sf_dir, "part").select(
        "p_partkey",
        markup(f"{BASE_URL}{page_index.RELEASE_PATH}rl", F.col("p_partkey"), "/").alias("url"),
        release_page().alias("html"),
    )


@query(
    f"""
    WITH found AS (
        SELECT page_id, regexp_extract_all(html, '<a href="(/[^"]*)">', 1) AS hrefs,
               regexp_extract_all(html, '<a href="/[^"]*">([^<]*)</a>', 1) AS texts
        FROM pages
    ), anchors AS (
        SELECT page_id, CAST(unnest(range(len(hrefs))) AS INTEGER) AS pos,
               unnest(hrefs) AS href, unnest(texts) AS words
        FROM found
    )
    SELECT page_id, pos, href, '{BASE_URL}' || href AS url, nullif(trim(words), '') AS text
    FROM anchors QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1
    """
)
def page_links(spark, sf_dir):
    parsed = parse(source(spark, sf_dir, "pages").select("page_id", "html"), ("a",))
    return page_ops.links(parsed, "/", BASE_URL)


@query(
    """
    SELECT page_id, regexp_replace(replace(replace(replace(replace(trim(
               regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)),
               '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g') AS heading
    FROM pages
    """
)
def page_heading(spark, sf_dir):
    parsed = parse(source(spark, sf_dir, "pages"), ("h1",))
    return parsed.select("page_id", page_ops.heading().alias("heading"))


DOMESTIC_SQL = f"""
    CASE c_mktsegment WHEN 'FURNITURE' THEN '{BASE_URL}/release/rl' || c_custkey || '/'
         WHEN 'MACHINERY' THEN '{BASE_URL}/release/rl' || c_custkey || '5/'
         WHEN 'BUILDING' THEN '{BASE_URL}/release/rl' || c_custkey || '/' END
"""


@query(f"SELECT c_custkey, {DOMESTIC_SQL} || '?ref_=x' AS url FROM customer")
def page_labelled_link(spark, sf_dir):
    parsed = parse(customer_groups(spark, sf_dir), ("a",))
    link = page_ops.labelled_link(page_index.RELEASE_PATH, ds.DOMESTIC, BASE_URL)
    return parsed.select("c_custkey", link.alias("url"))


CELL_SQL = (
    f"regexp_replace(regexp_replace(text, '^{RE2_SPACE}+|{RE2_SPACE}+$', '', 'g'), "
    f"'[\\r\\n]+|{RE2_SPACE}{{2,}}', ' ', 'g')"
)


@query(
    f"""
    SELECT doc_id, CAST(0 AS INTEGER) AS table_ix, CAST(0 AS INTEGER) AS row_ix,
           'Source | Language | Text' AS cells
    FROM documents
    UNION ALL SELECT doc_id, 0, 1, source || ' | ' || lang || ' | ' || {CELL_SQL} FROM documents
    """
)
def page_tables(spark, sf_dir):
    words = escaped(F.col("text"))
    page = html_table(
        row("Source", "Language", "Text", tag="th"), row(F.col("source"), F.col("lang"), words)
    )
    docs = source(spark, sf_dir, "documents").select("doc_id", page.alias("html"))
    rows = page_ops.table_rows(parse(docs, (), grids.EVERY))
    return rows.withColumn("cells", F.array_join("cells", " | "))


LISTING_SQL = "'$' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT))"


def listing_page() -> Column:
    """Page of an order as a listing: a revenue table, group links and a notes table."""
    whole = F.floor("o_totalprice")
    revenue = html_table(
        row("Rank", "Release Group", "Worldwide", "Domestic", "Foreign", tag="th"),
        row("1", markup("Film ", F.col("o_orderkey")), money(whole), "-", ""),
        row("2", escaped(F.lit("A & B")), money(whole * 20000), money(whole), "N/A"),
    )
    group = markup("/releasegroup/gr", F.col("o_custkey"), "/")
    links = markup(
        '<a href="', group, '?ref_=a">Film <i>', F.col("o_orderkey"), "</i></a>",
        '<a href="', group, '?ref_=a">again</a>',
        '<a href="', group, '?ref_=b"> </a><a href="/title/x/">other</a>',
    )
    notes = html_table(row("Note"), row(escaped(F.col("o_orderpriority"))))
    return markup("<body>", revenue, links, notes)


def order_listings(spark, sf_dir) -> DataFrame:
    return source(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("release_year"),
        F.trunc("o_orderdate", "month").alias("scraped_date"),
        listing_page().alias("html"),
    )


@query(
    f"""
    SELECT o_orderkey, 'Film ' || o_orderkey AS "Release Group", {LISTING_SQL} AS "Worldwide",
           '-' AS "Domestic", CAST(NULL AS VARCHAR) AS "Foreign"
    FROM orders
    UNION ALL
    SELECT o_orderkey, 'A & B', '$' || format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT) * 20000),
           {LISTING_SQL}, NULL
    FROM orders
    """
)
def page_first_table(spark, sf_dir):
    parsed = parse(order_listings(spark, sf_dir).select("o_orderkey", "html"), (), grids.FIRST)
    records = page_ops.table_records(parsed, page_ops.first_table(), layers.REVENUE_COLUMNS)
    return records.select("o_orderkey", *layers.REVENUE_COLUMNS)


@query(
    """
    SELECT o_orderkey, CAST(r AS INTEGER) AS row_ix,
           CASE r WHEN 0 THEN 'Note' ELSE o_orderpriority END AS "0"
    FROM orders, range(2) AS t(r)
    """
)
def page_last_table(spark, sf_dir):
    parsed = parse(order_listings(spark, sf_dir).select("o_orderkey", "html"), (), grids.LAST)
    return page_ops.table_records(parsed, page_ops.last_table(), ["0"]).drop("extras")


METADATA_SQL = """
    'rl' || p_partkey AS release_id, p_name AS movie_title, p_brand AS distributor,
    CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS opening_amount,
    CAST(p_size * 100 AS VARCHAR) AS opening_theaters, 'Feb ' || p_size || ', 2024' AS release_date,
    CASE WHEN p_size > 25 THEN 'PG' ELSE 'R' END AS rating, CAST(NULL AS VARCHAR) AS runtime,
    p_type || ' Drama' AS genres, CAST(p_size * 100 AS VARCHAR) AS widest_release
"""


@query(f"SELECT {METADATA_SQL} FROM part")
def page_label_values(spark, sf_dir):
    pages = part_releases(spark, sf_dir)
    pages = pages.select(markup("rl", F.col("p_partkey")).alias("release_id"), "html")
    parsed = parse(pages, ds.RELEASE_TAGS)
    return page_ops.release_metadata(parsed, ds.SECTION_CLASS, ds.TITLE_CLASS)


MARKETS_SQL = """
    SELECT c_custkey, 'Nation ' || c_nationkey AS region, 'First ' || c_mktsegment AS market,
           'Jan 1, 2024' AS release_date, CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR) AS opening,
           CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) * 10 AS VARCHAR) AS total_gross, c_name AS movie_title
    FROM customer
    UNION ALL
    SELECT c_custkey, 'Nation ' || c_nationkey, 'Second', NULL, NULL, NULL, c_name FROM customer
    UNION ALL
    SELECT c_custkey, 'Nation ' || c_nationkey, 'Third', 'Feb 2, 2024', NULL,
           CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR), c_name
    FROM customer
"""


@query(MARKETS_SQL)
def page_grouped_rows(spark, sf_dir):
    pages = customer_groups(spark, sf_dir).select("c_custkey", "html")
    parsed = parse(pages, ds.GROUP_TAGS)
    return page_ops.grouped_rows(parsed, ds.REGION_CLASS, ds.TITLE_CLASS)


LOOKUP_SQL = f"""
    SELECT movie_title, '{BASE_URL}/releasegroup/gr' || o_custkey || '/' AS release_group_url,
           {DOMESTIC_SQL} AS domestic_release_url,
           CAST(year(o_orderdate) AS INTEGER) AS release_year,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS scraped_date
    FROM (SELECT *, 'Film ' || o_orderkey AS movie_title FROM orders
          UNION ALL SELECT *, NULL FROM orders)
    LEFT JOIN customer ON c_custkey = o_custkey
"""


def lookup(spark, sf_dir) -> DataFrame:
    """Lookup rows from the listings of orders and the group pages of customers."""
    listings = parse(order_listings(spark, sf_dir), ds.YEAR_TAGS)
    groups = parse(customer_groups(spark, sf_dir), ("a",))
    domestic = stage(ds.domestic_links(groups, BASE_URL), "domestic")
    return ds.lookup_rows(ds.group_links(listings, BASE_URL), domestic)


@query(LOOKUP_SQL)
def lookup_build(spark, sf_dir):
    return lookup(spark, sf_dir)


def page_batches(spark, sf_dir) -> DataFrame:
    """Driver pages, without markup where the URL points into the page."""
    pages = source(spark, sf_dir, "pages")
    language = F.regexp_extract("url", r"//[^/]+/([a-z]+)/", 1)
    return pages.select(
        "page_id",
        language.alias("dataset"),
        F.when(~F.col("url").contains("#"), F.col("html")).alias("html"),
    )


FAILED_SQL = """
    SELECT page_id, regexp_extract(url, '//[^/]+/([a-z]+)/', 1) AS dataset
    FROM pages WHERE contains(url, '#')
"""


def failed_pages(spark, sf_dir) -> DataFrame:
    parsed = parse(page_batches(spark, sf_dir), ("h1",))
    return parsed.where(F.col("page.error").isNotNull()).select(
        "dataset", F.col("page_id").cast("string").alias("item"), F.col("page.error").alias("error")
    )


@query(
    """
    SELECT 'pages' AS dataset, CAST(page_id AS VARCHAR) AS item, 'empty page' AS error
    FROM pages WHERE contains(url, '#')
    """
)
def parse_failures(spark, sf_dir):
    parsed = parse(page_batches(spark, sf_dir), ("h1",))
    return page_ops.parse_failures(parsed, "pages", F.col("page_id"))


@query(
    f"""
    SELECT dataset, CAST(count(*) AS BIGINT) AS failed,
           array_to_string(list(CAST(page_id AS VARCHAR) ORDER BY page_id)[1:10], ',') AS first_items
    FROM ({FAILED_SQL}) GROUP BY dataset
    """
)
def failure_summary(spark, sf_dir):
    failures = stage(failed_pages(spark, sf_dir), "failures")
    summary = checks.failure_summary(failures, F.col("item").cast("bigint"))
    return summary.withColumn("first_items", F.array_join("first_items", ","))


@query(
    f"""
    SELECT p_partkey, p_name AS "Release Group",
           '$' || format('{{:,}}', CAST(floor(p_retailprice) AS BIGINT)) AS "Worldwide"
    FROM part WHERE p_size <= 25
    """
)
def required_columns(spark, sf_dir):
    """Tables of larger parts lack a required column, so those batches are refused."""
    complete = row("Release Group", "Worldwide", "Domestic", "Foreign", tag="th")
    incomplete = row("Release Group", "Worldwide", "Domestic", "Elsewhere", tag="th")
    heading = F.when(F.col("p_size") <= 25, complete).otherwise(incomplete)
    page = html_table(heading, row(escaped(F.col("p_name")), money(F.floor("p_retailprice")), "-", "-"))
    pages = source(spark, sf_dir, "part").select("p_partkey", page.alias("html"))
    first, wanted = page_ops.first_table(), ["Release Group", "Worldwide"]
    complete = parse(pages, (), grids.FIRST).where(page_ops.has_columns(first, layers.REVENUE_COLUMNS))
    return page_ops.table_records(complete, first, wanted).select("p_partkey", *wanted)


@query(
    """
    SELECT o_orderkey, 'A' || o_orderkey AS "Date", 'B' || o_orderkey AS lower_date,
           'C' || o_custkey AS own_key, 'D' AS spanned, CAST(5 AS INTEGER) AS others
    FROM orders
    """
)
def page_extra_columns(spark, sf_dir):
    """Headings that differ by case or read like the page's own key, and a spanning cell."""
    key = F.col("o_orderkey")
    heading = row("Date", "date", "o_orderkey", markup('<th colspan="2">Wide</th>'), tag="th")
    cells = row(markup("A", key), markup("B", key), markup("C", F.col("o_custkey")), tag="td")
    body = F.replace(cells, F.lit("</tr>"), F.lit('<td colspan="2000000000">D</td></tr>'))
    pages = source(spark, sf_dir, "orders").select("o_orderkey", html_table(heading, body).alias("html"))
    parsed = parse(pages, (), grids.FIRST)
    rows = page_ops.table_records(parsed, page_ops.first_table(), ["Date"])
    extra = F.col("extras")
    return rows.select(
        "o_orderkey",
        "Date",
        extra["date"].alias("lower_date"),
        extra["o_orderkey"].alias("own_key"),
        extra["Wide"].alias("spanned"),
        F.size("extras").alias("others"),
    )


@query(
    """
    SELECT s_suppkey, CAST(0 AS INTEGER) AS pos, '/releasegroup/gr' || s_nationkey || '/' AS href,
           'Film ' || s_suppkey AS text, '$' || s_nationkey AS "Worldwide"
    FROM supplier
    """
)
def page_deep_markup(spark, sf_dir):
    """Ordinary listings below thousands of tags that are never closed."""
    deep = F.repeat(F.lit("<b><i><span><div>"), 1500)
    nation, key = F.col("s_nationkey"), F.col("s_suppkey")
    group = markup('<a href="/releasegroup/gr', nation, '/">Film ', key, "</a>")
    revenue = html_table(row("Worldwide", tag="th"), row(markup("<b>$<i>", nation)))
    pages = source(spark, sf_dir, "supplier").select(
        "s_suppkey", markup(deep, group, revenue, deep).alias("html")
    )
    parsed = stage(parse(pages, ("a",), grids.FIRST), "deep")
    links = page_ops.links(parsed, "/releasegroup/").drop("url")
    rows = page_ops.table_records(parsed, page_ops.first_table(), ["Worldwide"])
    return links.join(rows.select("s_suppkey", "Worldwide"), "s_suppkey")
