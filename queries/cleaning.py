"""Cleaning expressions over texts made from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.registry import RE2_SPACE, money, query, table
from snapledger.functions import text

# Amount texts with missing markers and amounts beyond 32 bits.
GROSS_SQL = """
    CASE o_orderpriority WHEN '1-URGENT' THEN '-'
         WHEN '2-HIGH' THEN '$' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT) * 20000)
         WHEN '5-LOW' THEN '$' || CAST(floor(o_totalprice) AS BIGINT)
         ELSE '$' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) END
"""


def gross_text():
    whole = F.floor("o_totalprice")
    return (
        F.when(F.col("o_orderpriority") == "1-URGENT", "-")
        .when(F.col("o_orderpriority") == "2-HIGH", money(whole * 20000))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("$"), whole.cast("string")))
        .otherwise(money(whole))
    )


@query(
    f"""
    SELECT o_orderkey,
           coalesce(try_cast(replace(substring(g, 2), ',', '') AS INTEGER), 0) AS revenue,
           coalesce(try_cast(replace(substring(g, 2), ',', '') AS BIGINT), 0) AS revenue_long
    FROM (SELECT o_orderkey, {GROSS_SQL} AS g FROM orders)
    """
)
def money_to_int(spark, sf_dir):
    gross = gross_text()
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.money_to_int(gross).alias("revenue"),
        text.money_to_int(gross, "bigint").alias("revenue_long"),
    )


@query(
    """
    SELECT c_custkey, try_cast(CAST(c_acctbal AS VARCHAR) AS INTEGER) AS balance,
           try_cast(c_name AS INTEGER) AS no_number,
           try_cast(' ' || c_custkey || ' ' AS INTEGER) AS padded
    FROM customer
    """
)
def safe_int(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.safe_int(F.col("c_acctbal").cast("string")).alias("balance"),
        text.safe_int(F.col("c_name")).alias("no_number"),
        text.safe_int(F.concat(F.lit(" "), "c_custkey", F.lit(" "))).alias("padded"),
    )


PRICE_SQL = """
    CASE p_size WHEN 1 THEN '-' WHEN 2 THEN '–' WHEN 3 THEN '—' WHEN 4 THEN 'N/A' WHEN 5 THEN ''
         WHEN 6 THEN '$' WHEN 7 THEN ' - ' WHEN 8 THEN '$' || p_retailprice
         ELSE '$' || format('{:,}', CAST(floor(p_retailprice) AS BIGINT)) || ' (est.)' END
"""


def price_text():
    size = F.col("p_size")
    marked = F.when(size == 1, "-")
    for at, marker in ((2, "–"), (3, "—"), (4, "N/A"), (5, ""), (6, "$"), (7, " - ")):
        marked = marked.when(size == at, marker)
    return marked.when(size == 8, F.concat(F.lit("$"), F.col("p_retailprice").cast("string"))).otherwise(
        F.concat(money(F.floor("p_retailprice")), F.lit(" (est.)"))
    )


@query(
    f"""
    SELECT p_partkey, CASE WHEN price NOT IN ('-', '–', '—', 'N/A')
           THEN nullif(regexp_replace(price, '[^0-9]', '', 'g'), '') END AS digits
    FROM (SELECT p_partkey, {PRICE_SQL} AS price FROM part)
    """
)
def digits_or_null(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.digits_or_null(price_text()).alias("digits")
    )


@query(
    f"""
    SELECT p_partkey, CASE WHEN price NOT IN ('-', '–', '—', 'N/A')
           THEN nullif(trim(price), '') END AS words
    FROM (SELECT p_partkey, {PRICE_SQL} AS price FROM part)
    """
)
def text_or_null(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.text_or_null(price_text()).alias("words")
    )


@query(
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS amount,
           CAST(CAST(l_quantity * 100 AS BIGINT) AS VARCHAR) AS theaters
    FROM lineitem
    """
)
def opening_parts(spark, sf_dir):
    theaters = F.format_number((F.col("l_quantity") * 100).cast("bigint"), 0)
    opening = F.concat(
        F.lit("$1 "), money(F.floor("l_extendedprice")), F.lit("\n   "), theaters, F.lit(" Theaters")
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        text.opening_amount(opening).alias("amount"),
        text.opening_theaters(opening).alias("theaters"),
    )


@query(
    f"""
    SELECT doc_id, trim(regexp_replace(text, '{RE2_SPACE}+', ' ', 'g')) AS squeezed FROM documents
    """
)
def squeeze_space(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.squeeze_space(F.col("text")).alias("squeezed")
    )


@query("SELECT p_partkey, p_name AS distributor FROM part")
def strip_phrase(spark, sf_dir):
    phrase = "See full company information"
    noted = F.concat("p_name", F.lit(f" {phrase}"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.strip_phrase(noted, phrase).alias("distributor")
    )


@query("SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS widest FROM orders")
def first_number(spark, sf_dir):
    widest = F.concat(F.format_number("o_orderkey", 0), F.lit(" theaters in 2 weeks"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.first_number(widest).alias("widest")
    )


@query(
    r"""
    SELECT page_id, regexp_replace(url, '[?#].*$', '') AS canonical,
           regexp_replace(url, '[?#].*$', '') AS from_upper
    FROM pages
    """
)
def canonical_url(spark, sf_dir):
    upper = F.regexp_replace("url", "^http", "HTTP")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.canonical_url(F.col("url")).alias("canonical"),
        text.canonical_url(upper).alias("from_upper"),
    )


@query(
    r"""
    SELECT page_id, CASE WHEN regexp_matches(url, '/([0-9]+)/') THEN regexp_extract(url, '/([0-9]+)/', 1)
           WHEN url LIKE '%/' THEN split_part(url, '/', -2) ELSE split_part(url, '/', -1) END AS id
    FROM pages
    """
)
def id_from_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", text.id_from_url(F.col("url"), r"/([0-9]+)/").alias("id")
    )


# Shapes of texts that pages have, by number; K stands for the row's key.
OPENINGS = [
    ("$1 $K,000\n 3,K theaters", "K000", "3K"),
    ("$K", "K", None),
    ("3,K theaters / $K", "K", "3K"),
    ("12 Theaters 7 THEATERS", None, "7"),
    (" \t", None, None),
    ("K million", None, None),
    (None, None, None),
]
NOTES = [
    ("A See full company information", "A"),
    ("See full company informationSee full company information", ""),
    (" KSee full company information B ", "K B"),
    ("see full company information", "see full company information"),
    ("\u3000K\u3000", "K"),
    (None, None),
]
COUNTS = [("K theaters", "K"), (" \n1,K of 9", "1K"), ("about K", None), ("", None), ("\u3000K", "K"), (None, None)]


def shape(shapes):
    """Column with the text of each row's shape."""
    key = F.col("l_orderkey").cast("string")
    column = F.lit(None).cast("string")
    for i, (given, *_) in enumerate(shapes):
        if given is not None:
            value = F.replace(F.lit(given), F.lit("K"), key)
            column = F.when(F.col("l_orderkey") % len(shapes) == i, value).otherwise(column)
    return column


def shape_sql(shapes, at: int) -> str:
    """SQL with what each row's shape has to give."""
    cases = "".join(
        f" WHEN {i} THEN replace('{shape[at]}', 'K', CAST(l_orderkey AS VARCHAR))"
        for i, shape in enumerate(shapes)
        if shape[at] is not None
    )
    return f"CASE l_orderkey % {len(shapes)}{cases} END"


LINE = "l_orderkey, l_partkey, l_linenumber"


@query(f"SELECT {LINE}, {shape_sql(OPENINGS, 1)} AS amount, {shape_sql(OPENINGS, 2)} AS theaters FROM lineitem")
def opening_shapes(spark, sf_dir):
    opening = shape(OPENINGS)
    return table(spark, sf_dir, "lineitem").select(
        *LINE.split(", "),
        text.opening_amount(opening).alias("amount"),
        text.opening_theaters(opening).alias("theaters"),
    )


@query(f"SELECT {LINE}, {shape_sql(NOTES, 1)} AS distributor, {shape_sql(COUNTS, 1)} AS widest FROM lineitem")
def note_shapes(spark, sf_dir):
    phrase = "See full company information"
    return table(spark, sf_dir, "lineitem").select(
        *LINE.split(", "),
        text.strip_phrase(shape(NOTES), phrase).alias("distributor"),
        text.first_number(shape(COUNTS)).alias("widest"),
    )
