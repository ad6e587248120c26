import datetime

import pytest
from pyspark.sql import functions as F

from snapledger.functions import text


def evaluate(spark, expression, values):
    """Result of ``expression`` for each value, in order."""
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    rows = frame.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in rows]


CASES = {
    "money": (
        text.money_to_int,
        {"$1,234": 1234, "-": 0, "": 0, None: 0, "1234": 234, "$2,923,706,026": 0, "$12.5": 13,
         "$2,147,483,647": 2147483647, "$2,147,483,648": 0, "€7": 7, "$1e3": 1000, "$x": 0},
    ),
    "wide money": (lambda c: text.money_to_int(c, "bigint"), {"$2,923,706,026": 2923706026, "-": 0}),
    "safe int": (
        text.safe_int,
        {"1234": 1234, " 42 ": 42, "-5": -5, "+7": 7, "": None, "12abc": None, "12.5": 13,
         "13.5": 14, "-12.5": -13, "1e3": 1000, "99999999999": None, None: None},
    ),
    "digits": (
        text.digits_or_null,
        {"$1,234": "1234", "-": None, "–": None, "—": None, "N/A": None, "": None, None: None,
         " - ": None, "$1.5": "15", "$-7": "7", "$": None, "12 theaters": "12", "١٢": None},
    ),
    "unicode digits": (lambda c: text.digits_or_null(c, unicode_digits=True), {"١٢ x": "١٢"}),
    "text": (
        text.text_or_null,
        {"-": None, "–": None, "N/A": None, "": None, "   ": None, None: None,
         " Jan 1, 2024 ": "Jan 1, 2024", " - ": "-"},
    ),
    "opening amount": (
        text.opening_amount,
        {"$100,262,540 4,000 theaters": "100262540", "": None, None: None, "theaters $9": "9",
         "$5 $7 1 theater 2 Theaters": "7", "$5 $": None, "x$5": None, "$5 \n4 theaters": "5"},
    ),
    "opening theaters": (
        text.opening_theaters,
        {"$100,262,540 4,000 theaters": "4000", "": None, None: None, "theaters $9": None,
         "$5 $7 1 theater 2 Theaters": "2", "9 theaters theaters": None, "$5 \n4 theaters": "4",
         "7 (MegaTheaters)": "7"},
    ),
    "first number": (text.first_number, {" 1,234 theaters": "1234", "x 5": None, "": None, None: None}),
    "squeeze": (text.squeeze_space, {" a \n\t b  c ": "a b c", "": "", None: None}),
    "strip": (text.strip, {"　 a b \x1f": "a b"}),
    "phrase": (lambda c: text.strip_phrase(c, "See more"), {"ACME See more": "ACME", "ACME": "ACME"}),
    "label": (text.label_key, {" Release Date: ": "release date"}),
    "canonical": (
        text.canonical_url,
        {"https://h/p?a#b": "https://h/p", "": None, None: None, "HTTP://A.b/x#f": "http://A.b/x",
         "/p?a": "/p", "https://h/a#b?c\nd": "https://h/a", "?x": None},
    ),
    "id": (
        lambda c: text.id_from_url(c, r"/release/(rl\d+)/"),
        {"https://h/release/rl99/": "rl99", "https://h/release/foo/": "foo",
         "https://h/release/bar": "bar", "plain": "plain", None: None},
    ),
    "path": (
        lambda c: text.path_value(c, "release_year"),
        {"s3://b/release_year=2024/scraped_date=2024-05-01/x": "2024", "s3://b/x": ""},
    ),
    "path date": (
        lambda c: text.path_date(c, "scraped_date"),
        {"/release_year=2024/scraped_date=2024-05-01/x": datetime.datetime(2024, 5, 1)},
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_expression(spark, name):
    expression, cases = CASES[name]
    assert dict(zip(cases, evaluate(spark, expression, list(cases)))) == cases


def test_malformed_path_date_is_an_error(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        evaluate(spark, lambda c: text.path_date(c, "scraped_date"), ["/scraped_date=soon/x"])


def test_canonical_url_is_idempotent(spark):
    urls = ["https://h/p?a#b", "HTTP://A.b/x#f", "https://h/"]
    once = evaluate(spark, text.canonical_url, urls)
    assert evaluate(spark, text.canonical_url, once) == once


def test_white_space_class_is_the_unicode_one(spark):
    everything = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    cleaned = evaluate(spark, lambda c: F.regexp_replace(c, f"[{text.SPACE}]", ""), everything)
    assert [c for c, left in zip(everything, cleaned) if left == ""] == list(text.WHITE_SPACE)
