"""Registry of queries and their SQL counterparts, and what they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
SQL: dict[str, str] = {}

BASE_URL = "https://films.example"

# White space as Unicode counts it, for RE2.
RE2_SPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def query(sql: str):
    """Register the decorated function under its name, with the SQL it has to equal."""

    def register(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(amount: Column) -> Column:
    """``$1,234`` of a whole number."""
    return F.concat(F.lit("$"), F.format_number(amount, 0))


def escaped(text: Column) -> Column:
    """Text as markup."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def markup(*parts: Column | str) -> Column:
    """Parts one after another: columns as they are, strings as markup."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
