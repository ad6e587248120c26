"""Cleaning expressions. Every function takes and returns Columns; there are no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing amount, count or date.
MISSING_MARKERS = ["-", "–", "—", "N/A"]

# White space as Unicode counts it, as characters (the last is U+3000) and as the
# inside of a regular-expression class. The class names are much faster than a list.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
FIRST_WORD = f"([^{SPACE}]+)"
LAST_PRICE = rf"(?s)^(?:.*[{SPACE}])?(\$[^{SPACE}]*)"
BEFORE_THEATERS = f"(?is)^(?:.*[{SPACE}])?([^{SPACE}]++)[{SPACE}]++[^{SPACE}]*theater"


def strip(text: Column) -> Column:
    """Text without white space at either end."""
    return F.trim(text, F.lit(WHITE_SPACE))


def blank_to_null(text: Column) -> Column:
    """Stripped text, null when nothing is left."""
    stripped = strip(text)
    return F.when(stripped != "", stripped)


def squeeze_space(text: Column) -> Column:
    """Every run of white space becomes one blank; none at the ends."""
    return strip(F.regexp_replace(text, f"[{SPACE}]+", " "))


def digits_or_null(text: Column, unicode_digits: bool = False) -> Column:
    """Only the digits of an amount or count, null when there are none.

    Signs and decimal points are dropped with everything else (``$1.5`` gives
    ``15``); no missing marker has a digit. ``unicode_digits`` also keeps digits
    outside ASCII.
    """
    pattern = r"(?U)[^\d]" if unicode_digits else "[^0-9]"
    digits = F.regexp_replace(text, pattern, "")
    return F.when(digits != "", digits)


def text_or_null(text: Column) -> Column:
    """Stripped text, null for blank or a missing marker (tested before stripping)."""
    return F.when(~text.isin(MISSING_MARKERS), blank_to_null(text))


def safe_int(text: Column, to: str = "int") -> Column:
    """Text to a whole number, null where it is none or does not fit.

    Decimal and exponent notation round half away from zero.
    """
    plain = text.try_cast(to)
    rounded = F.round(text.try_cast("decimal(38,10)"), 0).try_cast(to)
    return F.coalesce(plain, rounded)


def money_to_int(text: Column, to: str = "int") -> Column:
    """``$1,234`` to 1234, and 0 for anything that is no number or does not fit ``to``.

    The first character is dropped whatever it is, so the currency sign has to be
    there. ``to='bigint'`` keeps amounts beyond 2,147,483,647, which are 0 otherwise.
    """
    unsigned = F.replace(F.substr(text, F.lit(2)), F.lit(","), F.lit(""))
    return F.coalesce(safe_int(unsigned, to), F.lit(0).cast(to))


def opening_amount(text: Column) -> Column:
    """Digits of the last ``$`` word of ``$100,262,540 4,000 theaters``."""
    return digits_or_null(F.regexp_extract(text, LAST_PRICE, 1))


def opening_theaters(text: Column) -> Column:
    """Digits of the word before the last word that mentions theaters."""
    return digits_or_null(F.regexp_extract(text, BEFORE_THEATERS, 1))


def first_number(text: Column) -> Column:
    """Digits of the first word."""
    return digits_or_null(F.regexp_extract(text, FIRST_WORD, 1))


def strip_phrase(text: Column, phrase: str) -> Column:
    """Text without any occurrence of ``phrase``, stripped."""
    return strip(F.replace(text, F.lit(phrase), F.lit("")))


def label_key(text: Column) -> Column:
    """Lower-case label without colons."""
    return F.replace(F.lower(strip(text)), F.lit(":"), F.lit(""))


def canonical_url(url: Column) -> Column:
    """URL without query and fragment and with a lower-case scheme; blank is null."""
    bare = F.regexp_replace(url, r"(?s)[?#].*$", "")
    scheme = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*:", 0)
    whole = F.concat(F.lower(scheme), F.substr(bare, F.length(scheme) + 1))
    return F.when(whole != "", whole)


def absolute_url(base_url: str, path: Column) -> Column:
    """Site-relative path (leading ``/``) on ``base_url``."""
    return F.concat(F.lit(base_url.rstrip("/")), path)


def id_from_url(url: Column, pattern: str) -> Column:
    """First group of ``pattern``, else the last path segment."""
    found = F.regexp_extract(url, pattern, 1)
    segment = F.when(url.endswith("/"), F.split_part(url, F.lit("/"), F.lit(-2))).otherwise(
        F.split_part(url, F.lit("/"), F.lit(-1))
    )
    return F.when(found != "", found).otherwise(segment)


def path_value(path: Column, key: str) -> Column:
    """Value of ``key=value`` in a file path, empty text when the key is absent."""
    tail = F.split_part(path, F.lit(f"{key}="), F.lit(2))
    return F.split_part(tail, F.lit("/"), F.lit(1))


def path_date(path: Column, key: str) -> Column:
    """Timestamp without zone of a ``key=YYYY-MM-DD`` path part; an error if malformed."""
    return F.to_timestamp_ntz(path_value(path, key), F.lit("yyyy-MM-dd"))
