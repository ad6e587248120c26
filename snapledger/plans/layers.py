"""Raw, cleaned and published layers.

Each layer is a lazy projection of the one before, so a published table is a single
scan-and-project stage. Nothing is materialised unless a sink is asked for.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions import text
from snapledger.operators import checks
from snapledger.sinks.parquet import refresh_table
from snapledger.sources import snapshots
from snapledger.sources.union_by_name import read_text_by_name

# The columns of the raw datasets.
REVENUE_COLUMNS = ["Release Group", "Worldwide", "Domestic", "Foreign"]
LOOKUP_COLUMNS = ["movie_title", "release_group_url", "domestic_release_url"]
DAILY_COLUMNS = ["Date", "DOW", "Rank", "Daily", "Theaters", "Avg", "To Date", "Day"]
METADATA_REQUIRED = ["release_id"]
METADATA_OPTIONAL = [
    "movie_title",
    "distributor",
    "opening_amount",
    "opening_theaters",
    "release_date",
    "rating",
    "runtime",
    "genres",
    "widest_release",
]
MARKET_COLUMNS = [
    "movie_title",
    "region",
    "market",
    "release_date",
    "opening",
    "total_gross",
    "release_group_url",
]

# The contract of the published table, version 1.
PUBLISHED_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("revenue", T.IntegerType()),
        T.StructField("domestic_rev", T.IntegerType()),
        T.StructField("foreign_rev", T.IntegerType()),
        T.StructField("loaded_date", T.DateType()),
        T.StructField("release_year", T.IntegerType()),
        T.StructField("published_timestamp_utc", T.TimestampNTZType()),
    ]
)


_with_file = snapshots.with_source_file


def _raw(spark, base, key, columns, mixed, missing_ok=True) -> DataFrame:
    """Declared columns of a raw dataset; ``mixed`` reads files of any types as text."""
    kind = _key_type(key)
    if mixed:
        own = [c for c in columns if c != key]
        return read_text_by_name(spark, base, own, {key: kind, snapshots.DATE: "date"})
    return _with_file(snapshots.read_snapshots(spark, base, key, kind, columns, missing_ok))


def raw_revenue(spark: SparkSession, base: str, mixed: bool = False) -> DataFrame:
    """Revenue snapshots with year and date taken from the file path.

    They feed the published table, so a dataset that is not there is an error here: it
    must not replace what is published by nothing.
    """
    rows = _raw(spark, base, "release_year", REVENUE_COLUMNS, mixed, missing_ok=False)
    return snapshots.with_path_values(rows, "release_year")


def raw_lookup(spark: SparkSession, base: str, mixed: bool = False) -> DataFrame:
    """Groups with their domestic releases, by year."""
    return _raw(spark, base, "release_year", LOOKUP_COLUMNS, mixed)


def raw_daily_rows(
    spark: SparkSession,
    base: str,
    key: str = "release_year",
    columns: list[str] | None = None,
    mixed: bool = False,
) -> DataFrame:
    """Daily rows per release, all landed columns or the named ones.

    Naming them saves the reading of every file's footer. The datasets driven by ids are
    read by ``release_year`` or, when they were landed per entity, by that id as ``key``.
    """
    if mixed:
        return _raw(spark, base, key, columns or ["release_id", *DAILY_COLUMNS], True)
    return _with_file(snapshots.read_snapshots(spark, base, key, _key_type(key), columns))


def raw_metadata(
    spark: SparkSession, base: str, key: str = "release_year", mixed: bool = False
) -> DataFrame:
    """Metadata per release."""
    return _raw(spark, base, key, METADATA_REQUIRED + METADATA_OPTIONAL, mixed)


def raw_markets(
    spark: SparkSession, base: str, key: str = "release_year", mixed: bool = False
) -> DataFrame:
    """Regional rows per group."""
    return _raw(spark, base, key, [*MARKET_COLUMNS, "release_group_id"], mixed)


def _key_type(key: str) -> str:
    return "int" if key == "release_year" else "string"


def cleaned_revenue(raw: DataFrame, to: str = "int") -> DataFrame:
    """Amounts as numbers; ``to='bigint'`` keeps those beyond 32 bits.

    Date and year are the partition columns, which equal the values in the file path,
    so that a filter on either prunes partitions through every layer above.
    """
    return raw.select(
        F.col("Release Group").alias("title"),
        text.money_to_int(F.col("Worldwide"), to).alias("revenue"),
        text.money_to_int(F.col("Domestic"), to).alias("domestic_rev"),
        text.money_to_int(F.col("Foreign"), to).alias("foreign_rev"),
        F.col(snapshots.DATE).alias("loaded_date"),
        "release_year",
    )


def cleaned_metadata(raw: DataFrame, to: str = "int") -> DataFrame:
    """Release metadata with three numeric columns; absent optional columns are null."""
    full = checks.with_optional_columns(raw, METADATA_OPTIONAL)
    numbers = ("opening_amount", "opening_theaters", "widest_release")
    return full.select(
        "release_id",
        *[
            text.safe_int(F.col(c), to).alias(c) if c in numbers else F.col(c)
            for c in METADATA_OPTIONAL
        ],
        "scraped_date",
    )


def cleaned_markets(raw: DataFrame, to: str = "int") -> DataFrame:
    """Regional rows with numeric opening and gross."""
    return raw.select(
        "movie_title",
        "release_group_id",
        "region",
        "market",
        "release_date",
        text.safe_int(F.col("opening"), to).alias("opening"),
        text.safe_int(F.col("total_gross"), to).alias("total_gross"),
        "release_group_url",
        "scraped_date",
    )


def published_revenue(cleaned: DataFrame, run_ts: datetime.datetime | None = None) -> DataFrame:
    """Cleaned revenue, all snapshots, stamped with the UTC time of the run."""
    if run_ts is None:
        stamp = F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    else:
        if run_ts.tzinfo is not None:
            run_ts = run_ts.astimezone(datetime.timezone.utc).replace(tzinfo=None)
        stamp = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return cleaned.select(
        "title",
        "revenue",
        "domestic_rev",
        "foreign_rev",
        "loaded_date",
        "release_year",
        stamp.alias("published_timestamp_utc"),
    )


def models(spark: SparkSession, root: str, run_ts: datetime.datetime | None = None) -> dict:
    """The nine models by ``layer.dataset``, each a function giving a lazy DataFrame."""
    base = f"{root.rstrip('/')}/raw"
    raw = {
        "worldwide_box_office": lambda: raw_revenue(spark, f"{base}/worldwide_box_office"),
        "release_id_lookup": lambda: raw_lookup(spark, f"{base}/release_id_lookup"),
        "release_domestic": lambda: raw_daily_rows(spark, f"{base}/release_domestic"),
        "release_metadata": lambda: raw_metadata(spark, f"{base}/release_metadata"),
        "release_worldwide_snapshot": lambda: raw_markets(
            spark, f"{base}/release_worldwide_snapshot"
        ),
    }
    cleaned = {
        "worldwide_box_office": cleaned_revenue,
        "release_metadata": cleaned_metadata,
        "release_worldwide_snapshot": cleaned_markets,
    }
    found = {f"raw.{name}": build for name, build in raw.items()}
    for name, clean in cleaned.items():
        found[f"cleaned.{name}"] = lambda name=name, clean=clean: clean(raw[name]())
    revenue = found["cleaned.worldwide_box_office"]
    found["published.worldwide_box_office"] = lambda: published_revenue(revenue(), run_ts)
    return found


def refresh_models(
    spark: SparkSession, root: str, names: list[str], run_ts: datetime.datetime | None = None
) -> None:
    """Replace the named models' tables, for readers that want them materialised."""
    known = models(spark, root, run_ts)
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
        refresh_table(known[name](), name)
