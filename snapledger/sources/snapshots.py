"""Snapshot tables: Parquet below ``<key>=<value>/scraped_date=<YYYY-MM-DD>/``.

Many small snapshots may be packed by date (``snapledger.sinks.parquet.pack_snapshots``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions import text
from snapledger.session import (
    BROADCAST_BYTES,
    broadcast_if_small,
    from_listing,
    write_stage,
)
from snapledger.sinks import switch

DATE = "scraped_date"

# Below a dataset's folder: its packed snapshots, by date, hidden from scans of the others.
PACKED = "_packed/data"
FILE = "filename"

# How Spark says that a dataset has no files, or none yet.
NO_FILES = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")

# Up to this many (key, date) pairs become literal partition filters.
MAX_LITERAL_PAIRS = 2_000


def read_snapshots(
    spark: SparkSession,
    base: str,
    key: str,
    key_type: str = "int",
    columns: list[str] | str | None = None,
    missing_ok: bool = True,
    source_file: bool = False,
) -> DataFrame:
    """All snapshots of a dataset with their path values as columns.

    With ``columns`` (names of string columns, or DDL) no footer is opened for the
    schema and a file without a column gives null; otherwise the files' schemas are
    merged. The key keeps its type whatever its values look like. A dataset that does
    not exist yet is empty unless ``missing_ok`` is false.

    Packed snapshots are read as if they were not, without those that were written again
    since. ``source_file`` adds the path of the file that a row was written to, which
    packed rows remember.
    """
    packed_at = f"{base.rstrip('/')}/{PACKED}"
    if not switch.names(spark, packed_at):
        rows = _read_loose(spark, base, key, key_type, columns, missing_ok)
        return with_source_file(rows) if source_file else rows
    loose = with_source_file(_read_loose(spark, base, key, key_type, columns, True))
    packed = _read_packed(spark, packed_at, key, key_type, columns)
    # The listing tells what was written again: a few snapshots, or the join shuffles.
    again = broadcast_if_small(from_listing(snapshot_index(loose, key)))
    packed = packed.join(again, [F.col(f"p.{c}").eqNullSafe(again[c]) for c in (key, DATE)], "left_anti")
    rows = loose.unionByName(packed, allowMissingColumns=True)
    # Path values come last, as from a scan of the snapshots themselves.
    last = [key, DATE] + ([FILE] if source_file else [])
    return rows.select(*[f"`{c}`" for c in rows.columns if c not in (key, DATE, FILE)], *last)


def _read_packed(spark: SparkSession, path: str, key: str, key_type: str, columns) -> DataFrame:
    if columns is None:
        rows = spark.read.option("mergeSchema", "true").parquet(path)
        typed = {key: F.col(key).cast(key_type), DATE: F.col(DATE).cast("date")}
        return rows.withColumns(typed).alias("p")
    if not isinstance(columns, str):
        columns = ", ".join(f"`{c}` string" for c in columns)
    fields = [f for f in T.StructType.fromDDL(columns).fields if f.name not in (key, DATE)]
    own = T.StructType.fromDDL(f"`{key}` {key_type}, `{FILE}` string, `{DATE}` date").fields
    return spark.read.schema(T.StructType(fields + own)).parquet(path).alias("p")


def _read_loose(
    spark: SparkSession, base: str, key: str, key_type: str, columns, missing_ok: bool
) -> DataFrame:
    keys = T.StructType.fromDDL(f"`{key}` {key_type}, `{DATE}` date")
    fields = []
    try:
        if columns is None:
            fields = spark.read.option("mergeSchema", "true").parquet(base).schema.fields
        else:
            if not isinstance(columns, str):
                columns = ", ".join(f"`{c}` string" for c in columns)
            fields = T.StructType.fromDDL(columns).fields
        fields = [f for f in fields if f.name not in keys.names] + keys.fields
        return spark.read.schema(T.StructType(fields)).parquet(base)
    except AnalysisException as problem:
        if not missing_ok or problem.getCondition() not in NO_FILES:
            raise
        return spark.createDataFrame([], T.StructType(fields or keys.fields))


def with_source_file(snapshots: DataFrame) -> DataFrame:
    """Add the path of the file each row comes from; null where there are no files."""
    try:
        return snapshots.withColumn("filename", F.col("_metadata.file_path"))
    except AnalysisException:
        return snapshots.withColumn("filename", F.lit(None).cast("string"))


def with_path_values(snapshots: DataFrame, key: str) -> DataFrame:
    """Key text and snapshot timestamp taken from ``filename``."""
    return snapshots.withColumns(
        {
            f"{key}_from_path": text.path_value(F.col("filename"), key),
            f"{DATE}_from_path": text.path_date(F.col("filename"), DATE),
        }
    )


def snapshot_index(snapshots: DataFrame, key: str) -> DataFrame:
    """The ``(key, scraped_date)`` pairs present. Reads partition values only."""
    return snapshots.select(key, DATE).distinct()


def snapshot_keys(snapshots: DataFrame, key: str) -> DataFrame:
    """Distinct whole-number keys that have any snapshot; other values are skipped."""
    number = F.col(key).cast("string").try_cast("int")
    return snapshots.select(number.alias(key)).where(F.col(key).isNotNull()).distinct()


def latest_dates(snapshots: DataFrame, key: str, as_of=None) -> DataFrame:
    """Latest snapshot date per key, not after ``as_of``."""
    dated = snapshots.select(key, DATE).where(
        F.col(key).isNotNull() & (F.col(DATE) <= _last_day(as_of))
    )
    return dated.groupBy(key).agg(F.max(DATE).alias(DATE))


def latest_snapshot(
    snapshots: DataFrame,
    key: str,
    as_of=None,
    max_pairs: int = MAX_LITERAL_PAIRS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of each key's latest snapshot; empty when there is none.

    The date per key comes from the file listing. Few keys become literal
    filters, so only the latest partitions are listed and read. More keys are
    broadcast while their measured size allows it, which prunes at run time; beyond
    that the semi-join shuffles and adaptive execution splits a heavy key.
    """
    latest = from_listing(latest_dates(snapshots, key, as_of))
    pairs = latest.limit(max_pairs + 1).collect()
    if len(pairs) <= max_pairs:
        return snapshots.where(_any_pair(pairs, key))
    _, path = write_stage(latest, "latest")
    latest = snapshots.sparkSession.read.schema(latest.schema).parquet(path)
    latest = latest.where(F.col(DATE) <= _last_day(as_of))
    # A broadcast side with a comparison is what lets Catalyst prune partitions at run
    # time, hence the filter on the staged pairs as well.
    latest = broadcast_if_small(latest, max_bytes)
    return snapshots.join(latest, [key, DATE], "left_semi").select(snapshots.columns)


def _last_day(as_of):
    return F.lit(as_of or "9999-12-31").cast("date")


def _any_pair(pairs, key):
    by_date: dict = {}
    for pair in pairs:
        by_date.setdefault(pair[DATE], []).append(pair[key])
    tests = [
        (F.col(DATE) == F.lit(date)) & F.col(key).isin(sorted(keys))
        for date, keys in sorted(by_date.items())
    ]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def files_matching(spark: SparkSession, base: str, pattern: str) -> DataFrame:
    """Files under one path pattern, with the path values below ``base`` as columns."""
    return spark.read.option("basePath", base).parquet(f"{base.rstrip('/')}/{pattern}")


