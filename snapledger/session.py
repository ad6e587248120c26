"""Session helpers: shared scratch space, staging, and size-checked broadcast."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest build side that is broadcast; anything bigger is joined by shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024
# What a broadcast table of rows by key has for a row besides its values: key, lengths, slots.
ROW_BYTES = 96


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors can reach.

    It is the one named by ``spark.checkpoint.dir`` or given to the context as its
    checkpoint folder. There is no other: a folder of one machine would lose rows.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused directory below the shared folder."""
    return f"{shared_folder(spark)}/snapledger/{label}-{uuid.uuid4().hex}"


def write_stage(
    df: DataFrame, label: str, codec: str = "snappy", settings: dict[str, str] | None = None
) -> tuple[DataFrame, str]:
    """``df`` written once and read back, with its path.

    A written table is computed once for several outputs, cuts the lineage, and
    survives lost executors, which cached blocks do not. ``settings`` hold for the
    writing alone.
    """
    path = scratch_path(df.sparkSession, label)
    source = under_settings(df, settings) if settings else df
    source.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back."""
    return write_stage(df, label)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more, on whatever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def row_bytes(df: DataFrame):
    """Column with the approximate size of a row once it is broadcast.

    Texts, binaries and nested values are measured. Of a narrow row most is what the table
    of rows by key adds to it.
    """
    size = F.lit(ROW_BYTES + 16 * len(df.columns))
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith(("array", "struct", "map", "variant")):
            column = F.to_json(F.struct(column))
        elif kind not in ("string", "binary"):
            continue
        size = size + F.coalesce(F.octet_length(column), F.lit(0))
    return size.cast("long")


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """The measured size of ``df`` is within ``max_bytes``; it is aggregated once for that."""
    measured = df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return measured["bytes"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the measured size of ``df`` is within ``max_bytes``.

    ``df`` is aggregated once to measure it, so pass a staged or stored table of
    keys. Beyond the bound the frame is returned as it is, and the join shuffles unless
    Spark takes its files for small: see ``join_side``.
    """
    return F.broadcast(df) if is_small(df, max_bytes) else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of an equi-join that is shuffled, whatever Spark takes its size for.

    Left to itself Spark broadcasts a table by the size of its files or columns in files,
    where texts and ids may have a tenth of the memory that they take on the driver.
    """
    return df.hint("merge")


def join_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` as a side of an equi-join: broadcast within its measured size, else shuffled.

    As ``broadcast_if_small``, but beyond the bound Spark does not broadcast it either.
    """
    return F.broadcast(df) if is_small(df, max_bytes) else shuffled(df)


def with_settings(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session like ``spark`` with other settings; those of ``spark`` stay as they are.

    It shares the application, the catalog and the cache.
    """
    other = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for key, value in settings.items():
        other.conf.set(key, value)
    return other


def from_listing(df: DataFrame) -> DataFrame:
    """``df``, distinct or largest partition values, answered by the listing of its files.

    The driver holds the listing of a scan anyway, so such a query needs no task at
    all instead of one per piece of every data file. A partition whose files are
    empty then counts as present, which for snapshots is what is wanted. The query gets
    a session of its own, so that no other query of the caller's session is affected.
    """
    return under_settings(df, {"spark.sql.optimizer.metadataOnly": "true"})


def under_settings(df: DataFrame, settings: dict[str, str]) -> DataFrame:
    """``df`` as a query of a session like its own with other settings."""
    other = with_settings(df.sparkSession, settings)
    plan = df._jdf.queryExecution().analyzed()
    dataset = other._jvm.org.apache.spark.sql.classic.Dataset.ofRows(other._jsparkSession, plan)
    return DataFrame(dataset, other)
