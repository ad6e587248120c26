"""What the operators share: staged tables and connected components."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

import snapledger
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.session import discard
from snapledger.session import write_stage as staged

__all__ = ["components", "discard", "hex64", "ship", "staged", "table"]

MAX_ROUNDS = 200
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once per application.

    The archive is made on the driver and served by Spark like any added file.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        package = Path(snapledger.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / package.name
        made = shutil.make_archive(str(archive), "zip", package.parent, package.name)
        context.addPyFile(made)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex64(value) -> F.Column:
    """A long as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (``a``, ``b``: long) as ``id``, ``component``.

    Every id that occurs in an edge gets the smallest id that it reaches. Large-star and
    small-star rounds rewire each id to its smallest known neighbour until nothing
    changes; no round builds the neighbour list of an id, so an id with very many
    edges is only a minimum and a join that adaptive execution may split. Rounds are
    written tables. Null ids and loops add nothing but the loop's own id.
    """
    spark = edges.sparkSession
    links = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull()
    )
    links, first = staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state, path, mark = links.where("a <> b"), first, None
    for _ in range(MAX_ROUNDS):
        both = state.unionAll(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        large, large_path = staged(
            state.select(F.col("b").alias("u"), F.col("a").alias("v"))
            .join(least.select(F.col("a").alias("u"), F.least("a", "low").alias("low")), "u")
            .select(F.col("v").alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .distinct(),
            "large-star",
        )
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(least, "a")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("a"), F.col("low").alias("b")),
                        F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                    )
                ).alias("e")
            )
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        state, path_now = staged(small, "small-star")
        discard(spark, large_path)
        if path != first:
            discard(spark, path)
        path = path_now
        seen = state.agg(
            F.count("*").alias("n"),
            F.expr("bit_xor(xxhash64(a, b))").alias("x"),
            F.sum("b").alias("s"),
        ).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
    ids = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # In a settled state every id but the smallest of its component has one edge, to it.
    return ids.join(state.select(F.col("a").alias("id"), "b"), "id", "left").select(
        "id", F.coalesce("b", "id").alias("component")
    )
