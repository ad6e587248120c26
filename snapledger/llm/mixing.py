"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import discard, staged

TOLERANCE, MAX_ROUNDS = 1e-4, 60
# A share of the sample that is further than this from its target is reported.
MISS = 1e-3
# Stands for null, so that rows without a source, language or topic are cells as well.
NONE = "\u0000"


def layout_topic(text: Column) -> Column:
    """A topic by what a text looks like, where no other is known."""
    return (
        F.when(text.isNull() | (F.trim(text) == ""), "empty")
        .when(text.contains("|"), "table")
        .when(text.rlike("(?i)licen[sc]e|copyright"), "notice")
        .when(~text.contains("\n"), "line")
        .when(text.rlike("[0-9]{4}"), "figures")
        .otherwise("prose")
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def tempered(cells: DataFrame, dim: str, alpha: float) -> DataFrame:
    """Target shares of a dimension: those of its tokens to the power ``alpha``."""
    sums = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), alpha).alias("share"))
    whole = sums.agg(F.sum("share")).first()[0] or 1.0
    return sums.select(dim, (F.col("share") / whole).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` (dimensions, ``tokens``) with ``factor``, which fits all targets at once.

    Each dimension has one factor per value. In turn every dimension sets its factors so
    that the weighted tokens of its values have the target shares (``share``), until no
    factor changes by more than ``TOLERANCE``. Values without a target keep no weight. A
    step is one aggregate over the cells with partial sums, joined to the small factor
    tables of the other dimensions; factors are written tables. Targets that no weights
    can meet together leave the factors of the last round.
    """
    spark = cells.sparkSession
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    factors, paths = {}, {}
    for dim, target in targets.items():
        start = target.select(dim, "share", F.lit(1.0).alias("factor"), F.lit(0.0).alias("change"))
        factors[dim], paths[dim] = staged(start, f"factors-{dim}")

    def weighted(skip: str | None) -> tuple[DataFrame, Column]:
        rows, weight = cells, F.lit(1.0)
        for dim in targets:
            if dim != skip:
                rows = rows.join(factors[dim].select(dim, F.col("factor").alias(f"_{dim}")), dim)
                weight = weight * F.col(f"_{dim}")
        return rows, weight

    for _ in range(MAX_ROUNDS):
        most = 0.0
        for dim in targets:
            rows, weight = weighted(dim)
            sums = rows.groupBy(dim).agg(F.sum(F.col("tokens") * weight).alias("got"))
            got = F.coalesce("got", F.lit(0.0))
            value = F.when(got > 0, F.col("share") * total / got).otherwise(0.0)
            new = factors[dim].join(sums, dim, "left").select(
                dim,
                "share",
                value.alias("factor"),
                F.when(value > 0, F.abs(value / F.col("factor") - 1)).otherwise(0.0).alias("change"),
            )
            table, path = staged(new, f"factors-{dim}")
            most = max(most, table.agg(F.max("change")).first()[0] or 0.0)
            discard(spark, paths[dim])
            factors[dim], paths[dim] = table, path
        if most <= TOLERANCE:
            break
    rows, weight = weighted(None)
    return rows.select(*cells.columns, weight.alias("factor"))


def inclusion(cells: DataFrame, share: float) -> DataFrame:
    """``cells`` with ``probability``: a common multiple of the factor, 1 at most.

    The multiple is such that ``share`` of all tokens is expected, as far as cells with
    a factor have so many. Cells that reach 1 leave their part to the others.
    """
    total = cells.agg(F.sum("tokens"), F.sum(F.when(F.col("factor") > 0, F.col("tokens")))).first()
    budget = min(share * (total[0] or 0), float(total[1] or 0))
    multiple = 0.0
    for _ in range(MAX_ROUNDS):
        full = F.col("factor") * multiple >= 1
        sums = cells.agg(
            F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)).cast("double").alias("full"),
            F.coalesce(F.sum(F.when(~full, F.col("tokens") * F.col("factor"))), F.lit(0.0)).alias("rest"),
        ).first()
        if not sums["rest"]:
            break
        better = (budget - sums["full"]) / sums["rest"]
        if better <= multiple * (1 + 1e-12):
            break
        multiple = better
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("factor") * multiple))


def repetition(cells: DataFrame, share: float) -> DataFrame:
    """``cells`` with ``expected``, the copies of a document: a common multiple of the factor.

    ``share`` of all tokens is expected. No cell is held back at one copy, so the sample
    has the shares that the factors have.
    """
    sums = cells.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("factor"))).first()
    multiple = share * (sums[0] or 0) / sums[1] if sums[1] else 0.0
    return cells.withColumn("expected", F.col("factor") * multiple)


def missed(cells: DataFrame, targets: dict[str, DataFrame]) -> list[tuple[str, str, float, float]]:
    """Dimension, value, target and share in the sample (``expected``) of what misses by ``MISS``."""
    whole = cells.agg(F.sum(F.col("tokens") * F.col("expected"))).first()[0]
    if not whole:
        return []
    out = []
    for dim, target in targets.items():
        goals = target.agg(F.sum("share")).first()[0] or 1.0
        sums = cells.groupBy(dim).agg((F.sum(F.col("tokens") * F.col("expected")) / whole).alias("got"))
        rows = target.select(dim, (F.col("share") / goals).alias("share")).join(sums, dim, "left").select(
            dim, "share", F.coalesce("got", F.lit(0.0)).alias("got")
        )
        out += [(dim, *r) for r in rows.where(F.abs(F.col("got") - F.col("share")) > MISS).collect()]
    return out


def raked_sample(
    docs: DataFrame,
    dims: dict[str, Column],
    tokens: Column,
    targets: dict[str, DataFrame] | None = None,
    alpha: float = 0.5,
    share: float = 0.5,
    seed: int = 11,
    repeat: bool = True,
) -> DataFrame:
    """``docs`` with the dimensions, ``factor``, ``probability``, ``kept`` and ``copies``.

    ``dims`` names two or more columns, such as source, language and topic. Token
    weights of their combinations are raked to ``targets`` (a table of value and
    ``share`` for each dimension; by default the token shares to the power ``alpha``),
    and a document is kept with the calibrated probability of its combination,
    decided by a hash of its doc_id (of its text without one), so that repeated rows
    share their fate. Where a combination needs more tokens than it has, its documents
    are wanted more than once: ``copies`` says how often, on average as often as the
    targets ask, and the probability is 1. Without ``repeat`` no document is wanted more
    than once, which misses targets where probabilities end at 1. Targets that are not met
    give a warning. ``share`` of all tokens is expected to be kept. Null values are
    a value of their own; texts without tokens are in no way special; an empty table
    gives an empty result. All columns of ``docs`` are kept as they are: the dimensions
    come with the prefix ``mix_``.
    """
    names = {f"mix_{name}": F.coalesce(value.cast("string"), F.lit(NONE)) for name, value in dims.items()}
    cells, _ = staged(
        docs.select(*[v.alias(n) for n, v in names.items()], tokens.alias("tokens"))
        .groupBy(*names)
        .agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents")),
        "cells",
    )
    if targets:
        goals = {f"mix_{n}": t.withColumnRenamed(n, f"mix_{n}") for n, t in targets.items()}
    else:
        goals = {n: tempered(cells, n, alpha) for n in names}
    raked, _ = staged(rake(cells, goals), "raked")
    if repeat:
        wanted = repetition(raked, share)
    else:
        wanted = inclusion(raked, share).withColumnRenamed("probability", "expected")
    chances, _ = staged(wanted.select(*names, "tokens", "factor", "expected"), "probabilities")
    if misses := missed(chances, goals):
        listed = ", ".join(f"{d[4:]} {v}: {got:.4f} for {goal:.4f}" for d, v, goal, got in misses[:20])
        warnings.warn(f"{len(misses)} targets are not met: {listed}", stacklevel=2)
    chances = chances.drop("tokens")
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    draw = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    rest = [c for c in docs.columns if c.lower() not in ("factor", "probability", "kept", "copies", "expected", *names)]
    drawn = docs.select(*[F.col(f"`{c}`") for c in rest], *[v.alias(n) for n, v in names.items()])
    return (
        drawn.join(chances, list(names), "left")
        .withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("factor", "expected")})
        .withColumn("probability", F.least(F.lit(1.0), "expected"))
        .withColumn("copies", F.floor("expected") + (draw < F.col("expected") % 1).cast("long"))
        .withColumn("kept", F.col("copies") > 0)
        .select(*rest, *names, "factor", "probability", "kept", "copies")
    )
