"""Exact top-k search with vector-approximation files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm import blocks
from snapledger.llm.common import discard, ship, staged

# Cells of one component; a cell number takes a byte at most.
CELLS = 64

QUERY = "keys array<long>, ids array<long>, q array<long>"
CELL_BLOCK = "row_keys array<long>, row_ids array<long>, cells binary, lows array<long>, highs array<long>"
BOUNDS = "query long, query_id long, key long, vec_id long, low long, high long"


def cell_edges(values: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of up to ``cells`` cells that hold as many rows each."""
    known = np.unique(values)
    if len(known) > cells:
        cuts = np.sort(values)[np.arange(cells) * len(values) // cells]
        lows = np.unique(cuts)
        return lows, known[np.append(np.searchsorted(known, lows[1:]), len(known)) - 1]
    return known, known


def approximate(table: pa.Table, cells: int = CELLS) -> pa.Table:
    """The cells of all vectors of a block, with the edges of every component's cells."""
    ids, table = blocks.in_order(table)
    dim = int(table["dim"][0].as_py())
    v = blocks.matrix(table["v"], dim)
    found = np.zeros(v.shape, np.uint8)
    lows, highs = np.zeros((dim, cells), np.int64), np.zeros((dim, cells), np.int64)
    for d in range(dim):
        low, high = cell_edges(v[:, d], cells)
        found[:, d] = np.searchsorted(low, v[:, d], side="right") - 1
        lows[d, : len(low)], highs[d, : len(low)] = low, high
    return pa.table(
        blocks.header(table)
        | {
            "row_keys": [table["key"].to_numpy()],
            "row_ids": [ids],
            "cells": pa.array([found.tobytes()], pa.binary()),
            "lows": [lows.ravel()],
            "highs": [highs.ravel()],
        }
    )


def query_block(table: pa.Table) -> pa.Table:
    ids, table = blocks.in_order(table)
    v = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return pa.table(
        blocks.header(table)
        | {"keys": [table["key"].to_numpy()], "ids": [ids], "q": [v]}
    )


def scan(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Bounds of the products of each query with a block's rows, from their cells alone.

    Twice the product with a cell's middle, give or take the query's size times the
    cell's width, is a product of whole numbers, so the bounds are exact. Only rows that
    may be among the block's k best go on.
    """
    for batch in batches:
        for pair in blocks.each_pair(batch):
            dim = pair["dim"]
            q, cells = pair["q"].reshape(-1, dim), pair["cells"].reshape(-1, dim)
            lows, highs = pair["lows"].reshape(dim, -1), pair["highs"].reshape(dim, -1)
            most = 2 * max(blocks.largest(lows), blocks.largest(highs))
            kind = blocks.exact_kind(2 * blocks.sum_bound(q, most))
            each = np.arange(dim)
            low, high = lows.astype(kind)[each, cells], highs.astype(kind)[each, cells]
            middle = q.astype(kind) @ (low + high).T
            spread = np.abs(q.astype(kind)) @ (high - low).T
            high, low = middle + spread, middle - spread
            keys, row_keys = pair["keys"], pair["row_keys"]
            mask = blocks.best_mask(low, high, keys[:, None] != row_keys[None, :], k)
            of, at = np.nonzero(mask)
            # Scores stay below 2**62, so that bounds beyond it say no more than that.
            clipped = [
                np.clip(side[mask] // 2, -(1 << 62), 1 << 62).astype(np.int64)
                for side in (low, high)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[of]),
                    blocks.nullable(pair["ids"][of]),
                    pa.array(row_keys[at]),
                    blocks.nullable(pair["row_ids"][at]),
                    *map(pa.array, clipped),
                ],
                names=["query", "query_id", "key", "vec_id", "low", "high"],
            )


def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores from the vectors themselves; sums of longs are exact as the score fits one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (batch[n].flatten().to_numpy(zero_copy_only=False) for n in ("q", "v"))
        lengths = np.asarray(batch["dim"])
        with np.errstate(over="ignore"):
            ends = np.concatenate([[0], np.cumsum(a * b)])
        upto = np.cumsum(lengths)
        score = ends[upto] - ends[upto - lengths]
        yield pa.RecordBatch.from_arrays(
            [*(batch[n] for n in ("query", "query_id", "vec_id")), pa.array(score)],
            names=["query", "query_id", "vec_id", "score"],
        )


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, cells: int = CELLS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows for every query, exactly.

    The score is the inner product of floor(``scale`` * x) of the components; higher ones
    come first, ties by smaller vec_id, rows without vec_id last. Every row but the
    query's own is a candidate, also other rows of the same vec_id; fewer than k
    candidates are all returned. Only vectors of one length are compared. Vectors that
    are null, empty or hold null or non-finite components take no part, nor do those
    whose products might not fit into a long; an empty table gives an empty result.
    Other columns are ignored. Repeated rows and repeated queries count one by one.

    The file has a block of cells for some thousand vectors each, with cell edges of its
    own, so one extreme vector widens the cells of its block alone. The scan compares
    blocks of queries with blocks of cells, and keeps rows whose upper bound reaches the
    k-th best lower bound. Vectors are then read in the order of upper bounds, twice as
    many each round, until no unread row can reach the k-th score of its query.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows, rows_path = blocks.whole_vectors(vectors, scale, asks=F.coalesce(is_query, F.lit(False)))
    sizes, sizes_path = blocks.with_blocks(rows, F.col("asks"))
    file, file_path = staged(
        blocks.packed(
            rows.drop("asks"), sizes, "row_blocks", lambda t: approximate(t, cells), CELL_BLOCK
        ),
        "cells",
    )
    queries = blocks.packed(
        rows.where("asks").drop("asks"), sizes, "query_blocks", query_block, QUERY
    )
    pairs = blocks.block_pairs(queries, file)
    found, found_path = staged(pairs.mapInArrow(lambda b: scan(b, k), BOUNDS), "bounds")
    tie = F.coalesce("vec_id", F.lit(blocks.LAST))
    by_low = Window.partitionBy("query").orderBy(F.desc("low"), F.asc("tie"))
    by_high = Window.partitionBy("query").orderBy(F.desc("high"), F.asc("tie"))
    all_of = Window.partitionBy("query")
    reach = _reaches(F.col("high"), F.col("tie"), F.col("kth"), F.col("kth_tie"))
    waiting, path = staged(
        found.withColumn("tie", tie)
        .withColumn("n", F.row_number().over(by_low))
        .withColumn("kth", F.max(F.when(F.col("n") == k, F.col("low"))).over(all_of))
        .withColumn("kth_tie", F.max(F.when(F.col("n") == k, F.col("tie"))).over(all_of))
        .where(reach)
        .withColumn("place", F.row_number().over(by_high))
        .select("query", "query_id", "key", "vec_id", "high", "tie", "place"),
        "in-order",
    )
    paths = [rows_path, sizes_path, file_path, found_path, path]
    vector = rows.select("key", "dim", "v")
    asked = rows.where("asks").select(F.col("key").alias("query"), F.col("v").alias("q"))
    best = spark.createDataFrame([], "query long, query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("tie"))
    read, step = 0, 2 * k
    while True:
        scored = (
            waiting.where((F.col("place") > read) & (F.col("place") <= read + step))
            .join(vector, "key")
            .join(asked, "query")
            .select("query", "query_id", "vec_id", "dim", "q", "v")
            .mapInArrow(exact, best.schema)
        )
        best, best_path = staged(
            best.unionByName(scored)
            .withColumn("tie", tie)
            .withColumn("rank", F.row_number().over(ranked))
            .where(F.col("rank") <= k)
            .drop("tie"),
            "best",
        )
        read, step = read + step, step * 2
        certain = best.where(F.col("rank") == k).select(
            "query", F.col("score").alias("kth"), tie.alias("kth_tie")
        )
        unread = waiting.where(F.col("place") > read).join(certain, "query", "left").where(reach)
        waiting, path = staged(unread.select(waiting.columns), "unread")
        paths.append(path)
        if waiting.isEmpty():
            break
        paths.append(best_path)
        best = best.drop("rank")
    for path in paths:
        discard(spark, path)
    return best.select("query_id", "rank", "vec_id", "score")


def _reaches(high: Column, tie: Column, kth: Column, kth_tie: Column) -> Column:
    """Whether a row of this upper bound can still be among the k best."""
    return kth.isNull() | (high > kth) | ((high == kth) & (tie <= kth_tie))
