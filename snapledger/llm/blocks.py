"""Integer vectors in bounded blocks, for a query set against all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import staged
from snapledger.session import broadcast_if_small

# Components of one block, and the rows it has at most on average.
VALUES = 1 << 20
QUERY_ROWS = 1024
ROWS = 4096
# A squared norm below this keeps every inner product within a long.
LARGEST = float(1 << 62)
# Sort key of rows without id: behind all others.
LAST = np.iinfo(np.int64).max


def whole_vectors(vectors: DataFrame, scale: int, **extra: Column) -> tuple[DataFrame, str]:
    """``key, vec_id, dim, v`` and ``extra`` of the rows that take part, staged.

    ``v`` has floor(scale * x) of every component x taken as double. Vectors that are
    null, empty or hold null or non-finite components take no part, nor do those whose
    products might not fit into a long (a squared norm of 2**62). ``key`` is the row's
    own number, whatever its vec_id.
    """
    vec = F.col("embedding").cast("array<double>")
    sound = (F.size(vec) > 0) & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    norm = F.aggregate(vec, F.lit(0.0), lambda s, x: s + F.pow(F.abs(x) * scale + 1, F.lit(2.0)))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        *[column.alias(name) for name, column in extra.items()],
        vec.alias("vec"),
    )
    took = rows.where(F.coalesce(sound, F.lit(False))).where(norm < LARGEST)
    return staged(
        took.select(
            F.monotonically_increasing_id().alias("key"),
            "vec_id",
            *extra,
            F.size("vec").alias("dim"),
            F.transform("vec", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"),
        ),
        "whole-vectors",
    )


def with_blocks(rows: DataFrame, is_query: Column) -> tuple[DataFrame, str]:
    """``dim, query_blocks, row_blocks``: how many blocks each length of vectors needs."""

    def blocks(count: str, most: int) -> Column:
        room = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(VALUES) / F.col("dim"))))
        return F.ceil(F.col(count) / room).cast("int")

    counted = rows.groupBy("dim").agg(
        F.count("*").alias("rows"), F.count(F.when(is_query, 1)).alias("queries")
    )
    return staged(
        counted.where("queries > 0").select(
            "dim",
            blocks("queries", QUERY_ROWS).alias("query_blocks"),
            blocks("rows", ROWS).alias("row_blocks"),
        ),
        "blocks",
    )


def packed(rows: DataFrame, sizes: DataFrame, blocks: str, pack, schema: str) -> DataFrame:
    """One row for each block of ``rows``: what ``pack`` makes of the block's table.

    A row's block follows from its key alone, so that equal vectors and heavy ids or
    labels are spread like any others.
    """
    numbered = rows.join(broadcast_if_small(sizes), "dim").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col(blocks)).cast("int")
    )
    return numbered.groupBy("dim", "block", "query_blocks", "row_blocks").applyInArrow(
        pack, f"dim int, block int, query_blocks int, row_blocks int, {schema}"
    )


def block_pairs(queries: DataFrame, rows: DataFrame) -> DataFrame:
    """Every block of queries beside every block of rows of its length, as one row each.

    The two sides meet by the numbers of both blocks, so that the pairs are spread over
    all tasks and none holds more than two blocks at a time. They are always shuffled:
    Spark takes a side for no larger than before its copies were made, and would send all
    of them, as many as there are pairs, through the driver as a broadcast.
    """
    key = ["dim", "query_block", "row_block"]
    ask = queries.withColumnRenamed("block", "query_block").withColumn(
        "row_block", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1))
    )
    have = rows.withColumnRenamed("block", "row_block").withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))
    )
    return ask.drop("query_blocks", "row_blocks").join(
        have.drop("query_blocks", "row_blocks").hint("merge"), key
    )


def in_order(table: pa.Table) -> tuple[np.ndarray, pa.Table]:
    """The rows of a block by vec_id, rows without one last; also their sort keys."""
    ids = table["vec_id"].combine_chunks().fill_null(LAST).to_numpy(zero_copy_only=False)
    order = np.lexsort((table["key"].to_numpy(), ids))
    return ids[order], table.take(pa.array(order))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def header(table: pa.Table) -> dict:
    """The grouping columns of a block, as they go into its one row."""
    return {
        name: pa.array([table[name][0].as_py()], pa.int32())
        for name in ("dim", "block", "query_blocks", "row_blocks")
    }


def each_pair(batch: pa.RecordBatch) -> Iterator[dict]:
    """The block pairs of a batch, with lists and cells as arrays of numpy."""
    for at in range(batch.num_rows):
        pair = {}
        for name in batch.schema.names:
            value = batch[name][at]
            if pa.types.is_list(value.type):
                pair[name] = value.values.to_numpy(zero_copy_only=False)
            elif pa.types.is_binary(value.type):
                pair[name] = np.frombuffer(value.as_py(), np.uint8)
            else:
                pair[name] = value.as_py()
        yield pair


def exact_kind(*bounds: int):
    """The fastest number type that holds all sums up to these bounds exactly."""
    most = max(bounds)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def largest(values: np.ndarray) -> int:
    return max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0


def sum_bound(queries: np.ndarray, most: int) -> int:
    """No sum of products of a query with components up to ``most`` goes beyond this."""
    dim, top = queries.shape[1], largest(queries)
    if top * dim >= 1 << 62:
        return top * dim * most
    return int(np.abs(queries).sum(axis=1).max(initial=0)) * most


def best_mask(low: np.ndarray, high: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Rows (columns of the matrix, by vec_id) that may be among the k best of each query.

    ``low`` and ``high`` bound the scores. Left out is what is certainly behind k others:
    a row whose upper bound is below the k-th best lower bound, or equal to it and behind
    the row of that bound in the order of ids.
    """
    if low.shape[1] <= k:
        return allowed
    # A sentinel below every bound takes the place of rows that are not allowed.
    none = -np.inf if low.dtype != object else -(1 << 80)
    low = np.where(allowed, low, none)
    kth = np.partition(low, -k, axis=1)[:, -k][:, None]
    enough = (kth > none).ravel()
    mask = allowed & (high >= kth)
    at = np.flatnonzero(enough & (mask.sum(axis=1) > k))
    if len(at):
        equal = low[at] == kth[at]
        better = (low[at] > kth[at]).sum(axis=1)
        place = (np.cumsum(equal, axis=1) == (k - better)[:, None]).argmax(axis=1)
        behind = np.arange(low.shape[1])[None, :] > place[:, None]
        mask[at] &= ~((high[at] == kth[at]) & behind)
    return mask


def nullable(ids: np.ndarray) -> pa.Array:
    """Sort keys as ids again, null for rows without one."""
    return pa.array(ids, pa.int64(), mask=ids == LAST)
