"""Hard negatives for anchors and their positives, by slots between the positives' limits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm import blocks
from snapledger.llm.common import discard, ship, staged

ROW_BLOCK = "row_keys array<long>, row_ids array<long>, row_labels array<long>, v array<long>"
ANCHORS = "keys array<long>, labels array<long>, q array<long>"
LIMITS = "uppers array<long>, lowers array<long>"
FOUND = "anchor long, slot int, key long, vec_id long, score long"


def row_block(table: pa.Table) -> pa.Table:
    ids, table = blocks.in_order(table)
    return pa.table(
        blocks.header(table)
        | {
            "row_keys": [table["key"].to_numpy()],
            "row_ids": [ids],
            "row_labels": [table["label"].to_numpy()],
            "v": [table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)],
        }
    )


def anchor_block(table: pa.Table) -> pa.Table:
    return pa.table(
        blocks.header(table)
        | {
            "keys": [table["key"].to_numpy()],
            "labels": [table["label"].to_numpy()],
            "q": [table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)],
        }
    )


def limited_block(table: pa.Table, low: int, high: int, slots: int) -> pa.Table:
    """Anchors with their windows: the score limits of each positive, highest first.

    An anchor of fewer positives gets windows that nothing fits into. Whole numbers
    of Python, as percents of a score may not fit into a long.
    """
    uppers = np.full((len(table), slots), -(1 << 62), np.int64)
    lowers = np.full((len(table), slots), 1 << 62, np.int64)
    for row, scores in enumerate(table["positives"].to_pylist()):
        for slot, score in enumerate(scores):
            uppers[row, slot], lowers[row, slot] = high * score // 100, -(-low * score // 100)
    block = anchor_block(table)
    block = block.append_column("uppers", pa.array([uppers.ravel()], pa.list_(pa.int64())))
    return block.append_column("lowers", pa.array([lowers.ravel()], pa.list_(pa.int64())))


def products(pair: dict) -> np.ndarray:
    """Inner products of all anchors of a pair with all its rows, exactly."""
    q, v = pair["q"].reshape(-1, pair["dim"]), pair["v"].reshape(-1, pair["dim"])
    kind = blocks.exact_kind(blocks.sum_bound(q, blocks.largest(v)))
    return q.astype(kind) @ v.astype(kind).T


def best_rows(pair: dict, score: np.ndarray, allowed: np.ndarray, k: int, slot: int):
    """The k best allowed rows of every anchor of a pair; ties by vec_id."""
    of, at = np.nonzero(blocks.best_mask(score, score, allowed, k))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(pair["keys"][of]),
            pa.array(np.full(len(of), slot, np.int32)),
            pa.array(pair["row_keys"][at]),
            blocks.nullable(pair["row_ids"][at]),
            pa.array(score[of, at].astype(np.int64)),
        ],
        names=["anchor", "slot", "key", "vec_id", "score"],
    )


def same_label(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """For every anchor, its best other rows of the same label in each block."""
    for batch in batches:
        for pair in blocks.each_pair(batch):
            allowed = pair["labels"][:, None] == pair["row_labels"][None, :]
            allowed &= pair["keys"][:, None] != pair["row_keys"][None, :]
            yield best_rows(pair, products(pair), allowed, k, 0)


def slot_tops(batches: Iterator[pa.RecordBatch], k: int, slots: int) -> Iterator[pa.RecordBatch]:
    """For every anchor and slot, the best rows of other labels in each block.

    Slot s holds the scores above the upper limit of positive s + 1 and not above that
    of positive s, the last one all below. Scores below the lowest limit of the windows
    that reach into a slot belong to no window.
    """
    for batch in batches:
        for pair in blocks.each_pair(batch):
            score = products(pair)
            other = pair["labels"][:, None] != pair["row_labels"][None, :]
            uppers = pair["uppers"].reshape(-1, slots)
            lowers = np.minimum.accumulate(pair["lowers"].reshape(-1, slots), axis=1)
            for slot in range(slots):
                within = other & (score <= uppers[:, [slot]]) & (score >= lowers[:, [slot]])
                if slot + 1 < slots:
                    within &= score > uppers[:, [slot + 1]]
                if within.any():
                    yield best_rows(pair, score, within, k, slot)


def first_of(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows of each key over all blocks, as ``rank``; partly before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("key")
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A row's score is its inner product with the anchor, of floor(``scale`` * x) of the
    components; higher scores come first, ties by smaller vec_id, rows without vec_id
    last. Every row of ``is_anchor`` is an anchor; its positives are its first other rows
    of the same ``label`` (a whole number). For each positive p the first rows n of other
    labels with ``low`` * p <= 100 * n <= ``high`` * p are returned, all if there are
    fewer. An anchor without positives, and a positive whose window is empty, as under
    a negative score, have no row.

    Rows with a null label, a null or empty vector, or any null or non-finite component
    take no part, nor do vectors whose products might not fit into a long; only vectors
    of one length are compared. Rows are told apart by a number of their own, so repeated
    rows are other rows, and a repeated anchor is an anchor each time. Other columns are
    ignored; an empty table gives an empty result.

    Anchors are compared with all rows in blocks, twice: for positives, and for negatives.
    The positives' upper limits split scores into disjoint slots. Each block keeps the
    best of every slot, these are combined, and a window is the front of its own and all
    lower slots, down to its lower limit. An anchor has at most ``positives`` *
    ``negatives`` rows after that, whatever its label's share of the table is.
    """
    if high < low or low < 0:
        raise ValueError(f"windows from {low} to {high} percent")
    spark = vectors.sparkSession
    ship(spark)
    rows, rows_path = blocks.whole_vectors(
        vectors.where(label.isNotNull()),
        scale,
        label=label.cast("long"),
        asks=F.coalesce(is_anchor, F.lit(False)),
    )
    sizes, sizes_path = blocks.with_blocks(rows, F.col("asks"))
    all_rows, block_path = staged(
        blocks.packed(rows.drop("asks"), sizes, "row_blocks", row_block, ROW_BLOCK), "row-blocks"
    )
    anchors = rows.where("asks").drop("asks")
    asking = blocks.packed(anchors, sizes, "query_blocks", anchor_block, ANCHORS)
    near = blocks.block_pairs(asking, all_rows).mapInArrow(
        lambda b: same_label(b, positives), FOUND
    )
    chosen, chosen_path = staged(
        first_of(near, ["anchor"], positives).select(
            "anchor",
            (F.col("rank") - 1).alias("place"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    scores = chosen.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("all")
    )
    limited = anchors.join(
        scores.select(F.col("anchor").alias("key"), F.col("all.positive_score").alias("positives")),
        "key",
    )
    windows = blocks.packed(
        limited,
        sizes,
        "query_blocks",
        lambda t: limited_block(t, low, high, positives),
        f"{ANCHORS}, {LIMITS}",
    )
    far = blocks.block_pairs(windows, all_rows).mapInArrow(
        lambda b: slot_tops(b, negatives, positives), FOUND
    )
    tops = (
        first_of(far, ["anchor", "slot"], negatives)
        .groupBy("anchor")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        (-F.col("score")).alias("order"),
                        F.coalesce("vec_id", F.lit(blocks.LAST)).alias("tie"),
                        "key",
                        "slot",
                        "vec_id",
                    )
                )
            ).alias("tops")
        )
    )
    least = F.ceil(F.col("positive_score").cast("decimal(20,0)") * low / 100)
    window = F.filter(
        "tops", lambda t: (t["slot"] >= F.col("place")) & (-t["order"] >= F.col("least"))
    )
    ids = anchors.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    result, _ = staged(
        chosen.withColumn("least", least)
        .join(tops, "anchor")
        .join(ids, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            "positive_score",
            F.posexplode(F.slice(window, 1, negatives)).alias("at", "negative"),
        )
        .select(
            "anchor_id",
            "positive_id",
            (F.col("at") + 1).alias("rank"),
            F.col("negative.vec_id").alias("negative_id"),
            "positive_score",
            (-F.col("negative.order")).alias("negative_score"),
        ),
        "hard-negatives",
    )
    for path in (rows_path, sizes_path, block_path, chosen_path):
        discard(spark, path)
    return result
