"""Packing token sequences by best fit decreasing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import ship, staged
from snapledger.llm.pretokens import SLICE_BYTES, encoder, slices

WINDOW = 1024
# Pieces that are ranked together; more pieces make more groups, not larger ones.
GROUP = 10_000

# Text that a Python worker gets at once: what it cuts a batch into, with room for a last row.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": f"{SLICE_BYTES * 9 // 10}b"}

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
RUNS = "_size long, _low long, _end long, _first long, _per long, _offset long"


def cut(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 0) -> DataFrame:
    """Every document as pieces of at most ``window`` ids, all full but the last.

    ``ids`` holds unsigned 32-bit little-endian integers. A document is the ids of its
    whole text (none for a null or empty one) and ``end_id``, so each has a piece.
    """

    ship(docs.sparkSession)

    def pieces(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                ids, sizes = encoder(tokenizer).encode(part["text"])
                total = sizes + 1
                whole = np.full(len(ids) + len(sizes), end_id, "<u4")
                inside = np.ones(len(whole), bool)
                inside[np.cumsum(total) - 1] = False
                whole[inside] = ids
                count = -(-total // window)
                doc = np.repeat(np.arange(len(total)), count)
                at = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * window
                length = np.minimum(total[doc] - at, window)
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64) * 4
                binary = pa.Array.from_buffers(
                    pa.large_binary(),
                    len(doc),
                    [None, pa.py_buffer(ends), pa.py_buffer(whole)],
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"].take(pa.array(doc)),
                        *map(pa.array, (at, length, total[doc])),
                        binary,
                    ],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(pieces, PIECES)


class OpenWindows:
    """Segment tree over remaining capacities: the smallest one in use from a size on."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.used = [False] * (2 * self.leaves)

    def mark(self, capacity: int, used: bool) -> None:
        node = self.leaves + capacity
        self.used[node] = used
        while node > 1:
            node //= 2
            self.used[node] = self.used[2 * node] or self.used[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        node = self.leaves + size
        if self.used[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.used[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.used[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan_windows(counts: dict[int, int], window: int = WINDOW) -> list[tuple]:
    """Where best fit decreasing puts so many pieces of each size.

    Pieces of one size are interchangeable, so the plan names runs of ranks and runs of
    windows: (size, first rank, end rank, first window, pieces per window, offset).
    Piece r of a run goes to window ``first window + (r - first rank) // per``, behind
    the ones before it. Consecutive pieces of a size fill the tightest window as often
    as they fit, which is what placing them one by one does. The plan's length depends
    on the number of sizes, not on the number of pieces.
    """
    open_windows, runs = OpenWindows(window), {}
    plan, made = [], 0

    def add(capacity: int, first: int, n: int) -> None:
        if capacity and n:
            if not runs.get(capacity):
                runs[capacity] = []
                open_windows.mark(capacity, True)
            runs[capacity].append((first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            capacity = open_windows.tightest(size)
            if capacity is None:
                capacity, first = window, made
                n = -(-left // (window // size))
                made += n
            else:
                first, n = runs[capacity].pop()
                if not runs[capacity]:
                    open_windows.mark(capacity, False)
            per = capacity // size
            taken = min(left, per * n)
            plan.append((size, rank, rank + taken, first, per, window - capacity))
            full, rest = divmod(taken, per)
            add(capacity - per * size, first, full)
            if rest:
                add(capacity - rest * size, first + full, 1)
            add(capacity, first + full + bool(rest), n - full - bool(rest))
            rank, left = rank + taken, left - taken
    return plan


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: their windows and places in them.

    Full pieces are windows of their own. The others are placed over the whole table by
    best fit decreasing: only the number of pieces of each size goes to the driver, at
    most ``window`` numbers, and the plan comes back. A piece's rank within its size is
    its rank within a group of pieces and the number of that size in earlier groups, so
    one very frequent size is ranked by many tasks. All other columns are kept.
    """
    rows, _ = staged(
        pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces", "zstd", BATCHES
    )
    full, rest = rows.where(F.col("length") >= window), rows.where(F.col("length") < window)
    groups = max(1, rest.count() // GROUP)
    rest = rest.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    sizes = rest.groupBy("_group", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = sizes.select(
        "_group", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_earlier")
    )
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_windows(counts, window)
    made = max((first + -(-(end - low) // per) for _, low, end, first, per, _ in plan), default=0)
    order = Window.partitionBy("_group", "length").orderBy("_row")
    ranked = rest.withColumn("_rank", F.row_number().over(order) - 1).join(
        earlier, ["_group", "length"]
    )
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_earlier"))
    # A rank is in one run of its size, and a size has few runs.
    runs = F.broadcast(pieces.sparkSession.createDataFrame(plan, RUNS))
    run = (F.col("length") == F.col("_size")) & F.col("_rank").between(F.col("_low"), F.col("_end") - 1)
    return (
        ranked.join(runs, run)
        .withColumn("_nth", F.col("_rank") - F.col("_low"))
        .select(
            *pieces.columns,
            F.expr("_first + _nth div _per").alias("sequence_id"),
            (F.col("_offset") + F.col("_nth") % F.col("_per") * F.col("length")).alias("offset"),
        )
        .unionByName(
            full.select(
                *pieces.columns,
                (F.col("_row") + made).alias("sequence_id"),
                F.lit(0).cast("long").alias("offset"),
            )
        )
    )


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 0) -> DataFrame:
    """Every piece of every document with its ids and its place in a packed sequence.

    The columns are those of ``cut``, ``sequence_id`` and ``offset``. A sequence holds
    up to ``window`` ids without gaps from 0; what remains is padding. Each id of each
    document lies in one piece. Repeated rows are packed each; an empty table gives an
    empty result; other columns are not looked at.
    """
    return place(cut(docs, tokenizer, window, end_id), window)


def sequences(placed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """One row per sequence: ``ids`` (binary, padded to ``window``) and ``used``."""
    pad = int(pad_id).to_bytes(4, "little")
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(
        "parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"])
    )
    return (
        placed.groupBy("sequence_id")
        .agg(parts.alias("parts"), F.sum("length").alias("used"))
        .select("sequence_id", "used", F.rpad(joined, 4 * window, F.lit(pad)).alias("ids"))
    )
