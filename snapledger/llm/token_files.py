"""Token ids on disk as patched frame-of-reference blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapledger.llm.common import ship
from snapledger.llm.pretokens import encoder, gather, slices

BLOCK = 256
PERCENTILE = 90
# Ids of a segment, after which it ends with the document at hand.
SEGMENT = 1 << 18
# Pieces of a generation that a worker remembers.
PIECES = 500_000
MAGIC = 0x31524650
WIDTHS = ((8, "<u1"), (16, "<u2"), (32, "<u4"))


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids (unsigned 32-bit) as blocks of ``BLOCK``.

    Header: magic, number of ids, number of blocks. Then for each block its base (the
    smallest id), its bit width, the end of its packed bytes and the end of its
    exceptions; then the packed low bits; then positions and high bits of exceptions.
    The width is what the differences to the base need up to a percentile; wider ones
    are exceptions.
    """
    n = len(ids)
    blocks = -(-n // BLOCK)
    filled = np.empty(blocks * BLOCK, np.uint32)
    filled[:n] = ids
    filled[n:] = ids[-1] if n else 0
    grid = filled.reshape(blocks, BLOCK)
    base = grid.min(axis=1) if blocks else np.zeros(0, np.uint32)
    rest = grid - base[:, None]
    cut = BLOCK * PERCENTILE // 100 - 1
    usual = np.partition(rest, cut, axis=1)[:, cut] if blocks else base
    width = np.frexp(usual.astype(np.float64))[1].astype(np.int64)
    high = (rest.astype(np.uint64) >> width.astype(np.uint64)[:, None]).astype(np.uint32)
    exceptions = high != 0
    per_block = width * (BLOCK // 8)
    ends = np.cumsum(per_block)
    packed = np.zeros(int(per_block.sum()), np.uint8)
    for w in np.unique(width):
        if not w:
            continue
        bits, kind = next(x for x in WIDTHS if x[0] >= w)
        rows = np.flatnonzero(width == w)
        low = (rest[rows] & np.uint32((1 << int(w)) - 1)).astype(kind).view(np.uint8)
        flat = np.unpackbits(low.reshape(-1, bits // 8), axis=1, bitorder="little")[:, :w]
        out = np.packbits(flat.reshape(len(rows), -1), axis=1, bitorder="little")
        places = (ends[rows] - per_block[rows])[:, None] + np.arange(out.shape[1])
        packed[places] = out
    where = np.nonzero(exceptions)
    head = np.array([MAGIC, n, blocks], "<u4").tobytes()
    index = b"".join(
        x.astype(kind).tobytes()
        for x, kind in (
            (base, "<u4"),
            (width, "<u1"),
            (ends, "<u4"),
            (np.cumsum(exceptions.sum(axis=1)), "<u4"),
        )
    )
    return b"".join(
        [head, index, packed.tobytes(), where[1].astype("<u1").tobytes(), high[where].astype("<u4").tobytes()]
    )


def unpack_ids(data: bytes) -> np.ndarray:
    """The ids that ``pack_ids`` was given."""
    magic, n, blocks = np.frombuffer(data, "<u4", 3)
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    n, blocks, at = int(n), int(blocks), 12

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += found.nbytes
        return found

    base, width = take("<u4", blocks), take("<u1", blocks).astype(np.int64)
    ends, last = take("<u4", blocks).astype(np.int64), take("<u4", blocks).astype(np.int64)
    packed = take("<u1", int(ends[-1]) if blocks else 0)
    count = int(last[-1]) if blocks else 0
    position, high = take("<u1", count), take("<u4", count)
    rest = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width):
        if not w:
            continue
        bits, kind = next(x for x in WIDTHS if x[0] >= w)
        rows = np.flatnonzero(width == w)
        size = int(w) * (BLOCK // 8)
        part = packed[(ends[rows] - size)[:, None] + np.arange(size)]
        flat = np.unpackbits(part, axis=1, bitorder="little").reshape(-1, w)
        wide = np.zeros((len(flat), bits), np.uint8)
        wide[:, :w] = flat
        rest[rows] = np.packbits(wide, axis=1, bitorder="little").view(kind).reshape(-1, BLOCK)
    block = np.repeat(np.arange(blocks), np.diff(last, prepend=0))
    rest[block, position] |= (high.astype(np.uint64) << width[block].astype(np.uint64)).astype(np.uint32)
    return (rest + base[:, None]).ravel()[:n]


SEGMENTS = (
    "shard int, segment int, start long, doc_ids array<long>, lengths array<long>, data binary"
)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Write the ids of all whole texts below ``path`` in ascending order of doc_id.

    Documents are ordered by ranges of doc_id (null first); each task writes one shard,
    a run of segments of about ``SEGMENT`` ids that end with a document. A row of the
    files is a segment: its shard, its number, the ids of the shard before it, the
    documents with their lengths, and the packed blocks. ``end_id`` closes each
    document, so none is empty, not that of a null text. Rows of one doc_id are written
    in the order of a hash of their text, those alike one after another, and may be many
    shards. A text of any length is one document of one segment. Other columns are not
    looked at; an empty table writes no segment.
    """

    ship(docs.sparkSession)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, start = TaskContext.get().partitionId(), 0, 0
        names, sizes, parts, held = [], [], [], 0

        def close():
            nonlocal number, start, names, sizes, parts, held
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([pack_ids(np.concatenate(parts))], pa.binary()),
                ],
                names=["shard", "segment", "start", "doc_ids", "lengths", "data"],
            )
            number, start = number + 1, start + held
            names, sizes, parts, held = [], [], [], 0
            return row

        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = encoder(tokenizer, PIECES).encode(part["text"])
                total = counts + 1
                ends = np.cumsum(total)
                whole = np.empty(len(ids) + len(counts), np.uint32)
                whole[gather(ends - total, counts)] = ids
                whole[ends - 1] = end_id
                docs_here, first = part["doc_id"].to_pylist(), 0
                while first < len(total):
                    begin = int(ends[first - 1]) if first else 0
                    last = int(np.searchsorted(ends, begin + SEGMENT - held)) + 1
                    last = min(last, len(total))
                    names += docs_here[first:last]
                    sizes += total[first:last].tolist()
                    parts.append(whole[begin : int(ends[last - 1])])
                    held += len(parts[-1])
                    first = last
                    if held >= SEGMENT:
                        yield close()
        if held:
            yield close()

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    # Rows without doc_id, of one doc_id or all alike may be very many: they are cut as well.
    order = ["doc_id", "hash", "number"]
    (
        docs.select(F.col("doc_id").cast("long"), text)
        .withColumns({"hash": F.xxhash64("text"), "number": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(segments, SEGMENTS)
        .write.option("compression", "none")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of written files: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (binary).

    ``start`` counts the ids of all documents before; only one number per shard is
    summed up in a single task. Repeated rows and rows without doc_id come back as they
    were written, and files of an empty table give no row.
    """

    ship(spark)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = unpack_ids(batch["data"][i].as_py()).astype("<u4")
                sizes = batch["lengths"][i].values.to_numpy()
                ends = np.concatenate([[0], np.cumsum(sizes)])
                if ends[-1] != len(ids):
                    raise ValueError("a segment has other ids than its documents")
                binary = pa.Array.from_buffers(
                    pa.large_binary(), len(sizes), [None, pa.py_buffer(ends * 4), pa.py_buffer(ids)]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), batch["shard"][i].as_py()), pa.int32()),
                        batch["doc_ids"][i].values,
                        pa.array(batch["start"][i].as_py() + ends[:-1]),
                        pa.array(sizes),
                        binary,
                    ],
                    names=["shard", "doc_id", "start", "n_tokens", "ids"],
                )

    rows = spark.read.schema(SEGMENTS).parquet(path)
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    shards = rows.groupBy("shard").agg(F.sum(total).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    found = rows.mapInArrow(
        documents, "shard int, doc_id long, start long, n_tokens long, ids binary"
    )
    # One small row per task of the writing job.
    return found.join(F.broadcast(offsets), "shard").select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids"
    )
