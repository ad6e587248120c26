"""Near-duplicate embeddings by binary codes of random rotations."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import components, discard, ship, staged

SEED = 20240501
# Chance that one pair at the threshold meets in no table.
MISS = 1e-4
# Width of the confidence bound, in standard errors of the estimate.
EPSILON = 4.0
# Members of one block of a bucket; two blocks are compared in one task.
BLOCK = 512


def plan_tables(rows: int, threshold: float) -> tuple[int, int]:
    """Bits per table and number of tables for so many vectors that may be compared.

    Bits grow with the logarithm of the rows, so that unrelated vectors seldom share a
    bucket; the number of tables then follows from the chance that two vectors at the
    threshold agree in all bits of one.
    """
    bits = min(40, max(10, math.ceil(math.log2(max(rows, 2))) + 2))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-agree))


def rotations(dim: int, count: int) -> np.ndarray:
    """``count`` random rotations beside one another, scaled so that norms are kept."""
    draw = np.random.default_rng([SEED, dim])
    turned = [np.linalg.qr(draw.standard_normal((dim, dim)))[0] for _ in range(count)]
    return np.concatenate(turned, axis=1) / math.sqrt(count)


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def encode(batches: Iterator[pa.RecordBatch], bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    """Adds the sign code of each vector as ``tables`` bucket keys, and its correction."""
    for batch in batches:
        if not batch.num_rows:
            continue
        dims = np.asarray(batch["dim"])
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            turn = rotations(int(dim), -(-bits * tables // int(dim)))
            turned = unit_rows(part["vec"], int(dim)) @ turn
            # Product of a vector with its own code: corrects estimates made from the code.
            factor = np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])
            signs = (turned[:, : bits * tables] > 0).reshape(-1, tables, bits)
            keys = signs @ (1 << np.arange(bits, dtype=np.int64))
            keys += np.arange(tables, dtype=np.int64) << 48
            offsets = np.arange(len(keys) + 1, dtype=np.int32) * tables
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.ListArray.from_arrays(offsets, keys.ravel()), pa.array(factor)],
                names=[*part.schema.names, "keys", "factor"],
            )


def compare(rows: pa.Table, bits: int, tables: int, threshold: float) -> pa.RecordBatch:
    """Links among the members of whole buckets: ``id``, ``links``, ``root``.

    Pairs are taken at growing distance within the sorted rows, all buckets at once. A
    pair counts in the first table where its keys agree and nowhere else. The code of
    one vector and the rotated other give an estimate of their product without bias,
    and the stored correction a bound of its error; pairs that the bound leaves
    possible are computed from the vectors in double precision.
    """
    dim = int(rows["dim"][0].as_py())
    units = unit_rows(rows["vec"].combine_chunks(), dim)
    turned = (units @ rotations(dim, -(-bits * tables // dim))).astype(np.float32)
    signs = np.where(turned > 0, np.float32(1), np.float32(-1)) / np.float32(
        math.sqrt(turned.shape[1])
    )
    factor = np.asarray(rows["factor"])
    slack = EPSILON * np.sqrt((1 - factor**2).clip(0) / factor**2 / max(turned.shape[1] - 1, 1))
    keys = rows["keys"].combine_chunks().flatten().to_numpy().reshape(-1, tables)
    key, ids, count = (np.asarray(rows[c]) for c in ("key", "id", "copies"))
    low, high, block = (np.asarray(rows[c]) for c in ("low", "high", "block"))
    label = np.asarray(rows["label_code"])
    same = (key[1:] == key[:-1]) & (low[1:] == low[:-1]) & (high[1:] == high[:-1])
    group = np.concatenate([[0], np.cumsum(~(same & (label[1:] == label[:-1])))])
    links = np.zeros(len(ids), np.int64)
    left, right = [], []
    i = np.arange(len(ids))
    for d in range(1, len(ids)):
        i = i[i + d < len(ids)]
        i = i[group[i] == group[i + d]]
        if not len(i):
            break
        j = i + d
        a = i[(low[i] == high[i]) | (block[i] != block[j])]
        b = a + d
        first = (keys[a] == keys[b]).argmax(axis=1) == key[a] >> 48
        a, b = a[first], b[first]
        estimate = np.einsum("ij,ij->i", turned[a], signs[b]) / factor[b]
        likely = estimate + slack[b] >= threshold
        a, b = a[likely], b[likely]
        near = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
        a, b = a[near], b[near]
        np.add.at(links, a, count[b])
        np.add.at(links, b, count[a])
        left.append(a)
        right.append(b)
    a, b = np.concatenate([[], *left]).astype(int), np.concatenate([[], *right]).astype(int)
    # One id may stand in several buckets of these rows; places of the same id are one.
    _, place = np.unique(ids, return_inverse=True)
    root = np.unique(ids)
    while len(a):
        least = np.minimum(root[place[a]], root[place[b]])
        before = root.copy()
        np.minimum.at(root, place[a], least)
        np.minimum.at(root, place[b], least)
        if (before == root).all():
            break
    linked = links > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[linked]), pa.array(links[linked]), pa.array(root[place[linked]])],
        names=["id", "links", "root"],
    )


def compare_groups(
    batches: Iterator[pa.RecordBatch], bits: int, tables: int, threshold: float
) -> Iterator[pa.RecordBatch]:
    """``compare`` over sorted batches, each bucket whole: the last one of a batch waits."""
    names = ("dim", "label_code", "key", "low", "high")
    waiting: list[pa.RecordBatch] = []

    def split(table: pa.Table, last: bool):
        marks = [np.asarray(table[n]) for n in names]
        new = np.zeros(len(table), bool)
        for m in marks:
            new[1:] |= m[1:] != m[:-1]
        cut = len(table) if last else int(np.flatnonzero(new)[-1]) if new.any() else 0
        dims = marks[0][:cut]
        edges = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1), cut] if cut else [0]
        return [table.slice(s, e - s) for s, e in zip(edges, edges[1:])], table.slice(cut)

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        ready, rest = split(pa.Table.from_batches(waiting), False)
        waiting = rest.to_batches()
        for part in ready:
            yield compare(part, bits, tables, threshold)
    if waiting:
        for part in split(pa.Table.from_batches(waiting), True)[0]:
            yield compare(part, bits, tables, threshold)


def embedding_links(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``.

    Rows with equal, non-null labels and a cosine of ``threshold`` or more are linked.
    Vectors that are null, empty, zero or hold null or non-finite components, vectors
    of different lengths, and rows without label or vec_id link with nothing. Equal vectors of a
    label are compared once and counted with their copies. A bucket of any size is
    compared whole, by pairs of blocks that are separate tasks. Cosines are computed in
    double precision from the components as given, whatever their size. The result depends on
    a fixed seed; a pair at the threshold is missed with a chance of ``MISS`` at most.
    Repeated rows count as others; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    # Floats stay floats on their way; all other numbers are doubles, and all are compared so.
    given = vectors.schema["embedding"].dataType.simpleString()
    kind = "array<float>" if given == "array<float>" else "array<double>"
    vec = F.col("embedding").cast(kind)
    sound = (
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & (F.size(vec) > 0)
        & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vec, lambda x: x != 0)
    )
    rows = vectors.select(
        "vec_id", "label", vec.alias("vec"), F.coalesce(sound, F.lit(False)).alias("sound")
    )
    reps, reps_path = staged(
        rows.where("sound")
        .groupBy("label", "vec")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")),
        "vectors",
    )
    most = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(most, threshold)
    codes, codes_path = staged(
        reps.select(
            "id",
            F.xxhash64("label").alias("label_code"),
            F.col("label").cast("string").alias("label"),
            "copies",
            F.size("vec").alias("dim"),
            "vec",
        ).mapInArrow(
            lambda batches: encode(batches, bits, tables),
            f"id long, label_code long, label string, copies long, dim int, vec {kind}, "
            "keys array<long>, factor double",
        ),
        "codes",
    )
    bucket = ["label", "dim", "key"]
    placed = codes.select("id", "label", "dim", F.explode("keys").alias("key"))
    shared = placed.groupBy(bucket).agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK)
    members = (
        placed.join(shared, bucket)
        .withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
        .select(
            "id",
            "key",
            "block",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
        )
    )
    keys = ["dim", "label_code", "key", "low", "high"]
    found, found_path = staged(
        members.join(codes.drop("label"), "id")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(
            lambda batches: compare_groups(batches, bits, tables, threshold),
            "id long, links long, root long",
        ),
        "links",
    )
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    labelled, _ = staged(
        reps.join(counted, "id", "left")
        .join(groups, "id", "left")
        .select(
            "label",
            "vec",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        ),
        "labels",
    )
    for path in (codes_path, found_path, reps_path):
        discard(spark, path)
    linked = rows.where("sound").join(labelled, ["label", "vec"])
    alone = rows.where("NOT sound").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        linked.select("vec_id", "n_links", "component_id")
        .unionAll(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
