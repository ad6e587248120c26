"""Near-duplicate texts by SimHash, found with covering locality-sensitive hashing."""

from __future__ import annotations

from itertools import accumulate, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import components, discard, hex64, ship, staged

BITS = 64
SEED = 42
HASHES_AT_ONCE = 1 << 16


def text_fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit SimHash of one text as a signed integer; zero without words.

    A-Z are lower-cased; words are runs of anything but the six ASCII white space
    characters, which is how ``bytes.split`` divides UTF-8.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[:-1]]
    width = min(shingle, len(words))
    pieces = map(joined.__getitem__, map(slice, starts, (e - 1 for e in ends[width - 1 :])))
    total = len(words) - width + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, total)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, total, HASHES_AT_ONCE):
        part = hashes[at : at + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > total, bitorder="little")
    return int(packed.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, *keep: str) -> DataFrame:
    """``doc_id``, ``fp`` (long) and ``keep`` of every whole text; a null text is an empty one."""

    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select("doc_id", fingerprint("text").alias("fp"), *keep)


def covering_masks(radius: int) -> list[int]:
    """Masks such that two codes within ``radius`` bits agree under one of them at least.

    Bit i gets a non-zero vector of radius + 1 bits, in turn; mask v keeps the bits whose
    vector has an odd product with v. The vectors of up to ``radius`` differing bits
    never span the whole space, so some v is orthogonal to all of them and its mask
    hides every difference.
    """
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(BITS)]
    masks = []
    for v in range(1, 2 ** (radius + 1)):
        masks.append(sum(1 << i for i, w in enumerate(vectors) if (v & w).bit_count() % 2))
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def near_links(codes: DataFrame, radius: int) -> DataFrame:
    """Edges ``a``, ``b`` that connect all codes (``rep``, ``fp``) within ``radius`` bits.

    ``codes`` has each code once. Buckets of the covering tables with one code are
    dropped. In a bucket of several, codes are not compared pair by pair: each is sent
    to the points at most half the radius away within the bits that the mask hides, and
    two codes share a point exactly when they are within the radius. The codes at one
    point are that near to it, so their number has a bound whatever the size of the
    bucket, and each point links its codes to the smallest of them.
    """
    if radius != 2:
        raise ValueError("points halfway between codes are laid out for a radius of 2 bits")
    masks = covering_masks(radius)
    rows = codes.select(
        "rep",
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("t"), F.col("fp").bitwiseAND(_signed(m)).alias("key")
                    )
                    for t, m in enumerate(masks)
                ]
            )
        ).alias("k"),
    ).select("rep", "fp", "k.t", "k.key")
    shared = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    members = rows.join(shared, ["t", "key"])
    flips = F.lit(None)
    for t, m in enumerate(masks):
        hidden = [0, *[_signed(1 << i) for i in range(BITS) if not m >> i & 1]]
        flips = F.when(F.col("t") == t, F.array(*[F.lit(x).cast("long") for x in hidden])).otherwise(
            flips
        )
    points = members.select("t", "rep", F.explode(
        F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))
    ).alias("point"))
    return (
        points.groupBy("t", "point")
        .agg(F.collect_set("rep").alias("reps"))
        .where(F.size("reps") > 1)
        .select(F.explode("reps").alias("a"), F.array_min("reps").alias("b"))
        .where("a <> b")
        .distinct()
    )


def linked_codes(prints: DataFrame, radius: int = 2) -> tuple[DataFrame, str]:
    """``fp, component_id, first`` for every code of ``prints`` (``row, doc_id, fp``), staged.

    Codes are known by the first of their rows, in the order of doc_id (null last) and row,
    whether it has a doc_id or not. ``first`` is the row that comes first of all that links
    reach, and ``component_id`` its doc_id: null only when none of them has one.
    """
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    codes, codes_path = staged(prints.groupBy("fp").agg(F.min(first).alias("first")), "codes")
    found = components(near_links(codes.select(F.col("first.row").alias("rep"), "fp"), radius))
    rooted, rooted_path = staged(
        codes.withColumn("rep", F.col("first.row"))
        .join(found.withColumnRenamed("id", "rep"), "rep", "left")
        .select("fp", "first", F.coalesce("component", "rep").alias("root")),
        "roots",
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    labels, path = staged(
        rooted.join(least, "root").select(
            "fp", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("first")
        ),
        "labels",
    )
    for done in (codes_path, rooted_path):
        discard(prints.sparkSession, done)
    return labels, path


def simhash_components(
    docs: DataFrame, shingle: int = 3, radius: int = 2, key: str | None = None
) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``component_id`` and ``kept`` for every row of ``docs``.

    Two rows are linked when their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest doc_id that links reach. Equal fingerprints are
    one code whatever their number, so copies cost nothing beyond their own row. Texts
    without words have fingerprint zero and are linked like any other; a text of any
    length is taken whole. ``kept`` marks one row of each component: the first by doc_id,
    of rows that agree in it or have none any one. Rows without doc_id link like others
    and get the component of their links, or null when no row there has a doc_id.
    Repeated rows and reused ids stay as they are; an empty table gives an empty result;
    other columns are not looked at. ``key`` names a column of distinct longs that tells
    the rows apart and is returned as well; without it rows are numbered here.
    """
    number = F.col(key) if key else F.monotonically_increasing_id()
    prints, _ = staged(
        fingerprints(docs.withColumn("row", number), shingle, "row"), "fingerprints"
    )
    labels, _ = linked_codes(prints, radius)
    return prints.join(labels, "fp").select(
        "doc_id",
        hex64(F.col("fp")).alias("fingerprint"),
        "component_id",
        (F.col("row") == F.col("first")).alias("kept"),
        *([F.col("row").alias(key)] if key else []),
    )
