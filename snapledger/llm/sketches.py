"""Document fingerprints: invertible Bloom lookup sketches of paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import staged

# Rows of cells; a paragraph has one cell in each. Cells in a row of a part of a sketch: only
# used cells are kept, so room for more costs nothing and makes it unlikely that two
# paragraphs share all their cells.
ROWS, WIDTH = 3, 32
# Sketches of a document: its own, that of its edited text, and the two comparisons.
OWN, NEW, EDIT, NEXT = range(4)
# Paragraphs for which a sketch gets one more part, in powers of two.
PER_PART = 6
MAX_TRIES, PEELS = 16, 8
# Paragraphs are lines. Longer ones are cut behind the ends of sentences and at some
# letters, not before 100 code points and after 400 at the latest, whatever their length.
UNIT = r"[^\n]{99,399}?(?:[.!?|;](?= )|[gh](?= )|[。！？的の]|(?=\n|\z))|[^\n]{400}|[^\n]+"
# The low bits of a digest hold the paragraph's length.
LENGTH_BITS = 20
DOCS_PER_BLOCK, MAX_BLOCKS, MAX_CUTS = 500, 1 << 16, 64
DOCS_PER_TASK = 20_000
CHECK = 7919


def blocks_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``block``, ascending with (doc_id, hash), and ``heads``: the largest id of each.

    Equal ranges of doc_id; a block that gets many more rows than its share, as far ids or
    reused and missing ones bring about, is cut again between its own ends, by the hash of
    the text where all its ids are the same. Only rows equal in both stay together. There are some
    ``MAX_BLOCKS`` blocks at most, whose ends are broadcast.
    """
    rows = rows.withColumn("block", F.when(F.col("doc_id").isNull(), 0).otherwise(1).cast("long"))
    share = None
    for _ in range(MAX_CUTS):
        key = [F.min("doc_id").alias("low"), F.max("doc_id").alias("head")]
        heads, _ = staged(rows.groupBy("block").agg(F.count("*").alias("n"), *key), "blocks")
        if share is None:
            count = heads.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            share = max(DOCS_PER_BLOCK, count // MAX_BLOCKS)
        heavy = heads.where(F.col("n") > 4 * share)
        same = F.col("low").eqNullSafe(F.col("head"))
        by_hash = heavy.where(same).select("block")
        ends = heavy.where(~same).select("block", F.lit(False).alias("by_hash"), "n", "low", F.col("head").alias("high"))
        if by_hash.take(1):
            hashes = (
                rows.join(F.broadcast(by_hash), "block", "left_semi")
                .groupBy("block")
                .agg(F.count("*").alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high"))
                .where("low < high")
            )
            ends = ends.unionAll(hashes.select("block", F.lit(True), "n", "low", "high"))
        ends, _ = staged(ends, "heavy-blocks")
        if not ends.take(1):
            return rows, heads.select("block", "head")
        pieces = F.least(F.col("n") / share + 1, F.col("span")).cast("long")
        number = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        cuts = (
            heads.select("block")
            .join(ends.withColumn("span", F.expr("CAST(high AS DECIMAL(20)) - low + 1")), "block", "left")
            .withColumn("pieces", F.coalesce(pieces, F.lit(1).cast("long")))
            .withColumn("first", F.coalesce(F.sum("pieces").over(number), F.lit(0)))
            .select("block", "by_hash", "low", F.expr("CAST(ceil(span / pieces) AS DECIMAL(20))").alias("width"), "first")
        )
        cuts, _ = staged(cuts, "cuts")
        place = "CAST((CAST(if(by_hash, hash, doc_id) AS DECIMAL(20)) - low) DIV width AS BIGINT)"
        rows = rows.join(F.broadcast(cuts), "block").select(
            "doc_id", "text", "hash", (F.col("first") + F.coalesce(F.expr(place), F.lit(0))).alias("block")
        )
    raise RuntimeError(f"blocks of documents did not even out in {MAX_CUTS} rounds")


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``next``, the text of the following document, and ``block``.

    Documents follow in descending order of doc_id (null last, then XXH64 of the text, then
    text), and the first follows the last. They are sorted within blocks; only the
    largest doc_id of each block goes to one task to link the blocks.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("hash"))
    rows, heads = blocks_of(rows)
    down = Window.orderBy(F.col("block").desc())
    linked = heads.select(
        F.lead("block", 1).over(down).alias("after_block"),
        F.lead("head", 1).over(down).alias("after"),
        F.first("head").over(down).alias("top"),
        F.first("block").over(down).alias("top_block"),
        "block",
    ).select(
        "block",
        F.coalesce("after_block", "top_block").alias("from_block"),
        F.when(F.col("after_block").isNull(), F.col("top")).otherwise(F.col("after")).alias("head"),
    )
    linked, _ = staged(linked, "links")
    first_text = (
        rows.withColumnRenamed("block", "from_block")
        .join(linked.select("from_block", "head").withColumnRenamed("head", "wanted"), "from_block")
        .where(F.col("doc_id").eqNullSafe(F.col("wanted")))
        .groupBy("from_block")
        .agg(F.max(F.struct("hash", "text"))["text"].alias("head_text"))
    )
    follow = linked.join(first_text, "from_block").select("block", "head_text")
    order = Window.partitionBy("block").orderBy(*[F.col(c).desc() for c in ("doc_id", "hash", "text")])
    within = rows.select(
        "block", "doc_id", "text", F.lead(F.struct("text")).over(order).alias("then")
    )
    ends = F.col("then").isNull()
    return within.alias("w").join(
        follow.withColumnRenamed("block", "b"), (F.col("block") == F.col("b")) & ends, "left"
    ).select("block", "doc_id", "text", F.coalesce("then.text", "head_text").alias("next"))


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text (``UNIT``) without blanks around them; blank ones are left out."""
    units = F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), lambda u: F.trim(u))
    return F.filter(units, lambda p: p != "")


def slots(key: Column, width: Column, seed: Column) -> Column:
    """The cell of a digest in each row."""
    mix = F.xxhash64(key, seed.cast("int"))
    places = [
        (width * r + F.pmod(F.shiftrightunsigned(mix, 20 * r), width.cast("long"))).cast("int")
        for r in range(ROWS)
    ]
    return F.array(*places)


def check_of(key: Column) -> Column:
    return F.xxhash64(key, F.lit(CHECK))


def cells(signed: DataFrame, places) -> DataFrame:
    """Sketch cells of digests (``digest``, ``sign``): ``cells`` for each ``row``, ``member``.

    ``places`` gives the cells of a digest. A cell sums signs and combines digests and
    their check values, so equal digests of opposite signs vanish: what remains is the
    difference of two sketches. Empty cells are left out.
    """
    # Member and cell are one number, so that the many groups of the first step are small.
    room = 1 << 32
    cell = (F.col("member") * room + F.col("slot")).alias("cell")
    return (
        signed.select("row", "member", "digest", "sign", F.explode(places).alias("slot"))
        .select("row", cell, "digest", "sign")
        .groupBy("row", "cell")
        .agg(
            F.sum("sign").alias("n"),
            F.bit_xor("digest").alias("key"),
            F.bit_xor(check_of(F.col("digest"))).alias("check"),
        )
        .select(
            "row",
            F.shiftright("cell", 32).alias("member"),
            F.when(
                (F.col("n") != 0) | (F.col("key") != 0) | (F.col("check") != 0),
                F.struct(
                    F.col("cell").bitwiseAND(room - 1).cast("int").alias("slot"), "n", "key", "check"
                ),
            ).alias("c"),
        )
        .groupBy("row", "member")
        .agg(F.collect_list("c").alias("cells"))
    )


def peeled(sketch: Column, width: Column, seed: Column) -> Column:
    """Digests recovered from a difference: ``found`` and the ``left`` cells.

    A cell with one digest gives it away; taking all of those out of their other cells may free
    further ones, ``PEELS`` times. Nothing is left when all have been recovered.
    """

    def is_pure(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (c["check"] == check_of(c["key"]))

    def remove(c: Column, p: Column) -> Column:
        less = F.struct(
            c["slot"].alias("slot"),
            (c["n"] - p["n"]).alias("n"),
            c["key"].bitwiseXOR(p["key"]).alias("key"),
            c["check"].bitwiseXOR(check_of(p["key"])).alias("check"),
        )
        return F.when(F.array_contains(p["slots"], c["slot"]), less).otherwise(c)

    def take(state: Column, _) -> Column:
        alone = F.array_distinct(
            F.transform(
                F.filter(state["left"], is_pure),
                lambda c: F.struct(
                    c["n"].alias("n"), c["key"].alias("key"), slots(c["key"], width, seed).alias("slots")
                ),
            )
        )

        def without(pure: Column) -> Column:
            rest = F.transform(state["left"], lambda c: F.aggregate(pure, c, remove))
            found = F.transform(pure, lambda p: F.struct(p["key"].alias("digest"), p["n"].alias("sign")))
            return F.struct(
                F.filter(rest, lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0)).alias("left"),
                F.concat(state["found"], found).alias("found"),
            )

        # An array of one, so that what is pure is worked out once.
        return F.when(F.size(state["left"]) == 0, state).otherwise(F.get(F.transform(F.array(alone), without), 0))

    start = F.struct(
        sketch.alias("left"),
        F.array().cast("array<struct<digest: bigint, sign: bigint>>").alias("found"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(PEELS)), start, take)


def written(sketch: Column, part: Column, tries: int) -> Column:
    """A part of a fingerprint as text: its number, its tries and every used cell in order.

    A cell is its place, its count, and digest and check in hexadecimal digits.
    """

    def cell(c: Column) -> Column:
        return F.concat_ws(".", c["slot"], c["n"], F.lower(F.hex(c["key"])), F.lower(F.hex(c["check"])))

    cells = F.array_join(F.transform(F.array_sort(sketch), cell), " ")
    return F.concat_ws(":", part, F.lit(tries), cells)


def recovered(fingerprint: Column) -> Column:
    """The digests of all paragraphs, peeled from a fingerprint as it is returned."""

    def number(text: Column) -> Column:
        return F.conv(text, 16, -10).cast("long")

    def part(text: Column) -> Column:
        fields = F.split(text, ":")
        tries = F.get(fields, 1).cast("int")
        cells = F.transform(
            F.transform(F.split(F.get(fields, 2), " "), lambda c: F.split(c, r"\.")),
            lambda c: F.struct(
                c[0].cast("int").alias("slot"),
                c[1].cast("long").alias("n"),
                number(c[2]).alias("key"),
                number(c[3]).alias("check"),
            ),
        )
        return F.transform(peeled(cells, F.call_function("shiftleft", F.lit(WIDTH), tries), tries)["found"], lambda f: f["digest"])

    parts = F.filter(F.split(fingerprint, ","), lambda t: t != "")
    return F.flatten(F.transform(parts, part))


def weight(digests: Column) -> Column:
    """Code points of the paragraphs of some digests."""
    bits = (1 << LENGTH_BITS) - 1
    return F.aggregate(digests, F.lit(0).cast("long"), lambda total, d: total + d.bitwiseAND(F.lit(bits)))


def likeness_of(one: Column, other: Column) -> Column:
    """How alike two returned fingerprints are: code points of paragraphs in both, of all.

    This is what ``fingerprints`` gives, for any two of them, wherever they are kept.
    """
    a, b = recovered(one), recovered(other)
    every = weight(F.array_union(a, b))
    return F.when(every == 0, 1.0).otherwise(weight(F.array_intersect(a, b)) / every)


def length_of(unit: Column) -> Column:
    return F.least(F.length(unit), F.lit((1 << LENGTH_BITS) - 1)).cast("long")


def part_of(digest: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(CHECK + 1)), parts)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    In the edited text the last third of the code points is replaced by as many (or all)
    from the front of the next document. A fingerprint is a sketch of all paragraphs,
    with parts for the number of paragraphs, from which all digests can be peeled again: a part that
    does not come out gets twice the cells. ``near_edited`` and ``near_next`` compare the text's
    fingerprint with that of its edited text and of the next document: both are filed
    under the larger number of parts, subtracted and peeled, and the recovered paragraph
    digests, which hold their lengths, give the share of code points in common paragraphs,
    from 0 to 1 (``likeness_of`` gives the same from the returned texts); two texts without
    paragraphs are alike. A part of a difference that does not come out is tried again with twice
    the cells. A paragraph that occurs again has another digest each time. Equal texts have equal
    fingerprints. Columns of docs other than doc_id and text play no part, whatever their names.
    A null text is an empty one, whose fingerprint is empty; null ids follow all others;
    repeated rows stay; an empty table gives an empty result. The paragraphs of a very long text are rows
    of their own, but its text and its fingerprint have to fit into one string.
    """
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    # Everything up to the digests stays where the blocks are, as ``block`` is a key.
    texts = with_next(docs).select(
        "block",
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        n.cast("long").alias("n_chars"),
        "text",
        F.concat(F.substring("text", F.lit(1), n - third), F.substring("next", F.lit(1), third)).alias("edited"),
        "next",
    )
    versions = [paragraphs(F.col(c)) for c in ("text", "edited", "next")]
    split = texts.select(
        "block",
        "row",
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("sha"),
        F.array(*versions).alias("units"),
    )

    def parts(i: int) -> Column:
        """The smallest power of two that leaves ``PER_PART`` paragraphs a part at most."""
        beyond = F.ceil(F.size(F.get("units", i)) / PER_PART) - 1
        bits = F.when(beyond > 0, F.length(F.bin(beyond))).otherwise(0)
        return F.call_function("shiftleft", F.lit(1), bits)

    sizes = [parts(i).alias(f"parts{i}") for i in range(3)]
    weights = [
        F.aggregate(F.get("units", i), F.lit(0).cast("long"), lambda t, u: t + length_of(u)).alias(f"w{i}")
        for i in range(3)
    ]
    head = F.struct(F.lit(-1).alias("version"), F.array(F.lit("")).alias("units"))
    listed = F.array(
        head, *[F.struct(F.lit(i).alias("version"), F.get("units", i).alias("units")) for i in range(3)]
    )
    info = ["row", "doc_id", "n_chars", "sha", "w0", "w1", "w2", "parts0", "parts1", "parts2"]
    counted = (
        split.select("block", "row", "doc_id", "n_chars", "sha", *weights, *sizes, F.explode(listed).alias("v"))
        .select("block", *info, "v.version", F.explode("v.units").alias("unit"))
        .groupBy("block", "row", "version", "unit")
        .agg(F.count("*").alias("times"), *[F.first(c).alias(c) for c in info[1:]])
    )
    is_head = F.col("version") == -1
    about = ["doc_id", "n_chars", "sha", "w0", "w1", "w2"]
    digests, _ = staged(
        counted.select(
            "row",
            "version",
            F.when(~is_head, F.xxhash64("unit")).alias("hash"),
            length_of(F.col("unit")).alias("length"),
            "times",
            *[F.when(is_head, F.col(c)).alias(c) for c in about],
            "parts0",
            "parts1",
            "parts2",
        ),
        "digests",
    )
    each = F.transform(
        F.sequence(F.lit(1).cast("long"), F.col("times")),
        lambda i: F.shiftleft(F.xxhash64("hash", i), LENGTH_BITS).bitwiseOR(F.col("length")),
    )

    def signed(rows: DataFrame) -> DataFrame:
        """Digests as members of the sketches they belong to: part of the sketch, and which."""

        def member(kind: int, sign: int, parts: Column) -> Column:
            return F.struct(
                F.lit(kind).alias("kind"), F.lit(sign).alias("sign"), parts.cast("long").alias("parts")
            )

        own, new = F.col("parts0"), F.col("parts1")
        edit, after = F.greatest("parts0", "parts1"), F.greatest("parts0", "parts2")
        where = (
            F.when(
                F.col("version") == 0, F.array(member(OWN, 1, own), member(EDIT, 1, edit), member(NEXT, 1, after))
            )
            .when(F.col("version") == 1, F.array(member(NEW, 1, new), member(EDIT, -1, edit)))
            .when(F.col("version") == 2, F.array(member(NEXT, -1, after)))
        )
        part = part_of(F.col("digest"), F.col("m.parts"))
        return (
            rows.where("version >= 0")
            .select("row", where.alias("where"), F.explode(each).alias("digest"))
            .select("row", "digest", F.explode("where").alias("m"))
            .select("row", "digest", "m.sign", (part * 4 + F.col("m.kind")).alias("member"))
        )

    kind = F.col("member") % 4

    def solved(members: DataFrame, tries: int) -> DataFrame:
        """Sketches of digests, peeled: ``piece`` of a fingerprint, ``differ``, and ``failed``."""
        width, seed = F.lit(WIDTH << tries), F.lit(tries)
        piece = F.when(kind < EDIT, written(F.col("cells"), F.shiftright("member", 2), tries))
        found = F.transform(F.col("p.found"), lambda f: f["digest"])
        return (
            cells(members, slots(F.col("digest"), width, seed))
            .select("row", "member", piece.alias("piece"), peeled(F.col("cells"), width, seed).alias("p"))
            .select("row", "member", (F.size("p.left") > 0).alias("failed"), "piece", weight(found).alias("differ"))
        )

    def gathered(sketches: DataFrame, label: str) -> list[Column]:
        """What the solved parts of a row give for each of its four sketches."""
        good = ~F.col("failed")
        pieces = [
            F.collect_list(F.when(good & (kind == k), F.struct("member", "piece"))).alias(f"{label}{k}")
            for k in (OWN, NEW)
        ]
        sums = [F.sum(F.when(good & (kind == k), F.col("differ"))).alias(f"{label}{k}") for k in (EDIT, NEXT)]
        return pieces + sums

    # Digests grow to many cells, so tasks are smaller than what they read would suggest.
    tasks = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, digests.where("version = -1").count() // DOCS_PER_TASK)
    placed = digests.repartition(tasks, "row")
    first = solved(signed(placed), 0)
    per_row = first.groupBy("row").agg(
        *gathered(first, "got"), F.collect_list(F.when(F.col("failed"), F.col("member"))).alias("failed")
    )
    heads = placed.where("version = -1").select("row", *about)
    result, _ = staged(heads.join(per_row, "row", "left"), "compared", "zstd")
    wanted = result.select("row", F.explode("failed").alias("member"))
    more = None
    for tries in range(1, MAX_TRIES + 1):
        wanted, _ = staged(wanted, "failed")
        if not wanted.take(1):
            break
        again = signed(digests.join(wanted.select("row").distinct(), "row", "left_semi"))
        again = again.join(wanted, ["row", "member"], "left_semi")
        retried, _ = staged(solved(again, tries), "retried")
        wanted = retried.where("failed").select("row", "member")
        more = retried if more is None else more.unionAll(retried)
    else:
        raise RuntimeError(f"sketches did not come out in {MAX_TRIES} tries")
    # Only rows with a part that failed are joined: the fingerprints of all others stay where they are.
    none = [F.lit(None).cast(result.schema[f"got{k}"].dataType).alias(f"more{k}") for k in range(4)]
    if more is None:
        result = result.select("*", *none)
    else:
        again = F.size("failed") > 0
        mended = result.where(again).join(more.groupBy("row").agg(*gathered(more, "more")), "row", "left")
        result = result.where(~F.coalesce(again, F.lit(False))).select("*", *none).unionByName(mended)

    def fingerprint(k: int) -> Column:
        empty = F.array().cast(result.schema[f"got{k}"].dataType)
        parts = F.concat(F.coalesce(f"got{k}", empty), F.coalesce(f"more{k}", empty))
        return F.array_join(F.transform(F.array_sort(parts), lambda p: p["piece"]), ",")

    def likeness(other: str, k: int) -> Column:
        both = (F.col("w0") + F.col(other)).cast("double")
        differ = F.coalesce(f"got{k}", F.lit(0)) + F.coalesce(f"more{k}", F.lit(0))
        return F.when(both == 0, 1.0).otherwise((both - differ) / (both + differ))

    return result.select(
        "doc_id",
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        fingerprint(OWN).alias("fingerprint"),
        fingerprint(NEW).alias("edited_fingerprint"),
        likeness("w1", EDIT).alias("near_edited"),
        likeness("w2", NEXT).alias("near_next"),
    )
