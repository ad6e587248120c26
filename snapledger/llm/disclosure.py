"""Personal data and the terms that reveal it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import staged

# The kinds of personal data, in order, and their patterns. Runs are
# matched possessively and only from where they begin (or the last match ended), which
# finds the same leftmost matches without trying every start of a long run.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text has to hold before its pattern is tried.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){13}[0-9]", "phone": r"\+[0-9]"}
TERM = r"\p{L}[\p{L}\p{M}]*+"
# Documents with a term that are added unseen, with the entity no oftener than by chance:
# the fewer documents a term has, the less they count as evidence.
UNSEEN = 1.0
# Matches that are placed one after the other, so that long texts take no array that is
# copied for each of them.
RUN = 256


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits of a text pass the Luhn check."""
    order = F.split(F.reverse(number), "")

    def weigh(digit: Column, i: Column) -> Column:
        value = digit.cast("int")
        twice = value * 2
        return F.when(i % 2 == 0, value).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    weighed = F.transform(F.filter(order, lambda d: d != ""), weigh)
    return F.aggregate(weighed, F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":

        def small(part: Column) -> Column:
            value = F.concat(F.lit("0"), F.regexp_replace(part, "^0+", ""))
            return (F.length(value) <= 4) & (F.substring(value, 1, 4).cast("int") <= 255)

        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        number = digits(match)
        return F.length(number).between(14, 19) & luhn(number)
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    return F.lit(True)


def located(text: Column, pattern: str) -> Column:
    """All matches of a pattern as an array of ``value``, ``start`` and ``end``.

    Offsets are code points, the end exclusive: the text between matches is what a split
    by the same pattern leaves.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    between = F.split(text, pattern, -1)
    lengths = F.zip_with(
        found,
        between,
        lambda m, b: F.struct(
            m.alias("value"),
            F.length(b).cast("long").alias("gap"),
            F.length(m).cast("long").alias("size"),
        ),
    )
    kept = F.filter(lengths, lambda x: x["value"].isNotNull())
    one = "struct<value: string, start: bigint, end: bigint>"

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["gap"]
        one = F.struct(
            x["value"].alias("value"), start.alias("start"), (start + x["size"]).alias("end")
        )
        return F.struct((start + x["size"]).alias("at"), F.concat(s["out"], F.array(one)).alias("out"))

    def run(s: Column, part: Column) -> Column:
        state = F.struct(s["at"].alias("at"), F.array().cast(f"array<{one}>").alias("out"))
        placed = F.aggregate(part, state, step)
        # Bound to a name, so that it is worked out once.
        return F.get(
            F.transform(
                F.array(placed),
                lambda p: F.struct(p["at"].alias("at"), F.concat(s["out"], F.array(p["out"])).alias("out")),
            ),
            0,
        )

    def runs(found: Column) -> Column:
        starts = F.when(
            F.size(found) > 0, F.sequence(F.lit(1), F.size(found), F.lit(RUN))
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(found, i, RUN))

    state = F.struct(
        F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{one}>>").alias("out")
    )
    parts = F.get(F.transform(F.array(kept), runs), 0)
    return F.aggregate(parts, state, run, lambda s: F.flatten(s["out"]))


def spans_of(text: Column, rank: int, kind: str) -> Column:
    """Valid matches of one kind, where the text holds anything like it."""
    found = F.filter(located(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))
    spans = F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            s["end"].alias("end"),
            s["value"].alias("value"),
        ),
    )
    nothing = F.array().cast(
        "array<struct<start: bigint, rank: int, kind: string, end: bigint, value: string>>"
    )
    return F.when(text.rlike(HINTS[kind]), spans).otherwise(nothing)


def base_spans(text: Column) -> Column:
    """Personal data of a text: an array of ``start``, ``rank``, ``kind``, ``end``, ``value``."""
    return F.array_sort(F.concat(*[spans_of(text, i, kind) for i, kind in enumerate(KINDS)]))


def lowered(words: Column) -> Column:
    return F.array_distinct(F.transform(words, F.lower))


def terms_of(text: Column, base: Column) -> Column:
    """The whole words of a text that no base span touches, with their places."""
    return F.filter(
        located(text, TERM),
        lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])),
    )


def owners(texts: DataFrame) -> DataFrame:
    """``digest``, ``owner`` and ``having``: the entities of each text, by where they occur.

    An entity is a piece of personal data, or the domain of a mail address. Entities of
    the same texts have the same numbers with every term and are one owner; ``having``
    is the number of documents with it.
    """
    values = F.transform("base", lambda b: b["value"])
    mails = F.filter("base", lambda b: b["kind"] == "email")
    domains = F.transform(mails, lambda b: F.lower(F.regexp_extract(b["value"], "@.*", 0)))
    held = texts.select(
        "digest", "copies", F.explode(F.array_distinct(F.concat(values, domains))).alias("entity")
    )
    mark = [F.bit_xor(F.xxhash64("digest", F.lit(seed))) for seed in (1, 2)]
    entities, _ = staged(
        held.groupBy("entity").agg(
            F.concat_ws(".", *[m.cast("string") for m in mark], F.count("*").cast("string")).alias("owner"),
            F.sum("copies").alias("having"),
        ),
        "owners",
    )
    return held.join(entities, "entity").select("digest", "owner", "having").distinct()


def revealed(both: Column, docs: Column, having: Column, total: int) -> Column:
    """Share of an entity's information that a term reveals, by numbers of documents."""
    chance = having / F.lit(float(total))
    given = (both + UNSEEN * chance) / (docs + UNSEEN)
    return F.when(chance < 1, F.log(given / chance) / -F.log(chance)).otherwise(0.0)


def disclosing_terms(
    texts: DataFrame, words: DataFrame, generalise: float, remove: float, support: int
) -> DataFrame:
    """Terms of each text (``digest``) that reveal too much of an entity in it, as ``kind``.

    Probabilities are shares of documents, of whole texts. An entity holds
    ``-log p(entity)`` of information and a term reveals ``log p(entity | term) /
    p(entity)`` of it; the share revealed is 1 when every document with the term has the
    entity, and 0 when the two are independent. ``p(entity | term)`` is smoothed by
    ``UNSEEN`` documents, so that a pair seen once counts, but for less than one seen
    often. ``support`` leaves out pairs of fewer documents; 1 leaves out none. ``words``
    has the text of every document without personal data.
    """
    held, _ = staged(
        texts.select(
            "digest",
            "copies",
            F.explode(lowered(F.transform(terms_of(F.col("text"), F.col("base")), lambda w: w["value"]))).alias("term"),
        ),
        "words",
    )
    total = max(1, words.count() + (texts.agg(F.sum("copies")).first()[0] or 0))
    found = F.regexp_extract_all("text", F.lit(TERM), 0)
    seen = (
        words.select(F.explode(lowered(found)).alias("term"), F.lit(1).cast("long").alias("copies"))
        .unionByName(held.select("term", "copies"))
        .groupBy("term")
        .agg(F.sum("copies").alias("docs"))
    )
    own, _ = staged(owners(texts), "owned")
    # No more documents have both than have the entity: what cannot reach the share goes
    # before pairs are made.
    most = F.least("docs", "having")
    reach = revealed(most, F.col("docs"), F.col("having"), total) >= generalise
    widest = own.groupBy("digest").agg(F.max("having").alias("having"))
    likely = held.join(widest, "digest").join(seen, "term").where(reach).drop("having")
    pairs, _ = staged(likely.join(own, "digest").where(reach), "pairs")
    both = (
        pairs.groupBy("owner", "term")
        .agg(F.sum("copies").alias("both"), F.first("docs").alias("docs"), F.first("having").alias("having"))
        .where(F.col("both") >= support)
        .withColumn("share", revealed(F.col("both"), F.col("docs"), F.col("having"), total))
        .where(F.col("share") >= generalise)
        .select("owner", "term", F.when(F.col("share") >= remove, "term").otherwise("general").alias("kind"))
    )
    return pairs.join(both, ["owner", "term"]).groupBy("digest", "term").agg(F.max("kind").alias("kind"))


def personal_data(
    docs: DataFrame, generalise: float = 0.6, remove: float = 0.9, support: int = 1
) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: what to mask in each whole text.

    ``base`` has emails, addresses, cards and phone numbers; ``spans`` has them and the
    terms of the text that reveal at least ``generalise`` of one, wherever they stand:
    ``general`` is to be replaced by a general word, ``term`` (``remove`` or more) to be
    removed. A term that overlaps a base span is left to it. Both are arrays of ``start``, ``rank``,
    ``kind``, ``end`` (``base`` also of ``value``) in order of start and kind. Equal
    texts are looked at once and count as often as they occur. A null text is an empty
    one and has no spans; repeated rows stay; an empty table gives an empty result; all
    other columns are kept, but for ones named ``base``, ``spans`` or ``digest``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [c for c in docs.columns if c.lower() not in ("base", "spans", "digest")]
    rows, _ = staged(
        docs.select(*[F.col(f"`{c}`") for c in kept], base_spans(text).alias("base")).withColumn(
            "digest", F.when(F.size("base") > 0, F.md5(text.cast("binary")))
        ),
        "entities",
    )
    texts, _ = staged(
        rows.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.first("text").alias("text"), F.first("base").alias("base"), F.count("*").alias("copies")
        ),
        "texts",
    )
    words = rows.where("digest IS NULL").select(F.coalesce("text", F.lit("")).alias("text"))
    terms, _ = staged(disclosing_terms(texts, words, generalise, remove, support), "disclosing")
    rank = F.when(F.col("kind") == "term", len(KINDS)).otherwise(len(KINDS) + 1)
    extra = (
        texts.join(terms.select("digest").distinct(), "digest", "left_semi")
        .select("digest", F.explode(terms_of(F.col("text"), F.col("base"))).alias("w"))
        .select("digest", F.lower("w.value").alias("term"), "w.start", "w.end")
        .join(terms, ["digest", "term"])
        .groupBy("digest")
        .agg(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end")).alias("extra"))
    )
    extra, _ = staged(extra, "terms")
    plain = F.transform(
        "base", lambda b: F.struct(b["start"].alias("start"), b["rank"].alias("rank"), b["kind"].alias("kind"), b["end"].alias("end"))
    )
    spans = F.when(F.col("extra").isNull(), plain).otherwise(F.array_sort(F.concat(plain, F.col("extra"))))
    with_terms = rows.where("digest IS NOT NULL").join(extra, "digest", "left")
    columns = [*[F.col(f"`{c}`") for c in kept], F.col("base")]
    return with_terms.select(*columns, spans.alias("spans")).unionByName(
        rows.where("digest IS NULL").select(*columns, plain.alias("spans"))
    )


def masked(text: Column, spans: Column) -> Column:
    """Text with a mark in place of each span; terms that are to be removed leave none.

    Where spans overlap, the later one masks what is left of it.
    """
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        before = F.substring(
            text, (s["at"] + 1).cast("int"), F.greatest(x["start"] - s["at"], F.lit(0)).cast("int")
        )
        mark = (
            F.when(x["end"] <= s["at"], "")
            .when(x["kind"] == "term", "")
            .otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        )
        return F.struct(
            F.greatest(s["at"], x["end"]).alias("at"), F.concat(s["out"], before, mark).alias("out")
        )

    rest = F.aggregate(
        spans,
        state,
        step,
        lambda s: F.concat(
            s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))
        ),
    )
    return F.when(F.size(spans) > 0, rest).otherwise(text)
