"""Chat formatting: one training example per assistant turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, NAMED = "### ", "</turn>\n", ":\n"


def escape(text: Column) -> Column:
    """Text in which no control string of the template can be read.

    Backslashes are doubled, and one is put into each control string, so that
    ``unescape`` gives back any text.
    """
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit("### "), F.lit("#\\## "))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":\n"), F.lit(":\\\n"))


def prefix_examples(turns: DataFrame, trainable: str = "assistant") -> DataFrame:
    """An example for every assistant turn, with all turns before it as its context.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``. The result has

    * ``conv_id``, ``example``: the assistant turns of a conversation from 1,
    * ``text``: all turns up to this one as marked, escaped text,
    * ``loss_start``, ``loss_end``: where the reply stands in it, in code points; all
      else is context,
    * ``widest``: whether this row reaches furthest into its conversation.

    Turns behind the last reply would be in no example: a conversation that has such
    turns gets a row without number and loss that holds all of it. Rows are ordered by
    turn (null first), then role and text, so repeated rows stay and ties have one
    order. Null roles and texts are empty ones; rows without conv_id are one
    conversation. An empty table gives an empty result; other columns are not looked at.
    A conversation is one value and has to fit into one string, and examples repeat
    their context, as they are meant to.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("said"),
    )
    said, role = escape(F.col("said")), escape_role(F.col("role"))
    order = (
        Window.partitionBy("conv_id")
        .orderBy("turn", "role", "said")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = (
        rows.withColumn("piece", F.concat(F.lit(OPEN), role, F.lit(NAMED), said, F.lit(CLOSE)))
        .withColumn("length", F.length(said))
        .withColumn("end", F.sum(F.length("piece")).over(order))
        .withColumn(
            "example", F.sum((F.col("role") == trainable).cast("int")).over(order)
        )
        .withColumn("reply", F.col("role") == trainable)
    )
    grouped = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("end", "piece"))).alias("pieces"),
        F.collect_list(
            F.when(F.col("reply"), F.struct("end", "example", "length"))
        ).alias("replies"),
        F.max("end").alias("whole"),
        F.max(F.when(F.col("reply"), F.col("end"))).alias("last"),
    )
    rest = F.struct(
        F.col("whole").alias("end"),
        F.lit(None).cast("bigint").alias("example"),
        F.lit(None).cast("int").alias("length"),
    )
    targets = F.when(F.col("last") == F.col("whole"), F.col("replies")).otherwise(
        F.concat("replies", F.array(rest))
    )
    return (
        grouped.select(
            "conv_id",
            F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
            "whole",
            F.explode(targets).alias("e"),
        )
        .withColumn("loss_end", F.col("e.end") - F.lit(len(CLOSE)) + F.col("e.length") * 0)
        .select(
            "conv_id",
            F.col("e.example").alias("example"),
            F.substring("formatted", F.lit(1), F.col("e.end").cast("int")).alias("text"),
            (F.col("loss_end") - F.col("e.length")).alias("loss_start"),
            "loss_end",
            (F.col("e.end") == F.col("whole")).alias("widest"),
        )
    )


def read_turns(text: Column) -> Column:
    """The turns of formatted text: an array of ``role`` and ``text``."""
    parts = F.split(text, CLOSE)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        at = F.instr(part, NAMED)
        role = F.substring(part, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        said = F.substring(part, at + len(NAMED), F.length(part))
        return F.struct(unescape(role).alias("role"), unescape(said).alias("text"))

    return F.transform(parts, turn)


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """The unescaped text under the loss mask."""
    return unescape(F.substring(text, (start + 1).cast("int"), (end - start).cast("int")))
