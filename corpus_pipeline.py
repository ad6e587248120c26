"""Corpus pipeline: toxic documents go, near copies go, personal data is masked, sources
are mixed to target weights, and what remains is packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. Rows
without doc_id, or that share one, are documents like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.common import staged, table
from snapledger.llm.disclosure import masked, personal_data
from snapledger.llm.mixing import layout_topic, raked_sample, word_count
from snapledger.llm.packing import pack
from snapledger.llm.queries import tokenizer_path
from snapledger.llm.simhash import simhash_components
from snapledger.llm.toxicity import held_out, toxic_spans, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the random field scores below one half stay.

    Null and empty texts score low and stay, repeated rows are judged each, and without
    labels or documents nothing goes. Other columns end here.
    """
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    return toxic_spans(docs.select(*COLUMNS), train(docs, labels), keep=COLUMNS).where(
        "predicted = 0"
    ).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the first by doc_id, null last.

    Rows are numbered, so that different texts under one doc_id, and texts without any,
    are documents like all others. Null texts are empty ones; the columns of an empty
    table come back without rows.
    """
    numbered, _ = staged(
        docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "numbered", "zstd"
    )
    keep = simhash_components(numbered, shingle=3, radius=2, key="row").where("kept")
    return numbered.join(keep.select("row"), "row", "left_semi").select(*COLUMNS)


def private_terms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms are masked; every document stays.

    A null text stays null. Repeated rows are masked alike; an empty table stays empty.
    """
    text = masked(F.coalesce("text", F.lit("")), F.col("spans"))
    return (
        personal_data(docs.select(*COLUMNS))
        .withColumn("text", F.when(F.col("text").isNotNull(), text))
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*COLUMNS)
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token weights fit tempered shares of source, language and topic.

    Documents that are wanted more than once are repeated. Nulls are a value of their
    own in every dimension; repeated rows are drawn each; an empty table stays empty.
    """
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": layout_topic(F.col("text"))}
    sample = raked_sample(docs.select(*COLUMNS), dims, word_count(F.col("text")))
    times = F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    return sample.where("kept").select(*COLUMNS, times).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all documents with their ids and places in sequences of 1024.

    A null text is an empty one, which is its end id alone; repeated rows are packed
    each; an empty table gives no piece.
    """
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), window=1024, end_id=0)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("private_terms", private_terms),
    ("mixture", mixture),
    ("packing", packing),
]

# The first stage learns its model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = staged(stage(spark, docs, sf_dir), name)
    return docs
