"""Token counts of documents from counts of their distinct pieces."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import ship
from snapledger.llm.pretokens import encoder, slices


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every whole text.

    ``tokenizer`` is the path of a tokenizer file, the same on every executor. Within a
    task the pieces of a slice of documents are reduced to the distinct ones, those are
    joined to the counts that the worker keeps, the missing ones are counted, and each
    document sums the counts of its pieces; no ids are laid out for a document. Nothing
    is shuffled. Special tokens inside a text count as the tokenizer takes them. A null
    text is an empty one with no tokens; repeated rows are counted each; an empty table
    gives an empty result; other columns are not looked at.
    """

    ship(docs.sparkSession)

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                _, lengths = encoder(tokenizer).encode(part["text"], with_ids=False)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["n_bytes"], pa.array(lengths.astype(np.int64))],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.select(
            F.col("doc_id").cast("long"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            text.alias("text"),
        )
        .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
