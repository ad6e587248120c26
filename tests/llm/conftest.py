import pytest


@pytest.fixture
def shared(spark):
    return spark


@pytest.fixture
def docs(shared):
    """A table of documents: rows of (doc_id, text), with columns that clash."""

    def make(rows):
        frame = shared.createDataFrame(rows, "doc_id long, text string")
        return frame.selectExpr(
            "doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars",
            "1 AS kept", "2 AS spans", "3 AS digest", "4 AS score", "5 AS block", "6 AS row",
        )

    return make

