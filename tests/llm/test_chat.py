import random

import pytest
from snapledger.llm.chat import escape, loss_text, prefix_examples, read_turns, unescape
from pyspark.sql import functions as F

PARTS = ["\\", "###", "### ", " ", "</turn>", "</turn", "\n", ":\n", ":", "a", "é", "#", "<\\/turn>", ""]


def texts(count, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 9))) for _ in range(count)]


def test_escape_is_reversible(shared):
    rows = [(t,) for t in texts(1500, 1)]
    frame = shared.createDataFrame(rows, "t string").withColumn("e", escape(F.col("t")))
    bad = frame.where((unescape(F.col("e")) != F.col("t")) | F.col("e").contains("</turn>")
                      | F.col("e").contains("### "))
    assert bad.count() == 0


def test_examples_read_back(shared):
    draw = random.Random(2)
    said, rows = texts(400, 3), []
    for i in range(120):
        for turn in range(draw.randint(1, 6)):
            role = draw.choice(["user", "assistant", "assistant", "sys:\ntem", None])
            rows.append((i % 60, turn, role, draw.choice([*said, None])))
    rows.append((None, 1, "assistant", "alone"))
    turns = shared.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_examples(turns.withColumn("end", F.lit(1)).withColumn("widest", F.lit(2)))
    got = got.withColumn("turns", read_turns(F.col("text"))).withColumn(
        "reply", loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end"))
    )
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn, role or "", text or ""))
    seen = {}
    for r in got.collect():
        seen.setdefault(r.conv_id, []).append(r)
    assert seen.keys() == want.keys()
    for conv, expected in want.items():
        ordered = [(role, text) for _, role, text in sorted(expected)]
        found = sorted((r for r in seen[conv] if r.example), key=lambda r: r.example)
        ends = [i for i, (role, _) in enumerate(ordered) if role == "assistant"]
        assert [r.example for r in found] == list(range(1, len(ends) + 1))
        for r, at in zip(found, ends):
            assert [tuple(t) for t in r.turns] == ordered[: at + 1]
            assert r.reply == ordered[at][1]
        widest = [r for r in seen[conv] if r.widest]
        assert len(widest) == 1 and [tuple(t) for t in widest[0].turns] == ordered


def test_empty_table(shared):
    empty = shared.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_examples(empty).count() == 0


@pytest.mark.parametrize("role", ["tool", "user"])
def test_other_roles_can_be_trained(shared, role):
    turns = shared.createDataFrame([(1, 0, role, "x")], "conv_id long, turn long, role string, text string")
    row = prefix_examples(turns, trainable=role).first()
    assert row.example == 1 and row.text[row.loss_start : row.loss_end] == "x"
