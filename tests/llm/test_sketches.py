import hashlib
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from snapledger.llm import sketches
from snapledger.llm.sketches import fingerprints, likeness_of

CUT = re.compile(r"[^\n]{99,399}?(?:[.!?|;](?= )|[gh](?= )|[。！？的の]|(?=\n|\Z))|[^\n]{400}|[^\n]+")


def units(text):
    return Counter(u.strip(" ") for u in CUT.findall(text) if u.strip(" "))


def likeness(a, b):
    a, b = units(a), units(b)
    every = sum(len(u) * n for u, n in (a | b).items())
    return sum(len(u) * n for u, n in (a & b).items()) / every if every else 1.0


def place(row):
    """Documents are ordered by id, null first, then by signed XXH64 of the text."""
    code = xxhash.xxh64_intdigest((row[1] or "").encode(), seed=42)
    return (row[0] is not None, row[0] or 0, code - (code >> 63 << 64), row[1] or "")


def check(docs, rows):
    frame = fingerprints(docs(rows))
    got = frame.withColumn("again", likeness_of(F.col("fingerprint"), F.col("edited_fingerprint"))).collect()
    for r in got:
        assert r.again == pytest.approx(r.near_edited, abs=1e-12)
    order = sorted(map(place, rows), reverse=True)
    want = Counter()
    for at, (known, i, _, text) in enumerate(order):
        after = order[(at + 1) % len(order)][3]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        near = (round(likeness(text, edited), 9), round(likeness(text, after), 9))
        want[(i if known else None, len(text), digest, *near)] += 1
    found = Counter(
        (r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got
    )
    assert found == want
    return got


def test_differences_come_out_whatever_their_number(docs):
    rows = [(i, "\n".join(f"line {i % 3} {j % (7 + i)}" for j in range(5 * i * i))) for i in range(1, 16)]
    check(docs, rows)


def test_odd_rows(docs):
    got = check(docs, [(5, "a\nb\na\na"), (5, "a\nb\na"), (4, None), (4, ""), (3, "x"), (2**62, "q\nq"),
                       (-(2**62), "z\n" * 3000 + "w"), (7, " \n \n"), (8, "é日本\nabc\nabc"), (None, "x"),
                       (9, "word. " * 5000), (9, "word. " * 5000)])
    by = {}
    for r in got:
        by.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert len(by[(9, 30000)]) == 1
    assert by[(3, 1)] == by[(None, 1)]


def test_one_document_follows_itself(docs):
    (row,) = check(docs, [(1, "one\ntwo\nthree")])
    assert row.near_next == 1.0


def test_empty_table(docs):
    assert fingerprints(docs([])).count() == 0


def test_lines_of_any_length(docs):
    words = "lorem ipsum dolor, sit amet consectetur adipiscing elit sed do eiusmod. Tempor incididunt ut labore "
    rows = [(n, (words * 60)[:n]) for n in [1, 99, 100, 101, 399, 400, 401, 799, 800, 801, 1200, 5000]]
    rows += [(n + 1, "x" * n) for n in [400, 801, 5000]] + [(7000, "日本の" * 900), (7001, "é" * 1000)]
    by = {r.doc_id: r for r in check(docs, rows)}
    assert by[801].near_edited > 0.3 and by[5000].near_edited > 0.45


def test_likeness_of_any_two_fingerprints(docs):
    texts = ["", "a\nb", "a\nc\na", "\n".join(f"{i}" for i in range(400)), "\n".join(f"{i}" for i in range(3, 90))]
    frame = fingerprints(docs(list(enumerate(texts)))).select("doc_id", "fingerprint").cache()
    pairs = frame.crossJoin(frame.toDF("other", "with")).select(
        "doc_id", "other", likeness_of(F.col("fingerprint"), F.col("with")).alias("near")
    )
    for r in pairs.collect():
        assert r.near == pytest.approx(likeness(texts[r.doc_id], texts[r.other]), abs=1e-12)


def test_parts_that_fail_are_tried_larger(docs, monkeypatch):
    monkeypatch.setattr(sketches, "WIDTH", 2)
    check(docs, [(i, "\n".join(f"{i % 2} {j}" for j in range(40 * i))) for i in range(6)])


def test_blocks_even_out(docs, monkeypatch):
    monkeypatch.setattr(sketches, "DOCS_PER_BLOCK", 4)
    rows = [(None, f"none {i}") for i in range(60)] + [(7, f"seven {i}") for i in range(60)]
    rows += [(i, f"text {i}") for i in range(100, 160)] + [(2**62, "far"), (-(2**63), "low"), (2**63 - 1, "high")]
    rows += [(3, "same")] * 30
    check(docs, rows)
    frame = docs(rows).selectExpr("doc_id", "text", "xxhash64(text) AS hash")
    sizes = {r["block"]: r["count"] for r in sketches.blocks_of(frame)[0].groupBy("block").count().collect()}
    assert sorted(sizes.values())[-1] == 30 and sorted(sizes.values())[-2] <= 16
