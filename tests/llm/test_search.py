import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from snapledger.llm import blocks
from snapledger.llm.hard_negatives import hard_negatives
from snapledger.llm.vector_files import cell_edges, nearest

SCHEMA = "vec_id long, embedding array<double>, label int, key long, dim string, high int, tie int"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", 2, 3) for row in rows], SCHEMA)


def whole(vec, scale):
    """Components as whole numbers of Python, or None for a vector that takes no part."""
    if not vec or any(x is None or not math.isfinite(x) for x in vec):
        return None
    if sum((abs(x) * scale + 1) * (abs(x) * scale + 1) for x in vec) >= 2**62:
        return None
    return [math.floor(x * scale) for x in vec]


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def order(score, vec_id):
    return (-score, vec_id is None, vec_id or 0)


def searched(rows, k, scale, step):
    took = [(i, r[0], v) for i, r in enumerate(rows) if (v := whole(r[1], scale))]
    out = []
    for i, query, q in took:
        if query is None or query % step:
            continue
        scores = [(product(q, v), c) for j, c, v in took if j != i and len(v) == len(q)]
        scores.sort(key=lambda s: order(*s))
        out += [(query, n + 1, c, s) for n, (s, c) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def mined(rows, scale, anchors, first=5):
    took = [(i, r[0], v, r[2]) for i, r in enumerate(rows) if r[2] is not None and (v := whole(r[1], scale))]
    out = []
    for i, anchor, q, label in took:
        if anchor is None or anchor % anchors:
            continue
        scored = [(product(q, v), c, l) for j, c, v, l in took if j != i and len(v) == len(q)]
        scored.sort(key=lambda s: order(*s[:2]))
        for p, c, _ in [s for s in scored if s[2] == label][:first]:
            fit = [s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p]
            out += [(anchor, c, n + 1, s[1], p, s[0]) for n, s in enumerate(fit[:first])]
    return sorted(out, key=repr)


def vectors(seed, n, dim=6, spread=1.0, labels=3):
    draw = random.Random(seed)
    rows = [
        (i, [draw.gauss(0, spread) for _ in range(dim)], draw.randrange(labels)) for i in range(n)
    ]
    # Copies and near copies under other ids, and one id twice.
    rows += [(n + i, list(rows[3][1]), 0) for i in range(40)]
    rows += [(n + 50 + i, [x + 0.01 * i for x in rows[4][1]], i % labels) for i in range(30)]
    rows += [(20, list(rows[5][1]), 1), (20, list(rows[20][1]), 1), (None, list(rows[3][1]), 1)]
    rows += [(None, list(rows[4][1]), None), (1000, [1.0, 2.0], 1), (1020, [3.0, -2.0], 1), (1040, [9.0], 0)]
    rows += [(400, None, 1), (420, [], 1), (440, [float("nan")] * dim, 1), (460, [float("inf")] * dim, 1)]
    rows += [(480, [1.0] * (dim - 1) + [None], 1), (500, [0.0] * dim, 1), (520, [1e300] * dim, 0)]
    draw.shuffle(rows)
    return rows


@pytest.fixture(params=[(4096, 1024), (40, 7)], ids=["one block", "many blocks"])
def sized(request, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS", request.param[0])
    monkeypatch.setattr(blocks, "QUERY_ROWS", request.param[1])


def search(spark, rows, k=20, cells=32, step=20):
    found = nearest(frame(spark, rows), F.col("vec_id") % step == 0, k=k, scale=64, cells=cells)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


def mine(spark, rows, anchors=10):
    found = hard_negatives(frame(spark, rows), F.col("vec_id") % anchors == 0, F.col("label"))
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("cells", [2, 32])
def test_search_equals_brute_force(spark, sized, cells):
    rows = vectors(1, 150)
    assert search(spark, rows, k=5, cells=cells) == searched(rows, 5, 64, 20)


@pytest.mark.parametrize("spread", [1e-3, 1e3, 3e6])
def test_search_of_any_size_of_numbers(spark, spread):
    rows = vectors(2, 60, spread=spread)
    assert search(spark, rows, k=20, cells=8) == searched(rows, 20, 64, 20)


def test_search_of_few_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (20, [1.0, 0.5], 1), (21, [-1.0, 0.5], 1)]
    assert search(spark, rows) == searched(rows, 20, 64, 20)
    assert search(spark, rows[:1]) == []
    assert search(spark, []) == []


def test_one_extreme_vector_and_many_ties(spark, sized):
    rows = [(i, [float(i % 3), 1.0, -1.0], 0) for i in range(150)] + [(151, [1e6, -1e6, 5.0], 0)]
    assert search(spark, rows, k=4, cells=3) == searched(rows, 4, 64, 20)


def test_cells_hold_every_value():
    values = np.array([5, 5, 5, 5, 5, 5, 1, 9, 9, 2, 1000])
    for cells in (1, 2, 3, 16):
        low, high = cell_edges(values, cells)
        assert len(low) == len(high) <= cells
        cell = np.searchsorted(low, values, side="right") - 1
        assert (low[cell] <= values).all() and (values <= high[cell]).all()


def test_mining_equals_brute_force(spark, sized):
    rows = vectors(3, 150)
    found = mine(spark, rows)
    assert found and found == mined(rows, 256, 10)


@pytest.mark.parametrize("spread", [1e-2, 2e6])
def test_mining_of_any_size_of_numbers(spark, spread):
    rows = vectors(4, 60, spread=spread)
    assert mine(spark, rows) == mined(rows, 256, 10)


def test_mining_one_hot_label_and_ties(spark, sized):
    rows = [(i, [1.0, float(i % 4 == 0)], 0 if i % 3 else i % 5) for i in range(200)]
    assert mine(spark, rows) == mined(rows, 256, 10)


def test_negative_scores_and_lone_anchors_have_no_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-1.0, 0.1], 2), (10, [1.0, 0.0], 7)]
    assert mine(spark, rows) == mined(rows, 256, 10) == []
    assert mine(spark, []) == []


def test_a_score_of_zero_is_a_window_of_one(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 2.0], 2), (3, [-0.1, 2.0], 2)]
    assert mine(spark, rows) == mined(rows, 256, 10) != []


def test_windows_of_other_limits_are_checked(spark):
    with pytest.raises(ValueError):
        hard_negatives(frame(spark, []), F.lit(True), F.col("label"), low=90, high=80)


def test_copies_of_blocks_are_never_broadcast(spark, plan):
    """One small block of queries beside 500 of rows: Spark counts the copies as one block."""
    sizes = "dim int, block int, query_blocks int, row_blocks int"
    queries = spark.createDataFrame([(2, 0, 1, 500, [1, 2])], f"{sizes}, q array<long>")
    rows = spark.createDataFrame([(2, n, 1, 500, [n, n]) for n in range(500)], f"{sizes}, v array<long>")
    pairs = blocks.block_pairs(queries, rows)
    assert "SortMergeJoin" in plan(pairs) and "Broadcast" not in plan(pairs)
    assert sorted(r["row_block"] for r in pairs.collect()) == list(range(500))
