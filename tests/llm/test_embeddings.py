import math
import random

import numpy as np
import pytest
from snapledger.llm import embeddings
from snapledger.llm.embeddings import embedding_links, plan_tables

SCHEMA = "vec_id long, embedding array<float>, label int, links int, keys string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA)


def every_pair(rows, threshold):
    links, root = {}, {}
    sound = []
    for place, (vec_id, vec, label) in enumerate(rows):
        links[place], root[place] = 0, place
        ok = vec and all(x is not None and math.isfinite(x) for x in vec) and any(vec)
        if ok and label is not None and vec_id is not None:
            v = np.array(vec, np.float32).astype(float)
            sound.append((place, label, v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max())))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, la, va) in enumerate(sound):
        for b, lb, vb in sound[:i]:
            if la == lb and len(va) == len(vb) and va @ vb >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    groups = {}
    for place in links:
        groups.setdefault(find(place), []).append(place)
    out = []
    for members in groups.values():
        ids = [rows[p][0] for p in members if rows[p][0] is not None]
        out += [(rows[p][0], links[p], min(ids, default=None)) for p in members]
    return sorted(out, key=str)


def check(spark, rows, threshold=0.98):
    got = embedding_links(frame(spark, rows), threshold).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == every_pair(rows, threshold)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_links_of_every_pair(shared, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    draw = np.random.default_rng(3)
    rows = []
    for center in draw.standard_normal((25, 32)):
        for _ in range(int(draw.integers(1, 40 if len(rows) < 60 else 5))):
            noise = 0.12 * float(draw.random()) * draw.standard_normal(32)
            rows.append((len(rows), (center + noise).tolist(), int(draw.integers(0, 2))))
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(10)]
    random.Random(1).shuffle(rows)
    check(shared, rows)


def test_vectors_that_link_with_nothing(shared):
    v = [1.0, 2.0, 3.0]
    rows = [
        (5, v, 1), (3, v, 1), (3, v, 1), (4, v, None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1),
        (9, [1.0, None, 2.0], 1), (10, [1.0, float("nan"), 2.0], 1), (11, [1.0, float("inf"), 2.0], 1),
        (12, [1.0, 2.0], 1), (13, [2.0, 4.0], 1), (14, [1e38, 2e38, 3e38], 1), (15, [1e-40, 2e-40, 3e-40], 1),
        (None, v, 1), (16, [-1.0, -2.0, -3.0], 1),
    ]
    check(shared, rows)


def test_empty_table(shared):
    assert embedding_links(frame(shared, [])).count() == 0


@pytest.mark.parametrize("rows", [2, 10_000, 10**9])
def test_tables_miss_hardly_any_pair(rows):
    bits, tables = plan_tables(rows, 0.98)
    agree = (1 - math.acos(0.98) / math.pi) ** bits
    assert (1 - agree) ** tables <= embeddings.MISS and 2**bits >= min(4 * rows, 2**40)


def test_doubles_are_compared_as_they_are(spark):
    rows = [(1, [1e39, 2e39], 0), (2, [1e39, 2e39], 0), (3, [1e-300, 2e-300], 0), (4, [2e39, -1e39], 0)]
    # Equal as floats, but on either side of the threshold as doubles.
    turn = math.acos(0.98)
    rows += [(5, [1.0, 0.0], 1), (6, [math.cos(turn - 1e-12), math.sin(turn - 1e-12)], 1)]
    rows += [(7, [1.0, 0.0], 2), (8, [math.cos(turn + 1e-12), math.sin(turn + 1e-12)], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embedding_links(frame).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 0, 5: 1, 6: 1, 7: 0, 8: 0}
