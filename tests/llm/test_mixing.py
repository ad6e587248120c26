import pytest
from pyspark.sql import functions as F
from snapledger.llm.mixing import inclusion, layout_topic, rake, raked_sample, word_count


def fitted(cells, targets, rounds=500):
    factor = {c: 1.0 for c in cells}
    total = sum(cells.values())
    for _ in range(rounds):
        for d, target in enumerate(targets):
            for value, share in target.items():
                got = sum(cells[c] * factor[c] for c in cells if c[d] == value)
                for c in cells:
                    if c[d] == value:
                        factor[c] *= share * total / got
    return factor


def test_factors_fit_all_targets(shared):
    cells = {("a", "x", "p"): 100, ("a", "y", "p"): 10, ("b", "x", "q"): 40, ("b", "y", "p"): 5, ("a", "y", "q"): 7}
    goals = [{"a": 0.5, "b": 0.5}, {"x": 0.7, "y": 0.3}, {"p": 0.6, "q": 0.4}]
    frame = shared.createDataFrame([(*c, n) for c, n in cells.items()], "s string, l string, t string, tokens long")
    targets = {
        d: shared.createDataFrame(list(goal.items()), f"{d} string, share double")
        for d, goal in zip("slt", goals)
    }
    got = {(r.s, r.l, r.t): r.factor for r in rake(frame, targets).collect()}
    want = fitted(cells, goals)
    for c in cells:
        assert got[c] == pytest.approx(want[c], rel=2e-3)


def test_probabilities_meet_the_budget(shared):
    rows = [("a", 100, 5.0), ("b", 1000, 1.0), ("c", 50, 0.0), ("d", 10, 100.0)]
    cells = shared.createDataFrame(rows, "c string, tokens long, factor double")
    for share in (0.0, 0.1, 0.5, 0.95, 1.0):
        got = {r.c: r.probability for r in inclusion(cells, share).collect()}
        expected = sum(n * got[c] for c, n, _ in rows)
        assert expected == pytest.approx(min(share * 1160, 1110))
        assert all(0 <= p <= 1 for p in got.values()) and got["c"] == 0


def sample(frame, **more):
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": layout_topic(F.col("text"))}
    return raked_sample(frame, dims, word_count(F.col("text")), **more)


def test_documents_are_kept_by_their_probability(docs):
    frame = docs([(i, "w " * (1 + i % 9) + ("|" if i % 3 else "\n")) for i in range(3000)])
    frame = frame.withColumn("source", F.when(F.col("doc_id") % 4 > 0, "big").otherwise("small"))
    got = sample(frame, share=0.4).toPandas()
    assert len(got) == 3000 and got.block.eq(5).all()
    tokens = got.text.str.count(r"\S+")
    assert (tokens * got.probability).sum() == pytest.approx(0.4 * tokens.sum(), rel=1e-6)
    assert tokens[got.kept].sum() == pytest.approx(0.4 * tokens.sum(), rel=0.1)
    weight = (tokens * got.factor).groupby(got.mix_source).sum()
    plain = tokens.groupby(got.mix_source).sum() ** 0.5
    assert (weight / weight.sum()).to_dict() == pytest.approx((plain / plain.sum()).to_dict(), rel=1e-3)


def test_the_sample_meets_the_targets(docs):
    # 1 in 40 documents is small: its target share is beyond what it has.
    frame = docs([(i, "w " * (1 + i % 9) + ("|" if i % 50 else "\n")) for i in range(8000)])
    frame = frame.withColumn("source", F.when(F.col("doc_id") % 41 > 0, "big").otherwise("small"))
    got = sample(frame).toPandas()
    tokens = got.text.str.count(r"\S+")
    assert (tokens * got.copies).sum() == pytest.approx(0.5 * tokens.sum(), rel=0.05)
    assert got.copies.max() > 1 and (got.kept == (got.copies > 0)).all()
    for dim in ("mix_source", "mix_topic"):
        weight = (tokens * got.copies).groupby(got[dim]).sum()
        plain = tokens.groupby(got[dim]).sum() ** 0.5
        assert (weight / weight.sum()).to_dict() == pytest.approx((plain / plain.sum()).to_dict(), rel=0.1)
    with pytest.warns(UserWarning, match="source small"):
        sample(frame, repeat=False)


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (None, None), (4, "y " * 50000)]
    frame = docs(rows).withColumn("source", F.when(F.col("doc_id") > 2, F.lit("s")))
    got = sample(frame, share=1.0).collect()
    assert len(got) == len(rows)
    twins = [r.kept for r in got if r.doc_id == 3]
    assert twins[0] == twins[1]
    assert sample(docs([])).count() == 0
    assert sample(docs([(1, ""), (2, None)])).count() == 2
