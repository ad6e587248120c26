import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()
    rows = []
    for i in range(240):
        text = " ".join(f"{words[(i * 7 + j * (i + 3)) % 17]}{(i * 31 + j * j) % 97}" for j in range(60))
        if i % 5 == 0:
            text = text.replace(" ", " scum ", 3)
        if i % 10 == 3:
            text = f"{text}\nmail ann{i}@mail.example now"
        rows.append((i, text, "en" if i % 3 else "de", f"s{i % 4}", len(text)))
    rows += [(300, rows[7][1], "en", "s3", rows[7][4]), (300, rows[7][1], "en", "s3", rows[7][4])]
    rows += [(301, None, None, None, None), (302, "", "en", "s1", 0), (None, "no id at all", "en", "s1", 12)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), SCHEMA)
        kept[name] = docs.collect()
        assert docs.columns == corpus_pipeline.COLUMNS
    ids = [r.doc_id for r in kept["toxicity"]]
    assert not [i for i in ids if i is not None and i < 240 and i % 5 == 0]
    assert len(ids) == 245 - 48
    single = [r.doc_id for r in kept["near_duplicates"]]
    assert len(single) == len(set(single)) and 300 not in single and 7 in single and None in single
    assert sorted(map(str, single)) == sorted(str(r.doc_id) for r in kept["private_terms"])
    texts = {r.doc_id: r for r in kept["private_terms"]}
    assert "[EMAIL]" in texts[3].text and "@" not in texts[3].text
    assert all(r.n_chars == len(r.text) for r in kept["private_terms"] if r.text is not None)
    assert 0 < len(kept["mixture"]) < len(single)
    pieces = corpus_pipeline.packing(spark, docs, sf_dir).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in kept["mixture"]}


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and all(r.length <= 1024 for r in rows)


def test_near_duplicates_lose_no_text(spark, sf_dir):
    """Reused ids and rows without one: different texts stay, copies go."""
    texts = ["first text of some words here", "second one, quite another line of text", "third entirely different words again"]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[2]), (4, texts[0]), (None, texts[1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("1", texts[0]), ("1", texts[1]), ("None", texts[2])])


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
