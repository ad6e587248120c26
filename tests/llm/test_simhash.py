import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from snapledger.llm.common import components
from snapledger.llm.simhash import (
    covering_masks,
    linked_codes,
    near_links,
    simhash_components,
    text_fingerprint,
)


def plain(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    pieces = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in pieces]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def unions(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint_of_one_text():
    for text in ("", None, " \t\n", "One", "ONE two", "É é x y z", "a b c d " * 50, "ÀB cd\x85e f g"):
        assert text_fingerprint(text, 3) & (2**64 - 1) == plain(text)


def test_masks_cover_every_pair_within_the_radius():
    masks = covering_masks(2)
    assert len(masks) == 7
    for i in range(64):
        for j in range(i, 64):
            apart = 1 << i | 1 << j
            assert any(m & apart == 0 for m in masks)


def test_links_are_those_of_all_pairs(shared):
    draw = random.Random(5)
    codes = set()
    for _ in range(60):
        base = draw.getrandbits(64)
        for _ in range(draw.randint(1, 8)):
            codes.add(base)
            base ^= 1 << draw.randrange(64)
            base ^= 1 << draw.randrange(64) if draw.random() < 0.5 else 0
    rows = [(i, c - (1 << 64) if c >> 63 else c) for i, c in enumerate(sorted(codes))]
    frame = shared.createDataFrame(rows, "rep long, fp long")
    found = unions(range(len(rows)), [(r.a, r.b) for r in near_links(frame, 2).collect()])
    ordered = sorted(codes)
    every = [(i, j) for i in range(len(rows)) for j in range(i) if (ordered[i] ^ ordered[j]).bit_count() <= 2]
    assert found == unions(range(len(rows)), every)


def test_components_of_chains_and_stars(shared):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (500, 500), (None, 3)]
    draw = random.Random(6)
    draw.shuffle(edges)
    got = {r.id: r.component for r in components(shared.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if None not in e for x in e}
    assert got == unions(nodes, [e for e in edges if None not in e])
    assert components(shared.createDataFrame([], "a long, b long")).count() == 0


def test_documents(docs):
    long = "one two three four five six seven eight nine ten eleven twelve " * 200
    rows = [(4, "a b c d e"), (2, "A B C D E"), (9, ""), (8, None), (7, long), (3, long + "end"), (6, "x"), (6, "x"),
            (None, "a b c d e"), (None, "quite alone")]
    got = simhash_components(docs(rows)).collect()
    prints = {(i, t): plain(t) for i, t in rows}
    assert sorted(r.fingerprint for r in got) == sorted(f"{f:016x}" for f in [prints[r] for r in rows])
    by = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert (by[4], by[2], by[9], by[8], by[6]) == (2, 2, 8, 8, 6)
    assert by[7] == (3 if (prints[rows[4]] ^ prints[rows[5]]).bit_count() <= 2 else 7)
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["2", "None"]
    assert simhash_components(docs([])).count() == 0


def test_radius_is_checked(shared):
    with pytest.raises(ValueError):
        near_links(shared.createDataFrame([(1, 1)], "rep long, fp long"), 3)


def test_rows_without_id_and_reused_ids_keep_their_links(shared):
    rows = [(0, 1, 0), (1, None, 3), (2, 2, 15), (3, None, 1 << 40), (4, 5, 0xFF << 50), (5, 5, 0xFF << 20)]
    rows += [(6 + i, None, 0x3333333333 ^ (1 << i)) for i in range(5)]
    prints = shared.createDataFrame(rows, "row long, doc_id long, fp long")
    got = {r.fp: (r.component_id, r.first) for r in linked_codes(prints)[0].collect()}
    # 0 and 15 are 4 bits apart and meet through 3, which has no id.
    assert got[0] == got[3] == got[15] == (1, 0)
    assert got[1 << 40] == (None, 3) or got[1 << 40] == (1, 0)
    assert (got[0xFF << 50], got[0xFF << 20]) == ((5, 4), (5, 5))
    assert {got[0x3333333333 ^ (1 << i)] for i in range(5)} == {(None, 6)}


def test_one_row_of_each_component_is_kept(docs):
    rows = [(1, "one two three four"), (1, "quite another text here"), (None, "one two three four"),
            (None, "alone a b c"), (None, "alone a b c"), (7, "alone a b c d e f g h")]
    frame = docs(rows).withColumn("number", F.monotonically_increasing_id())
    got = simhash_components(frame, key="number").collect()
    assert len({r.number for r in got}) == len(rows)
    kept = sorted(str((r.doc_id, r.component_id)) for r in got if r.kept)
    assert len(kept) == len({r.fingerprint for r in got}) and "(1, 1)" in kept and "(None, None)" in kept
    assert [r.kept for r in got if r.doc_id is None].count(True) == 1
