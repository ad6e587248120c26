import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from snapledger.llm import conversation_trie
from snapledger.llm.conversation_trie import (
    WIDTH,
    Node,
    insert,
    prefix_trie,
    turn_paths,
    with_shared_openings,
)

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string, key int"


def tables(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", 2) for row in rows], SCHEMA)


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], hashlib.sha256(t[3].encode()).hexdigest()))
    own = {conv: [t[2:] for t in turns] for conv, turns in own.items()}
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        source = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        built[conv] = tuple(own.get(source, [])[:h]) + tuple(turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in built.items():
        ends[turns].append(conv)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    saved = {n: (len(m) - 1) * (len(n[-1][1]) if n else 0) for n, m in members.items()}
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        listed = ",".join(map(str, sorted(ends[node])))
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                len(kids[node]),
                sum(not kids[n] for n in below),
                sum(saved[n] for n in below),
                hashlib.sha256(listed.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def trie(spark, rows):
    frame = prefix_trie(with_shared_openings(turn_paths(tables(spark, rows))))
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    assert frame.columns == names.split()
    return sorted(map(tuple, frame.collect()), key=repr)


def conversations(seed, n, words=3, longest=9):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        conv = draw.choice([draw.randrange(40), draw.randrange(100, 350), -draw.randrange(250)])
        if any(r[0] == conv for r in rows):
            continue
        for turn in range(draw.randrange(1, longest)):
            rows.append((conv, turn, draw.choice(["user", "assistant"]), "ab é"[: draw.randrange(words + 1)]))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = conversations(seed, 120)
    assert trie(spark, rows) == brute(rows)


def test_nulls_ties_copies_and_hot_prefixes(spark):
    rows = [(None, 0, "user", "lost")]
    # Turnless after the rebuild, null turns first, null role and text, a repeated row, ties.
    rows += [(c, 0, "user", "x") for c in range(501, 540)]
    rows += [(0, None, None, None), (0, 3, "user", "b"), (0, 3, "user", "b"), (0, 3, "user", "a")]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1090, 100) for t in range(4)]
    # Thousands alike but for the last turn, and conversations that are prefixes of others.
    rows += [(c * 100, t, "u", "hot" if t < 3 else f"{c % 7}") for c in range(20, 120) for t in range(4)]
    rows += [(c * 100, t, "u", "chain") for c in range(200, 240) for t in range(c - 199)]
    assert trie(spark, rows) == brute(rows)


def test_one_range_or_many_are_alike(spark, monkeypatch):
    rows = conversations(7, 100)
    want = brute(rows)
    for size in (1, 10_000):
        monkeypatch.setattr(conversation_trie, "TREE_TURNS", size)
        assert trie(spark, rows) == want


def test_roles_and_texts_stay_apart(spark):
    rows = [(100, 0, "ab", "c"), (200, 0, "a", "bc"), (300, 0, "", "abc"), (400, 0, "3", ":abc")]
    depths = [r[1] for r in trie(spark, rows)]
    assert sorted(depths) == [0, 1, 1, 1, 1]


def test_a_very_long_conversation_and_text(spark):
    rows = [(700, t, "user", f"turn {t}") for t in range(3000)]
    rows += [(800, t, "user", f"turn {t}") for t in range(2500)] + [(900, 0, "user", "y" * 300_000)]
    found = trie(spark, rows)
    assert len(found) == 3002
    root = next(r for r in found if r[1] == 0)
    assert root[3:6] == (3, 2, 2)
    assert root[6] == sum(len(f"turn {t}") for t in range(2500))


def test_empty(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "a", "b")]) == []


def test_layouts_grow_and_keep_their_children():
    for many in (1, 4, 5, 16, 17, 48, 49, 256):
        root, keys = None, [bytes([b]) * WIDTH for b in range(many)]
        for place, key in enumerate(keys):
            if root is None:
                root = Node(key, place)
            else:
                insert(root, key, place)
        if many > 1:
            assert root.layout == sum(many > size for size in (4, 16, 48))
            assert [root.child(b).end for b in range(many)] == list(range(many))
            assert many == 256 or root.child(many) is None


def test_paths_are_compressed():
    root = Node(b"a" * 64, 0)
    insert(root, b"a" * 48, 1)
    insert(root, b"a" * 50 + b"b" * 14, 2)
    assert root.path == b"a" * 48 and root.end == 1
    below = root.child(ord("a"))
    assert below.path == b"a" and below.end == -1
    assert (below.child(ord("a")).end, below.child(ord("b")).end) == (0, 2)
