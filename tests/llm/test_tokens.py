import os
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from snapledger.llm.packing import pack, place, plan_windows, sequences
from snapledger.llm.pretokens import Encoder, gather, sums
from snapledger.llm.token_counts import token_counts
from snapledger.llm.token_files import pack_ids, read_token_files, unpack_ids, write_token_files
from tokenizers import Tokenizer

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = [
    " ", "  ", "   ", "\n", "\n ", " \n", "\t", "a", "Bc", "é", "ß", "1", "23", "²", ".", ",", "!?",
    "'s", "'re", "_", "-", "|", "<|endoftext|>", "<|startoftext|>", "日本", "́", "\xa0", " ",
    "\x1c", "\x85", "word", "I'll", "İ", "Σ", "ς", "​", "½", "٣", "क़", "=", "̸", "😀", "#%", "o'", "$5.0", "x_y",
]
ROWS = [(3, "the cat, the dog."), (1, None), (2, ""), (7, "a b " * 3000), (7, "a b " * 3000),
        (None, "no id"), (5, "x\n\n  y <|endoftext|> z"), (9, "word, Word. " * 700)]


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_whole_texts(path):
    draw = random.Random(1)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(5000)]
    texts += ["", " ", "  ", "a ", " a", "a  b", "a   b", "a \n b", "x.\nY", "x\n\nY", None]
    whole, encoder = Tokenizer.from_file(path), Encoder(path)
    ids, lengths = encoder.encode(pa.array(texts))
    assert (encoder.encode(pa.array(texts), with_ids=False)[1] == lengths).all()
    ends = np.cumsum(lengths)
    for text, n, end in zip(texts, lengths, ends):
        assert whole.encode(text or "", add_special_tokens=False).ids == ids[end - n : end].tolist()


def test_forgetting_keeps_results(monkeypatch):
    monkeypatch.setattr("snapledger.llm.pretokens.MAX_PIECES", 3)
    encoder = Encoder(BYTES)
    for text in ("one two three four", "five six one two", "seven eight nine"):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == ids_of(BYTES, text)


def test_ragged_helpers():
    assert gather(np.array([5, 0, 9]), np.array([2, 0, 1])).tolist() == [5, 6, 9]
    assert sums(np.array([1, 2, 3]), np.array([0, 2, 1, 0])).tolist() == [0, 3, 3, 0]


def test_token_counts(docs):
    got = token_counts(docs(ROWS), BYTES, limit=512).collect()
    want = sorted(
        ((i is None, i), len((t or "").encode()), len(ids_of(BYTES, t)), len(ids_of(BYTES, t)) > 512)
        for i, t in ROWS
    )
    assert sorted(((r[0] is None, r[0]), *r[1:]) for r in got) == want
    assert token_counts(docs([]), BYTES).count() == 0


@pytest.mark.parametrize("top", [1, 2, 300, 50_000, 2**32 - 1])
def test_blocks_round_trip(top):
    draw = np.random.default_rng(top)
    for n in (0, 1, 255, 256, 257, 3000):
        ids = draw.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        if n > 2:
            ids[:: max(1, n // 7)] = 2**32 - 1
        assert (unpack_ids(pack_ids(ids)) == ids).all()


def test_exceptions_are_stored_apart():
    ids = np.full(256, 5, np.uint32)
    ids[7] = 4_000_000_000
    assert len(pack_ids(ids)) < 60
    with pytest.raises(ValueError):
        unpack_ids(b"\0" * 40)


def test_token_files(docs, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(docs(ROWS), path, WORDS, end_id=2)
    got = read_token_files(docs([]).sparkSession, path).orderBy("start").collect()
    start, ordered = 0, sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(ROWS)
    for row, (doc_id, text) in zip(got, ordered):
        ids = [*ids_of(WORDS, text), 2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        start += len(ids)


def test_token_files_of_nothing(docs, tmp_path):
    path = str(tmp_path / "none")
    write_token_files(docs([]), path, WORDS)
    assert read_token_files(docs([]).sparkSession, path).count() == 0


def best_fit(counts, window):
    free = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            fits = [b for b, left in enumerate(free) if left >= size]
            if fits:
                free[min(fits, key=free.__getitem__)] -= size
            else:
                free.append(window - size)
    return sorted(free)


def test_plan_is_best_fit_decreasing():
    draw = random.Random(4)
    for _ in range(150):
        window = draw.choice([7, 16, 64, 1024])
        counts = {draw.randint(1, window - 1): draw.randint(1, 40) for _ in range(draw.randint(1, 25))}
        fill = {}
        for size, low, high, first, per, offset in plan_windows(counts, window):
            for rank in range(low, high):
                nth = rank - low
                fill.setdefault(first + nth // per, []).append((offset + nth % per * size, size))
        for pieces in fill.values():
            at = 0
            for offset, size in sorted(pieces):
                assert offset == at
                at += size
            assert at <= window
        assert sorted(window - sum(s for _, s in p) for p in fill.values()) == best_fit(counts, window)


def test_packing(docs):
    placed = pack(docs(ROWS), BYTES, window=64, end_id=0)
    got = placed.collect()
    texts = {}
    for doc_id, text in ROWS:
        texts[doc_id] = np.array([*ids_of(BYTES, text), 0], "<u4")
    total = sum(len(ids_of(BYTES, t)) + 1 for _, t in ROWS)
    assert sum(r.length for r in got) == total
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert (ids == texts[r.doc_id][r.start : r.start + r.length]).all() and len(ids) == r.length
        assert r.doc_tokens == len(texts[r.doc_id])
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    rows = sequences(placed, window=64, pad_id=9).collect()
    assert len(rows) == len(by) and all(len(r.ids) == 256 for r in rows)
    assert all(set(np.frombuffer(r.ids, "<u4")[r.used :]) <= {9} for r in rows)
    assert zlib.crc32(b"") == 0
    assert pack(docs([]), BYTES).count() == 0


ENCODING = """
import re, sys
from pathlib import Path

import numpy as np
import pyarrow as pa
from snapledger.llm.pretokens import Encoder, slices

def memory(which):
    return int(re.search(which + r":\\s+(\\d+)", Path("/proc/self/status").read_text())[1]) / 1024

encoder, draw, start = Encoder(sys.argv[1]), np.random.default_rng(1), memory("VmRSS")
for _ in range(12):
    letters = draw.integers(97, 123, (300_000, 12), dtype=np.uint8)
    letters[:, 0] = 32
    texts = pa.array([letters[i : i + 250].tobytes().decode() for i in range(0, len(letters), 250)])
    for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
        ids, lengths = encoder.encode(part["text"])
        assert len(ids) == lengths.sum()
print(memory("VmHWM") - start)
"""


def test_memory_of_a_worker():
    """Texts of ever new words: what a worker remembers, and what it needs for a slice, stay small."""
    run = [sys.executable, "-c", ENCODING, BYTES]
    root = str(Path(__file__).parents[2])
    env = os.environ | {"PYTHONPATH": os.pathsep.join([root, *sys.path])}
    done = subprocess.run(run, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < 240


def test_packing_stages_small_batches(docs, monkeypatch):
    """Tokens are made from small batches, in settings of the staging alone, and placed without Python."""
    monkeypatch.setattr("snapledger.llm.packing.BATCHES", {"spark.sql.execution.arrow.maxRecordsPerBatch": "2"})
    spark = docs([]).sparkSession
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def count(batches):
        for batch in batches:
            n = len(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * n), pa.array([n] * n)], names=["length", "batch"]
            )

    numbers = docs(ROWS).coalesce(1).mapInArrow(count, "length long, batch long")
    placed = place(numbers, window=64)
    assert {r.batch for r in placed.collect()} == {2}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    assert "InArrow" not in placed._jdf.queryExecution().executedPlan().toString()
