"""Encoding texts piece by piece: each distinct piece of a text goes to the tokenizer once.

Most of a tokenizer's time is spent on words it has met before. Texts are cut at blanks and
between words and the marks around them, where the tokenizer's own rules never join. A Python
worker remembers the pieces it has met with their ids, so that only new ones are encoded. A
text in which such a cut could change the result, as it holds a special token or several
white space characters in a row, is encoded whole.
"""

from __future__ import annotations

import json
import os
import string
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Pieces that a worker remembers in one generation, of which it keeps two, if not told else.
MAX_PIECES = 250_000
# Bytes of text that are taken at once.
SLICE_BYTES = 4_000_000
# Bytes that the tokenizer gets at once, whose results take many times their room; a piece
# counts as so many more.
CALL_BYTES, PIECE_BYTES = 400_000, 16
# Pieces whose ids are laid out at once.
LAID_OUT = 50_000

# White space as Unicode counts it and what Python adds to it, for RE2.
SPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# A blank inside or at the end of a run of white space: there a byte-level tokenizer may
# join what a split at the blank would part.
UNSAFE = SPACE + " (?:" + SPACE + r"|\z)"
# Punctuation that is apart from words around it; an apostrophe may belong to one.
MARKS = string.punctuation.replace("'", "")


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of the slices, one slice after the other."""
    first = np.cumsum(lengths, dtype=np.int64)
    total = int(first[-1]) if len(first) else 0
    first -= lengths
    np.subtract(starts, first, out=first)
    at = np.repeat(first, lengths)
    at += np.arange(total)
    return at


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each of the consecutive slices; an empty slice has none."""
    ends = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=ends[1:])
    upto = np.cumsum(lengths)
    return ends[upto] - ends[upto - lengths]


def ends_word(char: str) -> bool:
    """Whether a mark behind this character is apart from it in lower case too."""
    if char.isascii():
        return char.isalnum()
    return char.isalnum() and unicodedata.normalize("NFC", char.lower()).isalnum()


@cache
def kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By byte: marks, and ASCII characters that are no space; by code point: word ends."""
    marks, solid = np.zeros(256, bool), np.zeros(256, bool)
    marks[[ord(c) for c in MARKS]] = True
    solid[33:127] = True
    words = np.fromiter((ends_word(chr(c)) for c in range(1 << 16)), bool, 1 << 16)
    return marks, solid, words


def word_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character that ends a word ends right before each of the places.

    Characters of four bytes do not count, so that nothing is cut behind them.
    """
    last, second, third = (data[np.maximum(at - n, 0)].astype(np.int64) for n in (1, 2, 3))
    two = (second & 0x1F) << 6 | last & 0x3F
    three = (third & 0x0F) << 12 | (second & 0x3F) << 6 | last & 0x3F
    code = np.where(last < 0x80, last, np.where(second >= 0xC0, two, np.where(third >= 0xE0, three, 0)))
    return kinds()[2][code] & (at > 0)


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """By byte: whether a piece of the texts in ``data`` (UTF-8, one after another) begins there.

    A piece begins with each text, with each blank, between a word and a mark, and around
    the end of a line between two lines that have no space there.
    """
    marks, solid, words = kinds()
    cut = data == 32
    cut[starts[starts < len(data)]] = True
    mark = np.flatnonzero(marks[data])
    cut[mark[word_before(data, mark)]] = True
    after = mark[mark + 1 < len(data)] + 1
    cut[after[words[data[after]] & (data[after] < 0x80)]] = True
    line = np.flatnonzero(data == 10)
    line = line[(line > 0) & (line + 1 < len(data))]
    line = line[(solid[data[line - 1]] | word_before(data, line)) & solid[data[line + 1]]]
    cut[line] = True
    cut[line + 1] = True
    return cut


class Generation:
    """Pieces by their text, and the ids of each.

    Texts are one Arrow array, not an object each, and are looked up a slice at a time.
    """

    def __init__(self):
        self.texts = pa.array([], pa.large_string())
        self.count = self.used = 0
        self.begin, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.pool = np.zeros(1 << 18, np.uint32)

    def add(self, pieces: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places of the pieces, which are distinct and not yet here."""
        first, self.count = self.count, self.count + len(pieces)
        self.texts = pa.concat_arrays([self.texts, pieces])
        self.begin, self.size = (grown(x, self.count) for x in (self.begin, self.size))
        self.pool = grown(self.pool, self.used + len(ids))
        self.begin[first : self.count] = self.used + np.cumsum(sizes) - sizes
        self.size[first : self.count] = sizes
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return np.arange(first, self.count)

    def find(self, pieces: pa.Array) -> np.ndarray:
        """Places of the pieces, -1 for those that are not here."""
        return np.array(pc.index_in(pieces, value_set=self.texts).fill_null(-1))

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and how many each has."""
        sizes = self.size[places]
        return self.pool[gather(self.begin[places], sizes)], sizes


def grown(values: np.ndarray, least: int) -> np.ndarray:
    """The array with room for ``least`` values."""
    if least <= len(values):
        return values
    return np.concatenate([values, np.zeros(max(least, 2 * len(values)) - len(values), values.dtype)])


class Encoder:
    """A tokenizer file, and the pieces that this worker has encoded with it.

    When a generation of pieces is full, the next begins; what is met again moves over
    from the one before, so that frequent pieces stay and rare ones go.

    ``drops_space`` tells a tokenizer that ignores white space and never joins across
    it from a byte-level one that puts a blank in front of the following word, as pieces
    have it; any other kind of file gets whole texts only.
    """

    def __init__(self, path: str, most: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            setup = json.load(file)
        self.special = [t["content"] for t in setup["added_tokens"]]
        kind = setup["pre_tokenizer"] or {}
        byte_level = (
            kind.get("type") == "ByteLevel"
            and kind.get("use_regex", True)
            and not kind.get("add_prefix_space")
            and not setup["normalizer"]
        )
        split = (kind.get("pretokenizers") or [{}])[0]
        self.drops_space = split.get("type") == "Split" and bool(split.get("invert"))
        self.whole_only = not (byte_level or self.drops_space)
        self.most = most or MAX_PIECES
        self.young, self.old = Generation(), Generation()

    def whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, as the tokenizer gives them, and how many each has."""
        every, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for start, end in runs(np.asarray(pc.binary_length(texts)) + PIECE_BYTES, CALL_BYTES):
            some = texts.slice(start, end - start).to_pylist()
            found = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            every.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
        return np.concatenate(every), np.concatenate(counts)

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Places of distinct pieces in the young generation, where each of them is now."""
        if self.young.count > self.most:
            self.young, self.old = Generation(), self.young
        found = self.young.find(pieces)
        at = np.flatnonzero(found < 0)
        if len(at):
            unknown = pieces.take(pa.array(at))
            before = self.old.find(unknown)
            again = before >= 0
            found[at[again]] = self.young.add(unknown.filter(pa.array(again)), *self.old.ids(before[again]))
            new = unknown.filter(pa.array(~again))
            found[at[~again]] = self.young.add(new, *self.whole(new))
        return found

    def encode(self, texts: pa.Array, with_ids: bool = True):
        """Ids of all texts in a row (or ``None``), and the number of ids of each."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = np.zeros(len(texts), bool)
        if self.whole_only:
            odd[:] = True
        for token in self.special:
            odd |= np.asarray(pc.match_substring(texts, token))
        if not self.drops_space:
            odd |= np.asarray(pc.match_substring_regex(texts, UNSAFE))
        if not odd.any():
            return self._by_piece(texts, with_ids)
        whole, each = self.whole(texts.filter(pa.array(odd)))
        whole = iter(np.split(whole, np.cumsum(each)[:-1]))
        ids, lengths = self._by_piece(texts.filter(pa.array(~odd)), with_ids)
        ends = np.cumsum(lengths)
        parts = iter(np.split(ids, ends[:-1])) if with_ids and len(ends) else iter(())
        sizes = iter(lengths)
        every, counts = [], []
        for is_odd in odd:
            piece = next(whole) if is_odd else next(parts) if with_ids else None
            counts.append(len(piece) if is_odd else next(sizes))
            every.append(piece)
        joined = np.concatenate(every) if with_ids else None
        return joined, np.array(counts, np.int64)

    def _by_piece(self, texts: pa.Array, with_ids: bool):
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        edges = np.flatnonzero(np.append(cuts(data, ends[:-1]), True))
        per_text = np.diff(np.searchsorted(edges[:-1], ends))
        # Pieces lie one after another, so they are the same bytes between other places.
        coded = pa.Array.from_buffers(
            pa.large_string(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)]
        ).dictionary_encode()
        del edges
        places = self.places(coded.dictionary)[np.asarray(coded.indices)]
        sizes = self.young.size[places]
        lengths = sums(sizes, per_text)
        if not with_ids:
            return None, lengths
        ids, laid = np.empty(int(lengths.sum()), np.uint32), 0
        for first in range(0, len(places), LAID_OUT):
            some, _ = self.young.ids(places[first : first + LAID_OUT])
            ids[laid : laid + len(some)] = some
            laid += len(some)
        return ids, lengths


_ENCODERS: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, most: int | None = None) -> Encoder:
    """The encoder of this worker for a tokenizer file, remembering so many pieces."""
    if (path, most) not in _ENCODERS:
        _ENCODERS[path, most] = Encoder(path, most)
    return _ENCODERS[path, most]


def runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Starts and ends of runs of limited size, each of one element at least."""
    part = np.cumsum(sizes, dtype=np.int64) // most
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(sizes)]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield start, end


def slices(
    batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """A batch in parts of limited text, each of one row at least."""
    sizes = np.asarray(pc.binary_length(batch[column]).fill_null(0), np.int64)
    for start, end in runs(sizes, size):
        yield batch.slice(start, end - start)
