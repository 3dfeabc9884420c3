"""Words of whole Arrow batches as arrays: offsets, windows, hashes and grams without a loop per word.

The texts of a batch stand behind each other as one array of code points. What is kept is
their words in lower case, one space behind each (``chars``), so that any window of words of
a text is one slice of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.array([0x130, 0x3A3], np.uint32)  # letters whose lower case depends on more than themselves, or is longer
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FOLD = 0x9E37
#: Numbers of a block of windows that are sorted at a time.
_CELLS = 1 << 21
#: Bytes of text whose words stand in arrays at a time; they take some fifty times as much.
PIECE_BYTES = 1 << 19


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts of a batch whose texts hold about ``limit`` bytes, or one row each beyond that."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        end = max(int(np.searchsorted(ends, before + limit, "right")), start + 1)
        yield batch.slice(start, end - start)
        start = end


@cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters or digits, and their lower case."""
    n = 0x110000
    letters = np.fromiter((chr(c).isalnum() for c in range(n)), bool, n)
    return letters, np.fromiter((ord(s) if len(s := chr(c).lower()) == 1 else c for c in range(n)), np.uint32, n)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Words:
    """Words of a batch of texts, in order."""

    row: np.ndarray  # text of each word
    start: np.ndarray  # code point offsets of each word in its text
    end: np.ndarray
    chars: np.ndarray  # all words in lower case, a space behind each
    first: np.ndarray  # where each word begins and ends there
    last: np.ndarray

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last word of every window of ``size`` words of one text."""
        a = np.arange(max(len(self.row) - size + 1, 0))
        a = a[self.row[a] == self.row[a + size - 1]]
        return a, a + size - 1

    def texts(self, first: np.ndarray, last: np.ndarray) -> list[str]:
        """The windows written out."""
        if not len(first):
            return []
        begin, end = self.first[first], self.last[last]
        at = int(begin.min())
        whole = self.chars[at : int(end.max())].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return [whole[a:b] for a, b in zip((begin - at).tolist(), (end - at).tolist())]


def words_of(texts: list[str | None]) -> Words:
    """Letter and digit runs of the texts."""
    texts = [t or "" for t in texts]
    joined = "\0".join([*texts, ""])
    codes = _codes(joined)
    letters, small = _classes()
    inside = np.concatenate([[False], letters[codes], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    offset = np.cumsum([0, *(len(t) + 1 for t in texts)])
    row = np.searchsorted(offset, start, "right") - 1
    size = end - start
    if np.isin(codes, _ODD).any():
        words = [joined[a:b].lower() for a, b in zip(start.tolist(), end.tolist())]
        size = np.array([len(w) for w in words], np.int64)
        flat = _codes("".join(words))
    else:
        flat = small[codes[inside[1:-1]]]
    last = np.cumsum(size + 1) - 1
    first = last - size
    chars = np.full(int(size.sum()) + len(size), 32, np.uint32)
    chars[np.arange(len(flat)) + np.repeat(np.arange(len(size)), size)] = flat
    return Words(row, start - offset[row], end - offset[row], chars, first, last)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for base in (_BASE, inverse):
        powers = np.full(n, base, np.uint64)
        powers[:1] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def slice_hashes(chars: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of slices, equal for equal slices: from running sums, whatever the slices' lengths."""
    up, down = _powers(len(chars) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)])
    h = (sums[last] - sums[first]) * down[first]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + (last - first).astype(np.uint64)
    return h ^ (h >> np.uint64(29))


def strings(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts behind each other as code points, with their slices."""
    last = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return _codes("".join(texts)), np.concatenate([np.zeros(1, np.int64), last[:-1]]) if len(texts) else last, last


def text_hashes(texts: list[str]) -> np.ndarray:
    """``slice_hashes`` of whole texts."""
    return slice_hashes(*strings(texts))


def gram_numbers(chars: np.ndarray) -> np.ndarray:
    """The run of three code points at every place as one number; zero stands for what lies behind the end."""
    c = np.concatenate([chars.astype(np.int64), np.zeros(3, np.int64)])
    return (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]


def gram_number(text: str) -> int:
    """Number of one gram of up to three code points."""
    return int(gram_numbers(_codes(text[:3]))[0])


class GramOrder:
    """One order of all grams: those not known as frequent first, then by frequency, then by number.

    ``packed`` puts a gram's place in this order and the gram into one number. Code points
    beyond 16 bits are folded, so that two grams may share a packed number; what is looked up
    by packed numbers is compared by whole grams afterwards.
    """

    def __init__(self, frequent: list[str]):
        numbers = np.array([gram_number(g) for g in frequent], np.int64)
        order = np.argsort(numbers)
        self.known, self.rank = numbers[order], (len(frequent) - order).astype(np.int64)

    def packed(self, grams: np.ndarray) -> np.ndarray:
        parts = [(grams >> shift) & 0x1FFFFF for shift in (42, 21, 0)]
        a, b, c = [np.where(p < 0x10000, p, (p ^ (p >> 16) * _FOLD) & 0xFFFF) for p in parts]
        rank = np.zeros(len(grams), np.int64)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
            rank = np.where(self.known[at] == grams, self.rank[at], 0)
        return (rank << 48) | (a << 32) | (b << 16) | c


_LAST = np.iinfo(np.int64).max


def _distinct(numbers: np.ndarray, place: np.ndarray, blank: np.ndarray, short: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different numbers of every row in order, filled up with the largest number, and how many there are.

    Rows named by ``short`` consist of the one number in ``whole``.
    """
    table = numbers[place]
    table[blank] = _LAST
    table[short, 0] = whole
    table.sort(axis=1)
    again = np.zeros(table.shape, bool)
    again[:, 1:] = table[:, 1:] == table[:, :-1]
    n = ((table != _LAST) & ~again).sum(axis=1)
    if again.any():
        table[again] = _LAST
        table.sort(axis=1)
    return table, n


def gram_sets(chars: np.ndarray, first: np.ndarray, last: np.ndarray, order: GramOrder | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Gram sets of slices in blocks: which slices, sizes of their sets, and a table of the sets.

    A row of the table has the different grams of a slice, packed and in ``order`` (or their
    plain numbers without one), filled up with the largest number. A slice of fewer than
    three code points is its own only gram.
    """
    grams = gram_numbers(chars)
    shown = grams if order is None else order.packed(grams)
    folded = order is not None and bool((chars > 0xFFFF).any())
    length = last - first
    width = np.maximum(length - 2, 1)
    bucket = np.frexp(width.astype(float))[1]
    for b in np.unique(bucket).tolist():
        mine = np.flatnonzero(bucket == b)
        cells = int(width[mine].max())
        step = max(1, _CELLS // cells)
        for at in range(0, len(mine), step):
            which = mine[at : at + step]
            place = np.minimum(first[which][:, None] + np.arange(cells), len(grams) - 1)
            blank = np.arange(cells) >= width[which][:, None]
            short = np.flatnonzero(length[which] < 3)
            bits = 21 * (3 - length[which][short].astype(np.int64))
            whole = (grams[place[short, 0]] >> bits) << bits
            table, n = _distinct(shown, place, blank, short, whole if order is None else order.packed(whole))
            if folded:
                # Folded numbers may be equal for different grams: count the grams themselves.
                n = _distinct(grams, place, blank, short, whole)[1]
            yield which, n, table


def jaccard(lefts: list[str], rights: list[str]) -> np.ndarray:
    """Jaccard similarity of the gram sets of two columns of texts, row by row."""
    out = np.zeros(len(lefts))
    chars, first, last = strings([*lefts, *rights])
    n = len(lefts)
    if not n:
        return out
    # Pairs of like lengths stand in one table, left sets beside right sets.
    longest = np.maximum((last - first)[:n], (last - first)[n:])
    bucket = np.frexp(np.maximum(longest, 1).astype(float))[1]
    for b in np.unique(bucket).tolist():
        mine = np.flatnonzero(bucket == b)
        step = max(1, _CELLS // (2 * int(longest[mine].max()) + 2))
        for at in range(0, len(mine), step):
            which = mine[at : at + step]
            sides = []
            for shift in (0, n):
                rows, sizes, tables = which + shift, np.zeros(len(which), np.int64), []
                for got, k, table in gram_sets(chars, first[rows], last[rows]):
                    sizes[got] = k
                    tables.append((got, table))
                whole = np.full((len(which), max(t.shape[1] for _, t in tables)), _LAST)
                for got, table in tables:
                    whole[got, : table.shape[1]] = table
                sides.append((sizes, whole))
            both = np.hstack([sides[0][1], sides[1][1]])
            both.sort(axis=1)
            common = ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] != _LAST)).sum(axis=1)
            out[which] = common / (sides[0][0] + sides[1][0] - common)
    return out
