import random
import re

import numpy as np
import pyarrow as pa
import pytest

from notepairs.operators import tokens as T

LETTERS = "abcXYZ 09_-.\n\0éßİΣσ日本𝒳𝒴́"


def random_texts(seed, n=60, letters=LETTERS):
    rng = random.Random(seed)
    return [None if rng.random() < 0.05 else "".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]


def plain_words(text):
    return [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W_]+", text or "")]


@pytest.mark.parametrize("letters", [LETTERS, "abcXYZ 09_-.é日\0"])
def test_words_and_windows(letters):
    texts = random_texts(1, letters=letters)
    words = T.words_of(texts)
    for size in (1, 2, 5):
        first, last = words.windows(size)
        got = list(zip(words.row[first].tolist(), words.start[first].tolist(), words.end[last].tolist(), words.texts(first, last)))
        want = []
        for i, text in enumerate(texts):
            found = plain_words(text)
            want += [(i, run[0][0], run[-1][1], " ".join(w for _, _, w in run)) for run in (found[j : j + size] for j in range(len(found) - size + 1))]
        assert got == want


def test_slices_have_the_hash_of_their_text():
    words = T.words_of(random_texts(2))
    for size in (1, 3):
        first, last = words.windows(size)
        assert T.slice_hashes(words.chars, words.first[first], words.last[last]).tolist() == T.text_hashes(words.texts(first, last)).tolist()
    some = T.text_hashes(["", "a", "b", "ab", "ba", "aa", "a a", "\0", "\0a", "a\0"])
    assert len(set(some.tolist())) == len(some)
    assert T.text_hashes([]).tolist() == []


def plain_grams(text):
    return {text[i : i + 3] for i in range(max(len(text) - 2, 1))}


@pytest.mark.parametrize("letters", ["ab", "abcdefgh日", "ab𝒳𝒴𝒵日"])
def test_gram_sets_and_their_order(letters):
    texts = [t or "" for t in random_texts(3, letters=letters)] + ["", "a", "ab", "abc", "a" * 500]
    frequent = ["aab", "aba", "a", "ab"]
    order = T.GramOrder(frequent)
    seen = np.zeros(len(texts), int)
    for which, n, table in T.gram_sets(*T.strings(texts), order):
        for i, size, row in zip(which.tolist(), n.tolist(), table):
            grams = plain_grams(texts[i])
            assert size == len(grams)
            row = row[row != np.iinfo(np.int64).max]
            packed = order.packed(np.array([T.gram_number(g) for g in grams]))
            assert sorted(set(packed.tolist())) == row.tolist()
            seen[i] += 1
    assert (seen == 1).all()
    # The most frequent gram stands last, grams not known as frequent first.
    ranks = [int(order.packed(np.array([T.gram_number(g)]))[0]) for g in ["zzz", *reversed(frequent)]]
    assert ranks == sorted(ranks)


def test_similarity_of_columns():
    texts = [t or "" for t in random_texts(4, n=300, letters="ab 日𝒳")] + ["", "a", "ab", "x" * 300]
    rng = random.Random(5)
    lefts, rights = ([rng.choice(texts) for _ in range(1000)] for _ in range(2))
    want = [len(plain_grams(a) & plain_grams(b)) / len(plain_grams(a) | plain_grams(b)) for a, b in zip(lefts, rights)]
    assert T.jaccard(lefts, rights).tolist() == want
    assert T.jaccard([], []).tolist() == []


def test_pieces_are_bounded_and_whole():
    texts = ["ab", None, "", "é" * 7, "x" * 50, "y", *["zz"] * 30]
    batch = pa.RecordBatch.from_pydict({"_text": pa.array(texts, pa.string())})
    cuts = [p.column("_text").to_pylist() for p in T.pieces(batch, "_text", 16)]
    assert [t for c in cuts for t in c] == texts
    assert all(len(c) == 1 or sum(len((t or "").encode()) for t in c) <= 16 for c in cuts) and len(cuts) > 5
    assert not list(T.pieces(batch.slice(0, 0), "_text"))
