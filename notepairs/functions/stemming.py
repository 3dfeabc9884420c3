"""Porter stemming with the usual extensions, one token at a time.

Rules of M. F. Porter, "An algorithm for suffix stripping" (1980), with the
common extension rules for short words and a few irregular forms.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Forms that no rule covers.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
# Suffix and replacement per step; the first suffix that fits decides.
PLURALS = (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", ""))
DERIVED = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
)
ADJECTIVAL = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
RESIDUAL = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """``v`` per vowel and ``c`` per consonant; y is a vowel after a consonant."""
    out = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and out.endswith("c"))
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (len(word) > 2 and shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _replace(word: str, rules, holds) -> str:
    for suffix, new in rules:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + new if holds(suffix, stem) else word
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-3] + ("ie" if len(word) == 4 else "i")
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: len(word) - len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_end(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem
    return word


def _derived(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _derived(word[:-2])
    return _replace(
        word, DERIVED, lambda suffix, stem: _measure(stem + "l" if suffix == "logi" else stem) > 0
    )


@lru_cache(maxsize=1 << 18)
def stem(word: str) -> str:
    """Stem of one lower-case word."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = word[:-1] if word.endswith("ies") and len(word) == 4 else _replace(word, PLURALS, lambda *_: True)
    word = _past(word)
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    word = _derived(word)
    word = _replace(word, ADJECTIVAL, lambda _, stem: _measure(stem) > 0)
    word = _replace(
        word, [(s, "") for s in RESIDUAL],
        lambda suffix, stem: _measure(stem) > 1 and (suffix != "ion" or stem[-1] in "st"),
    )
    if word.endswith("e"):
        left = word[:-1]
        if _measure(left) > 1 or (_measure(left) == 1 and not _short_end(left)):
            word = left
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def score_stem(token: str) -> str:
    """Scoring stems tokens of more than three characters only."""
    return stem(token) if len(token) > 3 else token


def stem_tokens(tokens: Column) -> Column:
    """Stem an array of tokens; frequent words are served from a cache in each worker."""

    @F.pandas_udf("array<string>")
    def run(lists: pd.Series) -> pd.Series:
        return lists.map(lambda ts: None if ts is None else [score_stem(t) for t in ts])

    return run(tokens)


def stem_table(tokens: DataFrame, column: str = "token") -> DataFrame:
    """Stem of every distinct token."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield frame.assign(stem=frame[column].map(score_stem))

    return tokens.select(column).distinct().mapInPandas(run, f"{column} string, stem string")
