"""Language identification by compression with per-language zstandard dictionaries.

A language's dictionary is raw content: text of a bounded sample of its labelled rows. A
whole text is cut into windows; each is compressed with every dictionary, and the
language with the smallest sum of sizes is chosen. Where the margin to the second is
narrow the choice is marked as rejected.

Bounds of the sample: ``SAMPLE_ROWS`` rows of a language, ``PIECE`` characters of each.
The driver holds that much text a language. Rows are sampled by a checksum of their text.

Defined cases: a null text or one without a letter is ``und`` with score 0; rows without
a language are not learned from; a language is learned however short its texts are, its
dictionary being filled up with spaces; without any labelled row every text is ``und``;
texts of any length are compressed whole; ties go to the smaller language code; repeated
rows are predicted each; an empty table gives an empty result; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notepairs.llm.common import by_bytes, record_batches, text_or_empty

SAMPLE_ROWS = 512
PIECE = 512
WINDOW = 256
LEVEL = 9
#: Bytes to which a short dictionary is filled up with spaces, so every learned language can be chosen.
LEAST = 16
_MARKS = 1 << 64
#: Bytes by which the second language must be larger for the choice to stand, and the same per window.
MARGIN, WINDOW_MARGIN = 3.0, 0.5
#: Bytes of difference that change the odds between two languages by a factor of e.
TEMPERATURE = 8.0
UNDETERMINED = "und"
_SHAPE = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))
_LATIN = re.compile("[A-Za-z]")
_OUT = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_()),
])


def has_letter(text: str) -> bool:
    return bool(_LATIN.search(text)) or any(map(str.isalpha, text))


def shaped(text: str) -> bytes:
    """Lower-case words with single spaces, without ASCII digits and punctuation."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_SHAPE).split())


def compressors(dictionaries: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, content in sorted(dictionaries.items()):
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        out.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)))
    return out


def classify(text: str, packers: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float, bool]:
    """Language, score and whether the margin is too narrow, of a whole text."""
    if not packers or not has_letter(text):
        return UNDETERMINED, 0.0, True
    data = shaped(text)
    windows = [data[i : i + WINDOW] for i in range(0, len(data), WINDOW)]
    sizes = [sum([len(packer.compress(w)) for w in windows]) for _, packer in packers]
    best = min(sizes)
    at = sizes.index(best)
    odds = sum(math.exp(max(-700.0, (best - s) / TEMPERATURE)) for s in sizes)
    second = min((s for i, s in enumerate(sizes) if i != at), default=math.inf)
    return packers[at][0], 1.0 / odds, second - best < max(MARGIN, WINDOW_MARGIN * len(windows))


def _predict(batches: Iterator[pa.RecordBatch], dictionaries: dict[str, bytes]) -> Iterator[pa.RecordBatch]:
    packers = compressors(dictionaries)
    for batch in batches:
        for part in by_bytes(batch, "text", 8 << 20):
            found = [classify(t, packers) for t in part.column("text").to_pylist()]
            yield record_batches({
                "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "lang_pred": [f[0] for f in found],
                "score": [f[1] for f in found], "rejected": [f[2] for f in found],
            }, _OUT)


def learn(docs: DataFrame, *, text_column: str = "text", lang_column: str = "lang") -> dict[str, bytes]:
    """The dictionary of every language, from the middle of each sampled text.

    The texts with the ``SAMPLE_ROWS`` smallest checksums of a language are sampled. Checksums
    are spread evenly, so a bound on them that leaves a few times as many follows from the
    number of texts; only checksums below it are looked at, whatever a language's size.
    """
    text = text_or_empty(docs, text_column)
    rows = docs.select(docs[lang_column].cast("string").alias("lang"), text.alias("text")).where("lang IS NOT NULL").withColumn("mark", F.xxhash64("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("mark").alias("n")).collect()}
    marks: list[tuple[str, int]] = []
    share = dict.fromkeys(sizes, 4.0)
    while share:
        bound = {lang: min(_MARKS, int(_MARKS * s * SAMPLE_ROWS / max(sizes[lang], 1))) - _MARKS // 2 for lang, s in share.items()}
        below = F.lit(False)
        for lang, most in bound.items():
            below |= (F.col("lang") == lang) & (F.col("mark") <= most - 1)
        found: dict[str, list[int]] = {lang: [] for lang in share}
        for r in rows.where(below).select("lang", "mark").distinct().collect():
            found[r["lang"]].append(r["mark"])
        for lang, got in found.items():
            if len(got) < SAMPLE_ROWS and bound[lang] < _MARKS // 2:
                share[lang] *= 4
            else:
                marks += [(lang, m) for m in sorted(got)[:SAMPLE_ROWS]]
                del share[lang]
    chosen = {m for _, m in marks}
    start = F.greatest(F.lit(1), F.floor((F.length("text") - PIECE) / F.lit(2)) + 1).cast("int")
    pieces = rows.where(F.col("mark").isin(*chosen)).select("lang", "mark", F.substring("text", start, F.lit(PIECE)).alias("piece")).distinct().collect()
    out: dict[str, bytes] = {}
    wanted = set(marks)
    for row in sorted((r for r in pieces if (r["lang"], r["mark"]) in wanted), key=lambda r: (r["lang"], r["mark"])):
        out[row["lang"]] = out.get(row["lang"], b"") + shaped(row["piece"]) + b" "
    # The library takes no dictionary of fewer bytes.
    return {lang: content.ljust(LEAST, b" ") for lang, content in out.items()}


def predict(
    docs: DataFrame, *, held_out: Column, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row; rows not held out are learned from."""
    held = F.coalesce(held_out, F.lit(False))
    dictionaries = learn(docs.where(~held), text_column=text_column, lang_column=lang_column)
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), held.alias("held_out"), text_or_empty(docs, text_column).alias("text"))
    return rows.mapInArrow(lambda b: _predict(b, dictionaries), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
