"""Line-first quality rules, in built-in functions only.

Every line with a word is judged by itself: it fails without closing punctuation, as
navigation, as boilerplate, as shouting, with too many symbols, or when it repeats an
earlier line. Failing lines are removed; a document that loses too large a part of its
words is rejected, as is one that is too short or repeats itself.

Windows of three words are told apart by a 64-bit hash of the three words.

Defined cases: a null text has no words and is rejected; lines without a word are
neither judged nor kept; rows are judged one by one, so repeated rows agree; an empty
table gives an empty result; columns besides id and text are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notepairs.functions.text import settle
from notepairs.llm.common import WHITESPACE, WORD, text_or_empty, word_count

MIN_WORDS = 50
#: Share of words in repeated three-word windows, and share of words that must survive, in percent.
MAX_REPEATED = 50
MIN_SURVIVING = 50
SYMBOL = r"[#*$%&|<>]"
#: A line fails with at least this share of symbols among its characters, in percent.
MAX_SYMBOLS = 4
HAS_WORD = r"[^\x20\x09-\x0D]"
CLOSING = tuple(".!?:;,\"')]»”’…。！？-")
LOWER = r"[a-zß-öø-ÿ]"
SHOUTED_WORDS = 4
NAVIGATION = (
    r"(?i)^[\x20\x09-\x0D]*(?:(?:home|menu|search|log ?in|sign (?:in|up)|skip to (?:main )?content|back to top|next|previous"
    r"|share|tweet|print|read more|more|contact(?: us)?|about(?: us)?|sitemap|faq)[\x20\x09-\x0D|>»·:.!-]*)+$"
)
BOILERPLATE = (
    "all rights reserved", "cookie policy", "we use cookies", "accept cookies", "accept all cookies", "privacy policy",
    "terms of use", "terms of service", "enable javascript", "subscribe to our", "follow us on", "powered by", "lorem ipsum",
    "click here",
)


def line_passes(line: Column) -> Column:
    """Whether one line with a word passes every rule that looks at the line alone."""
    closed = F.right(F.rtrim(line, F.lit(WHITESPACE)), F.lit(1)).isin(*CLOSING)
    shouted = ~line.rlike(LOWER) & line.rlike("[A-ZÀ-ÖØ-Þ]") & (F.regexp_count(line, F.lit(WORD)) >= SHOUTED_WORDS)
    symbols = F.regexp_count(line, F.lit(SYMBOL)) * 100 >= F.length(line) * MAX_SYMBOLS
    small = F.lower(line)
    boilerplate = reduce(or_, [F.contains(small, F.lit(phrase)) for phrase in BOILERPLATE])
    return closed & ~shouted & ~symbols & ~line.rlike(NAVIGATION) & ~boilerplate


def _repeated_places(ordered: Column) -> Column:
    """Places of windows found twice or more; ``ordered`` has the windows by hash, then place."""
    hits = F.filter(ordered, lambda x, i: (F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"]))
    return F.sort_array(F.transform(hits, lambda x: x["i"]))


def line_quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts, verdict and cleaned text of every row.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, surviving_words, cleaned``, after the columns named in ``keep``.
    """
    passed = [docs[f"`{c}`"].alias(f"_in_{i}") for i, c in enumerate(keep)]
    names = [f"_in_{i}" for i in range(len(keep))]
    text = docs.select(*passed, docs[id_column].alias("doc_id"), text_or_empty(docs, text_column).alias("text"))
    parts = text.select(
        *names, "doc_id", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(HAS_WORD)).alias("lines"),
    )
    parts = settle(parts, "words", "lines")
    w = F.col("words")
    hashes = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    parts = parts.select(
        *names, "doc_id", "text", "words", "lines", F.size("words").alias("n"), F.array_distinct("lines").alias("first_lines"),
        F.slice(hashes, F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))).alias("windows"),
    )
    parts = settle(parts, "n", "first_lines", "windows")
    h = F.col("windows")
    placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    parts = settle(parts.withColumn("ordered", F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(placed)), "ordered")
    parts = settle(parts.withColumn("places", _repeated_places(F.col("ordered"))), "places")
    p = F.col("places")
    reach = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
    cleaned = F.array_join(F.filter("first_lines", line_passes), "\n")
    counted = parts.select(
        *names, "doc_id", F.col("n").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size("first_lines")).cast("long").alias("n_dup_lines"),
        F.aggregate(reach, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"), cleaned.alias("cleaned"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    counted = settle(counted, *counted.columns[len(names) + 1 :])
    judged = counted.withColumn("base_failed", failed).withColumn("surviving_words", word_count(F.col("cleaned")))
    kept = ~F.col("base_failed") & (100 * F.col("surviving_words") >= MIN_SURVIVING * F.col("n_words"))
    return settle(judged.withColumn("kept", kept), "base_failed", "surviving_words", "kept").select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "surviving_words", "cleaned",
    )


def keep_good(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of ``docs`` that the rules keep, columns and texts unchanged."""
    row = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns])
    packed = docs.select(row.alias("row"), docs[id_column].alias("id"), docs[text_column].alias("text"))
    return line_quality(packed, "id", "text", keep=("row",)).where("kept").select("row.*")
