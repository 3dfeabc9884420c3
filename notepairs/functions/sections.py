"""Locate the summary section of a closing note and grade the outcome.

Outcome codes: 0 several headings; 1 known heading and known next heading;
2 uppercase heading, nothing unknown after it; 3 uppercase heading, unknown
uppercase heading after it; 4 and 5 the same for a mixed-case heading; 6 unknown
heading; 7 no heading; 8 addendum; 9 section too short; -1 not processable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notepairs import constants as C
from notepairs.functions.text import (
    BLANK, DIGIT, SPACE_CHARS, blank_marker_lines, clean_text, is_upper, last_line, let, one_of, settle,
    space_words, strip,
)

STORED_CODES = (1, 2, 4)
_WORK = (
    "_signed", "_body", "_paras", "_heads", "_hits", "_first", "_heading", "_next", "_unknown",
    "_base", "_slice", "_clean",
)
# Three [**...**] groups from the start of the line; each step takes the nearest
# closing mark and never backs up, so a long line costs one pass.
_NAME_LINE = (
    r"(?s)\A\[\*\*(?>.*?\*\*\])(?>.*?\[\*\*)(?>.*?\*\*\])(?>.*?\[\*\*)(?>.*?\*\*\])"
)


def unsigned_lines(text: Column) -> Column:
    """Cut dictation lines and one blank last line; every kept line starts with a newline.

    The result is empty when no line is left.
    """
    kept = F.substring_index(F.concat(F.lit("\n"), text), "\nDictated By", 1)
    return F.regexp_replace(kept, rf"\n{BLANK}*+\z", "")


def unnamed_lines(lines: Column) -> Column:
    """Drop the last line of ``unsigned_lines`` output when it only names the author."""
    last = last_line(lines)
    named = F.replace(last, F.lit(" "), F.lit("")).rlike(_NAME_LINE)
    return F.when(
        (lines != "") & named, F.substring(lines, F.lit(1), F.length(lines) - F.length(last) - 1)
    ).otherwise(lines)


def strip_signature(text: Column) -> Column:
    """Text without its signature; null when no line is left."""
    return let(
        unsigned_lines(text),
        lambda kept: F.when(kept != "", F.substring(unnamed_lines(kept), F.lit(2), F.length(kept))),
    )


def _paragraphs(body: Column) -> Column:
    """Split at empty lines and after every line equal to the last one.

    Only a newline is added after such lines, so a paragraph that ends with the
    last line's value is exactly one that such a line closed.
    """

    def marked(body: Column) -> Column:
        def mark(last: Column) -> Column:
            joined = F.array_join(
                F.transform(
                    F.split(F.substring(body, F.lit(2), F.length(body)), "\n"),
                    lambda line: F.when(line == last, F.concat(line, F.lit("\n"))).otherwise(line),
                ),
                "\n",
            )
            return F.when(last == "", F.substring(body, F.lit(2), F.length(body))).otherwise(
                F.substring(joined, F.lit(1), F.length(joined) - 1)
            )

        return let(last_line(body), mark)

    return F.split(let(body, marked), "\n\n")


def _head(paragraph: Column) -> Column:
    """Words before the first colon, with lines joined by spaces; null without a colon."""
    words = F.replace(F.substring_index(paragraph, ":", 1), F.lit("\n"), F.lit(" "))
    return F.when(F.contains(paragraph, F.lit(":")), F.ltrim(words, F.lit(SPACE_CHARS)))


def _plain_head(head: Column) -> Column:
    return ~head.rlike(DIGIT) & ~head.rlike(r"\A[.#]")


def _positions(items: Column, test) -> Column:
    """Zero-based positions of the items that pass ``test(item, position)``."""
    marked = F.transform(items, lambda x, i: F.when(test(x, i), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _closed_by_last(paragraph: Column, last: Column) -> Column:
    return (last != "") & (last_line(paragraph) == last)


def with_headings(
    df: DataFrame, text: str = "text", *, headings=C.SECTION_HEADINGS, keyword: str = C.HEADING_KEYWORD,
    next_headings=C.NEXT_HEADINGS, subheadings=C.SUBHEADINGS, skip_own_heading: bool = False,
) -> DataFrame:
    """Add the working columns that the outcome rules read."""
    df = df.withColumn("_signed", unsigned_lines(F.col(text)))
    df = df.withColumn("_body", blank_marker_lines(unnamed_lines(F.col("_signed"))))
    df = df.withColumn("_paras", _paragraphs(F.col("_body")))
    df = df.withColumn("_heads", F.transform("_paras", _head))
    df = df.withColumn(
        "_hits",
        _positions(
            F.col("_heads"),
            lambda h, i: F.contains(F.lower(h), F.lit(keyword.lower())) & _plain_head(h),
        ),
    )
    df = df.withColumn("_first", F.try_element_at("_hits", F.lit(1)))
    df = df.withColumn("_heading", F.try_element_at("_heads", F.col("_first") + 1))
    df = df.withColumn(
        "_next",
        let(
            F.col("_first"),
            lambda first: F.try_element_at(
                _positions(F.col("_heads"), lambda h, i: (i > first) & one_of(h, next_headings)), F.lit(1)
            ),
        ),
    )

    def unknown(paragraph: Column, i: Column, ctx: Column) -> Column:
        whole = F.when(
            _closed_by_last(paragraph, ctx["last"]),
            F.substring(paragraph, F.lit(1), F.length(paragraph) - F.length(ctx["last"])),
        ).otherwise(paragraph)
        joined = F.replace(whole, F.lit("\n"), F.lit(""))
        head = F.substring_index(joined, ":", 1)
        after = i > ctx["first"] if skip_own_heading else i >= ctx["first"]
        return (
            after & F.contains(joined, F.lit(":")) & is_upper(head)
            & ~one_of(head, subheadings) & _plain_head(head)
        )

    open_end = (F.size("_hits") == 1) & one_of(F.col("_heading"), headings) & F.col("_next").isNull()
    context = F.struct(last_line(F.col("_body")).alias("last"), F.col("_first").alias("first"))
    return df.withColumn(
        "_unknown",
        F.when(
            open_end,
            let(context, lambda ctx: F.size(_positions(F.col("_paras"), lambda p, i: unknown(p, i, ctx))) > 0),
        ),
    )


def base_code(headings=C.SECTION_HEADINGS) -> Column:
    upper = is_upper(F.col("_heading"))
    return (
        F.when(F.coalesce(F.col("_signed"), F.lit("")) == "", -1)
        .when(F.size("_hits") > 1, 0)
        .when(F.size("_hits") == 0, 7)
        .when(~one_of(F.col("_heading"), headings), 6)
        .when(F.col("_next").isNotNull(), 1)
        .when(upper & ~F.col("_unknown"), 2)
        .when(upper, 3)
        .when(~F.col("_unknown"), 4)
        .otherwise(5)
    )


def _directly_after(i: Column) -> Column:
    """No empty line lies between paragraph ``i`` (zero-based) and the one before it."""
    return ~F.startswith(F.try_element_at("_paras", i + 1), F.lit("\n"))


def _section_slice() -> Column:
    """Lines from the heading's paragraph up to the next heading, as one text.

    The line that closes a paragraph opens the next one: an empty line, or a line equal to
    the last one, which then goes with the later paragraph.
    """
    first, end = F.col("_first"), F.coalesce(F.col("_next"), F.size("_paras"))
    context = F.struct(
        last_line(F.col("_body")).alias("last"),
        F.when(_directly_after(F.col("_next")), F.col("_next") - first).otherwise(0).alias("closing"),
    )

    def rebuild(ctx: Column) -> Column:
        last = ctx["last"]

        def part(p: Column, i: Column) -> Column:
            return (
                F.when(~_closed_by_last(p, last), F.concat(p, F.lit("\n\n")))
                .when(i + 1 == ctx["closing"], F.substring(p, F.lit(1), F.length(p) - F.length(last)))
                .otherwise(F.concat(p, F.lit("\n")))
            )

        before = F.try_element_at(F.col("_paras"), F.when(first > 0, first))
        lead = F.when(
            _closed_by_last(before, last) & _directly_after(first), F.concat(last, F.lit("\n"))
        ).otherwise("")
        return F.concat(
            lead, F.array_join(F.transform(F.slice(F.col("_paras"), first + 1, end - first), part), "")
        )

    return F.when(F.col("_base").isin(*STORED_CODES), let(context, rebuild))


def with_outcome(
    df: DataFrame, text: str = "text", *, addendum: Column | None = None, timeless: Column | None = None,
    headings=C.SECTION_HEADINGS, min_words: int = C.SHORT_SUMMARY_WORDS, **options,
) -> DataFrame:
    """Add ``code``, ``heading``, ``summary`` and ``summary_words``.

    ``addendum`` marks rows that are never looked into (code 8); ``timeless`` marks
    rows without any usable time (code -1). The summary is set for codes 1, 2 and 4.
    """
    addendum = F.lit(False) if addendum is None else F.coalesce(addendum, F.lit(False))
    timeless = F.lit(False) if timeless is None else timeless
    df = with_headings(df, text, headings=headings, **options)
    df = df.withColumn("_base", F.when(addendum, 8).when(timeless, -1).otherwise(base_code(headings)))
    df = df.withColumn("_slice", _section_slice())
    df = df.withColumn("_clean", clean_text(F.col("_slice")))
    found = F.startswith(F.col("_clean"), F.lower(F.col("_heading")))
    rest = strip(F.substring(F.col("_clean"), F.locate(":", F.col("_clean")) + 1, F.length(F.col("_clean"))))
    df = df.withColumn("summary", F.when(found, rest))
    stored = F.col("_base").isin(*STORED_CODES)
    df = df.withColumn("summary_words", space_words(F.col("summary")))
    df = df.withColumn(
        "code",
        F.when(stored & F.col("summary").isNull(), -1)
        .when(stored & (F.col("summary_words") <= min_words), 9)
        .otherwise(F.col("_base")),
    )
    kept = F.col("code").isin(*STORED_CODES)
    df = df.withColumn("heading", F.when(kept, F.col("_heading")))
    for name in ("summary", "summary_words"):
        df = df.withColumn(name, F.when(kept, F.col(name)))
    return settle(df.drop(*_WORK), "code", "heading", "summary", "summary_words")
