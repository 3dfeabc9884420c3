"""Parse model answers and put them back into masked texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notepairs import constants as C
from notepairs.functions.text import let, strip


def parse_list(text: Column) -> Column:
    """Items of a single-quoted list literal; quotes around the whole are ignored."""
    return F.regexp_extract_all(text, F.lit("'([^']*)'"), 1)


def answers_of(text: Column) -> Column:
    return F.split(text, C.WORD_SEP)


def mask_count(masked: Column) -> Column:
    return (F.size(F.split(masked, C.MASK)) - 1).cast("int")


def answers_for_training(answers: Column) -> Column:
    return F.replace(answers, F.lit(C.WORD_SEP), F.lit(", "))


def _object_text(response: Column) -> Column:
    """First brace to first closing brace, with bare number keys put in quotes."""
    opened, closed = F.locate("{", response), F.locate("}", response)
    body = F.substring(response, opened, F.greatest(closed - opened + 1, F.lit(0)))
    return F.when((opened > 0) & (closed > 0), F.regexp_replace(body, r"(\p{Nd}+):", '"$1":'))


def json_answers(response: Column, originals: Column) -> Column:
    """Answers 1..n of an object response, originals where none was found; null if not well-formed.

    The last entry of a repeated number counts, and the numbers must be exactly 1..n.
    """
    parsed = F.from_json(_object_text(response), "map<string,string>", {"allowSingleQuotes": "false"})
    numbered = F.transform(
        F.map_entries(parsed),
        lambda e: F.struct(e["key"].try_cast("int").alias("i"), F.coalesce(e["value"], F.lit("None")).alias("v")),
    )

    def check(entries: Column) -> Column:
        wanted = F.sequence(F.lit(1), F.size(originals))
        keys = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["i"])))
        picked = F.zip_with(
            wanted, originals,
            lambda i, old: let(
                F.element_at(F.filter(entries, lambda e: e["i"] == i), -1)["v"],
                lambda v: F.when(v == C.NOT_FOUND, old).otherwise(v),
            ),
        )
        return F.when(keys == wanted, picked)

    return let(numbered, check)


def listed_answers(response: Column, originals: Column) -> Column:
    """Comma-separated answers, cut or padded with originals to the number wanted."""
    given = F.transform(F.split(response, ","), strip)
    n = F.size(originals)
    return let(
        F.slice(given, F.lit(1), n),
        lambda a: F.concat(a, F.slice(originals, F.size(a) + 1, n - F.size(a))),
    )


def fill_masks(masked: Column, answers: Column) -> Column:
    """Put the answers into the mask places in order; braces in the text stay as they are."""
    pieces = F.split(masked, C.MASK)
    filled = F.zip_with(pieces, answers, lambda p, a: F.concat(p, F.coalesce(a, F.lit(""))))
    return F.array_join(filled, "")
