"""Rejected summaries and preference triples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notepairs import constants as C
from notepairs.functions.prompts import render, with_eos
from notepairs.functions.text import count_tokens, let, settle
from notepairs.operators.splits import within_budget

# What opens and what closes a rejected summary in a response.
OPENING, OPENING_LENGTH = "hallucinated summary", 30
CLOSING = ("hallucinate", "hallucination")


def _first_at(items: Column, test: Callable[[Column], Column]) -> Column:
    marked = F.transform(items, lambda x, i: F.when(test(x), i))
    return F.try_element_at(F.filter(marked, lambda i: i.isNotNull()), F.lit(1))


def _opens(line: Column) -> Column:
    return (F.length(line) <= OPENING_LENGTH) & F.contains(F.lower(line), F.lit(OPENING))


def _closes(line: Column) -> Column:
    return let(F.lower(line), lambda low: F.contains(low, F.lit(CLOSING[0])) | F.contains(low, F.lit(CLOSING[1])))


def rejected_summary(response: Column) -> Column:
    """Lines between the first short opening line and the next closing line."""

    def until_close(rest: Column) -> Column:
        return F.array_join(F.slice(rest, 1, F.coalesce(_first_at(rest, _closes), F.size(rest))), "\n")

    def after_open(lines: Column) -> Column:
        def rest(start: Column) -> Column:
            return F.slice(lines, start + 2, F.greatest(F.size(lines) - start - 1, F.lit(0)))

        return let(let(_first_at(lines, _opens), rest), until_close)

    text = let(F.split(response, "\n"), after_open)
    return F.coalesce(F.trim(text, F.lit("\n")), F.lit(""))


def rejected_summaries(responses: DataFrame, *, key: str = "pair_id", text: str = "response") -> DataFrame:
    """Responses that hold a rejected summary."""
    found = responses.select(key, rejected_summary(F.col(text)).alias("rejected_summary"))
    return settle(found, "rejected_summary").filter(F.col("rejected_summary") != "")


def preference_triples(
    rejected: DataFrame, pairs: DataFrame, *, eos: str, template: str = C.PREFERENCE_TEMPLATE,
    max_prompt_tokens: int | None = None, counter: Callable[[Column], Column] = count_tokens,
) -> DataFrame:
    """Prompt, chosen and rejected text of every rejected summary."""
    joined = rejected.join(pairs.select("pair_id", "document", "summary"), "pair_id", "left")
    triples = joined.select(
        "pair_id", render(template, F.col("document")).alias("prompt"),
        with_eos(F.coalesce("summary", F.lit("")), eos).alias("chosen"),
        with_eos(F.col("rejected_summary"), eos).alias("rejected"),
    )
    if max_prompt_tokens is None:
        return triples
    return triples.filter(within_budget(F.col("prompt"), max_prompt_tokens, counter=counter))
