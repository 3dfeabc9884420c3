"""Mask concept mentions in summaries, check the masks, refill them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from notepairs import constants as C
from notepairs.functions.answers import (
    answers_for_training, answers_of, fill_masks, json_answers, listed_answers, mask_count,
)
from notepairs.functions.prompts import render, with_eos
from notepairs.functions.text import settle
from notepairs.operators.concepts import of_types


def override_summaries(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Use the given text instead of the stored summary where there is one."""
    given = texts.select("pair_id", F.col("text").alias("_text"))
    return pairs.join(given, "pair_id", "left").select(
        "pair_id", "document", F.coalesce("_text", "summary").alias("summary")
    )


def coverage(summaries: DataFrame, extractions: DataFrame) -> DataFrame:
    """Ids that only one side has; empty when extraction and summaries agree."""
    left = summaries.select("pair_id").distinct().withColumn("_s", F.lit(True))
    right = extractions.select("pair_id").distinct().withColumn("_e", F.lit(True))
    return left.join(right, "pair_id", "full_outer").filter("_s IS NULL OR _e IS NULL").select(
        "pair_id", F.when(F.col("_s").isNull(), "summary").otherwise("extraction").alias("missing")
    )


def _piece(text: str = "summary") -> Column:
    return F.substring(text, F.col("start_at") + 1, F.col("end_at") - F.col("start_at"))


def located(pairs: DataFrame, mentions: DataFrame) -> DataFrame:
    """Mentions beside their pair, with ``intact`` telling whether the offsets hold the text."""
    return pairs.select("pair_id", "document", "summary").join(mentions, "pair_id").withColumn(
        "intact", _piece() == F.col("source_value")
    )


def broken_mentions(pairs: DataFrame, mentions: DataFrame) -> DataFrame:
    """Mentions whose offsets do not hold their text: put aside instead of stopping the job."""
    return located(pairs, mentions).filter(~F.col("intact")).select(
        "pair_id", "start_at", "end_at", "source_value", _piece().alias("found")
    )


def mask_one(pairs: DataFrame, mentions: DataFrame, *, types=C.MASK_TYPES) -> DataFrame:
    """One row per mention, with only that mention masked."""
    good = located(pairs, of_types(mentions, types)).filter("intact")
    return good.select(
        F.concat_ws("_", "pair_id", "start_at", "end_at").alias("mention_id"), "document",
        F.overlay("summary", F.lit(C.MASK), F.col("start_at") + 1, F.col("end_at") - F.col("start_at")).alias(
            "masked_summary"
        ),
        F.col("source_value").alias("answer"), "detected_name", "type_ids",
    )


def _spans(spans: Column, rank: Callable[[Column], Column]) -> Column:
    """Spans in the order of a rank, then from left to right."""
    return F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                rank(s).alias("rank"), s["start_at"].alias("start_at"), s["end_at"].alias("end_at"),
                s["source_value"].alias("source_value"),
            ),
        )
    )


def longest_spans(spans: list[tuple[int, int]], length: int) -> list[int]:
    """Numbers of the spans that stay when of overlapping ones the longest, then the leftmost does; from left to right.

    A span that meets a longer one has its first or last place in it, so two places tell.
    """
    taken, kept = bytearray(length), []
    for i in sorted(range(len(spans)), key=lambda i: (spans[i][0] - spans[i][1], spans[i])):
        a, b = spans[i]
        if not (taken[a] or taken[b - 1]):
            taken[a:b] = b"\1" * (b - a)
            kept.append(i)
    return sorted(kept, key=lambda i: spans[i])


def _masked_longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: every text with its intact spans masked, joined from the gaps between them."""
    for batch in batches:
        masked, answers = [], []
        for text, spans in zip(batch.column("summary").to_pylist(), batch.column("spans").to_pylist()):
            found = {(s["start_at"], s["end_at"]) for s in spans if s["start_at"] < s["end_at"] and text[s["start_at"] : s["end_at"]] == s["source_value"]}
            ordered = sorted(found)
            gaps, values, done = [], [], 0
            for i in longest_spans(ordered, len(text)):
                a, b = ordered[i]
                gaps.append(text[done:a])
                values.append(text[a:b])
                done = b
            masked.append(C.MASK.join([*gaps, text[done:]]))
            answers.append(C.WORD_SEP.join(values))
        yield pa.RecordBatch.from_arrays([
            *(batch.column(c) for c in ("pair_id", "document", "summary")), pa.array(masked, pa.string()), pa.array(answers, pa.string())
        ], names=["pair_id", "document", "summary", "masked_summary", "answers"])


def mask_all(
    pairs: DataFrame, mentions: DataFrame, *, types=C.MASK_TYPES, overlaps: str = "longest"
) -> DataFrame:
    """One row per pair with every mention masked, and the answers from left to right.

    ``overlaps='longest'`` masks one of overlapping mentions; ``'raw'`` masks them one after
    the other at their first offsets, which mixes up overlapping ones.
    """
    if overlaps not in ("longest", "raw"):
        raise ValueError("overlaps is 'longest' or 'raw'")
    good = of_types(mentions, types).select("pair_id", F.struct("start_at", "end_at", "source_value").alias("m"))
    # Masked one after the other, a span that several concepts share is masked for each of them.
    gather = F.collect_set if overlaps == "longest" else F.collect_list
    grouped = good.groupBy("pair_id").agg(gather("m").alias("spans"))
    joined = pairs.select("pair_id", "document", "summary").join(grouped, "pair_id")
    if overlaps == "longest":
        typed = StructType([*joined.select("pair_id", "document", "summary").schema.fields, *StructType.fromDDL("masked_summary string, answers string").fields])
        done = joined.where("summary IS NOT NULL").mapInArrow(_masked_longest, typed)
        return done.where("masked_summary <> summary").drop("summary")
    intact = F.filter(
        "spans",
        lambda s: F.substring(F.col("summary"), s["start_at"] + 1, s["end_at"] - s["start_at"]) == s["source_value"],
    )
    joined = settle(joined.withColumn("spans", _spans(intact, lambda _: F.lit(0))), "spans")
    masked = F.aggregate(
        F.reverse("spans"), F.col("summary"),
        lambda text, s: F.concat(
            F.substring(text, F.lit(1), s["start_at"]), F.lit(C.MASK),
            F.substring(text, s["end_at"] + 1, F.length(text)),
        ),
    )
    answers = F.array_join(F.transform("spans", lambda s: s["source_value"]), C.WORD_SEP)
    done = joined.select(
        "pair_id", "document", "summary", masked.alias("masked_summary"), answers.alias("answers")
    )
    changed = settle(done, "masked_summary").filter(F.col("masked_summary") != F.col("summary"))
    return changed.select("pair_id", "document", "masked_summary", "answers")


def mask_checks(masks: DataFrame) -> DataFrame:
    """Number of masks and of answers per pair; they must agree before a prompt is made."""
    return masks.withColumn("n_masks", mask_count(F.col("masked_summary"))).withColumn(
        "n_answers", F.size(answers_of(F.col("answers")))
    )


def usable_masks(masks: DataFrame) -> DataFrame:
    return mask_checks(masks).filter("n_masks = n_answers").drop("n_masks", "n_answers")


def training_texts(masks: DataFrame, *, eos: str, template: str = C.CLOZE_TEMPLATE) -> DataFrame:
    text = render(
        template, F.col("document"), F.col("masked_summary"), answers_for_training(F.col("answers"))
    )
    return masks.select("pair_id", with_eos(text, eos).alias("text"))


def refilled(masks: DataFrame, responses: DataFrame, *, form: str = "json") -> DataFrame:
    """Masked summaries filled with parsed answers.

    ``form='json'`` drops responses that are not a complete object; ``'list'`` takes
    comma-separated answers and pads them.
    """
    if form not in ("json", "list"):
        raise ValueError("form is 'json' or 'list'")
    parse = json_answers if form == "json" else listed_answers
    joined = usable_masks(masks).join(responses.select("pair_id", "response"), "pair_id").withColumn(
        "originals", answers_of(F.col("answers"))
    )
    parsed = joined.select("pair_id", "masked_summary", parse(F.col("response"), F.col("originals")).alias("filled"))
    return settle(parsed, "filled").filter(F.col("filled").isNotNull()).select(
        "pair_id", "masked_summary", F.col("filled").alias("answers"),
        fill_masks(F.col("masked_summary"), F.col("filled")).alias("text"),
    )
