"""From notes and admissions to graded (document, summary) pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notepairs import constants as C
from notepairs.functions.sections import STORED_CODES, with_outcome
from notepairs.functions.text import clean_text, note_block, pair_key, space_words

ADMISSION = ("subject_id", "hadm_id")


def note_time(col: Column) -> Column:
    """Zone-free timestamp of an ISO string; null when it is none."""
    return col.try_cast("timestamp_ntz")


def anchor_time(chartdate: Column, charttime: Column) -> Column:
    """Chart time if there is one, else the end of the chart date."""
    return F.coalesce(note_time(charttime), note_time(chartdate) + F.expr("INTERVAL '1' DAY"))


def discharge_notes(notes: DataFrame) -> DataFrame:
    """Closing notes with their pair key and anchor time."""
    return notes.filter(F.col("category") == C.DISCHARGE).select(
        "*",
        pair_key(F.col("row_id"), F.col("subject_id"), F.col("hadm_id")).alias("pair_id"),
        anchor_time(F.col("chartdate"), F.col("charttime")).alias("anchor"),
    )


def other_notes(notes: DataFrame, *, null_time: str = "drop") -> DataFrame:
    """Notes that may enter a document, with sortable ``time`` text and ``at`` timestamp.

    ``null_time='drop'`` leaves out notes without chart time; ``'chartdate'`` dates them
    by their chart date.
    """
    if null_time not in ("drop", "chartdate"):
        raise ValueError("null_time is 'drop' or 'chartdate'")
    time = F.col("charttime") if null_time == "drop" else F.coalesce("charttime", "chartdate")
    return (
        notes.filter(~F.col("category").eqNullSafe(C.DISCHARGE))
        .withColumn("time", time)
        .withColumn("at", note_time(F.col("time")))
        .filter(F.col("at").isNotNull())
    )


def admission_notes(notes: DataFrame, admissions: DataFrame) -> DataFrame:
    """Notes whose admission is on record, once each however often it is recorded."""
    return notes.filter(F.col("hadm_id").isNotNull()).join(
        admissions.select(*ADMISSION), list(ADMISSION), "left_semi"
    )


def with_blocks(notes: DataFrame) -> DataFrame:
    """Clean each note once and put its header on top."""
    cleaned = notes.withColumn("cleaned", clean_text(F.col("text")))
    return cleaned.withColumn(
        "block", note_block(F.col("time"), F.col("category"), F.col("description"), F.col("cleaned"))
    ).drop("cleaned")


def prior_notes(closing: DataFrame, notes: DataFrame) -> DataFrame:
    """Each closing note with the notes of its admission charted up to its anchor.

    An inner join, so a hot admission can be split on either side at run time.
    """
    left = closing.filter(F.col("hadm_id").isNotNull()).select(*ADMISSION, "pair_id", "anchor")
    right = notes.filter(F.col("hadm_id").isNotNull())
    return left.join(right, list(ADMISSION), "inner").filter(F.col("at") <= F.col("anchor"))


def documents(prior: DataFrame) -> DataFrame:
    """Join note blocks in time order, first per day and then over the days.

    Both groupings contain the join's keys, so they reuse its partitioning. Where a hot
    admission was split, the day parts spread it over many tasks before the last join.
    """
    ordered = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: x["block"]), C.DOC_SEP)
    keys = (*ADMISSION, "pair_id")
    days = (
        prior.withColumn("day", F.substring("time", 1, 10))
        .groupBy(*keys, "day")
        .agg(ordered(F.collect_list(F.struct("time", "row_id", "block"))).alias("block"))
    )
    return days.groupBy(*keys).agg(
        ordered(F.collect_list(F.struct("day", "block"))).alias("document")
    )


def note_positions(prior: DataFrame) -> DataFrame:
    """Place of each note in its document, counted per day and then over days."""
    from pyspark.sql import Window

    keys = (*ADMISSION, "pair_id")
    rows = prior.select(*keys, "row_id", "time", F.substring("time", 1, 10).alias("day"))
    before = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = rows.groupBy(*keys, "day").agg(F.count("*").alias("n")).select(
        *keys, "day", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    within = Window.partitionBy(*keys, "day").orderBy("time", "row_id")
    return (
        rows.withColumn("rank", F.row_number().over(within))
        .join(days, [*keys, "day"])
        .select(*keys, "row_id", (F.col("earlier") + F.col("rank")).alias("position"))
    )


def outcomes(closing: DataFrame, **options) -> DataFrame:
    """One row per closing note: outcome code and, where one was found, its section."""
    graded = with_outcome(
        closing, "text",
        addendum=F.col("description") == C.ADDENDUM, timeless=F.col("anchor").isNull(), **options,
    )
    return graded.select(
        "pair_id", *ADMISSION, "anchor", "code", "heading", "summary", "summary_words"
    )


def heading_index(heading: Column, headings=C.SECTION_HEADINGS) -> Column:
    """Zero-based place of a heading in the list."""
    names = F.split(F.lit("\n".join(headings)), "\n")
    return (F.array_position(names, heading) - 1).cast("int")


def build_pairs(graded: DataFrame, notes: DataFrame, *, null_time: str = "drop") -> DataFrame:
    """Pairs of the stored outcomes; a closing note without earlier notes gets an empty document.

    ``graded`` is read twice, so pass a table (see ``stage``) rather than a long plan.
    """
    kept = graded.filter(F.col("code").isin(*STORED_CODES))
    blocks = with_blocks(other_notes(notes, null_time=null_time)).select(
        *ADMISSION, "row_id", "time", "at", "block"
    )
    texts = documents(prior_notes(kept, blocks))
    document = F.coalesce("document", F.lit(""))
    return kept.join(texts, [*ADMISSION, "pair_id"], "left").select(
        "pair_id", "code", "heading", heading_index(F.col("heading")).alias("heading_idx"),
        document.alias("document"), "summary",
        space_words(document).alias("document_words"), "summary_words",
    )


def outcome_counts(graded: DataFrame) -> DataFrame:
    return graded.groupBy("code").agg(F.count("*").alias("n"))


#: Size of a quantile sketch: exact for as many lengths, within 0.1 percent of the ranks beyond.
SKETCH_SIZE = 4096
SIDES = ("document", "summary")


def length_sketches(pairs: DataFrame, *, by: tuple[str, ...] = ("code",)) -> DataFrame:
    """Counts, extremes, totals and quantile sketches of the lengths of ``pairs``: small rows that ``merge_lengths`` adds up."""
    columns = []
    for side in SIDES:
        words = F.col(f"{side}_words").cast("long")
        columns += [
            F.min(words).alias(f"min_{side}"), F.max(words).alias(f"max_{side}"), F.sum(words).alias(f"sum_{side}"), F.count(words).alias(f"n_{side}"),
            F.kll_sketch_agg_bigint(words, F.lit(SKETCH_SIZE)).alias(f"sketch_{side}"),
        ]
    return pairs.groupBy(*by).agg(F.count("*").alias("n"), *columns)


def merge_lengths(sketches: DataFrame, *, by: tuple[str, ...] = ("code",)) -> DataFrame:
    """One row per group from the sketches of several runs; the pairs are not read again."""
    columns = []
    for side in SIDES:
        columns += [
            F.min(f"min_{side}").alias(f"min_{side}"), F.max(f"max_{side}").alias(f"max_{side}"), F.sum(f"sum_{side}").alias(f"sum_{side}"),
            F.sum(f"n_{side}").alias(f"n_{side}"), F.kll_merge_agg_bigint(F.col(f"sketch_{side}"), F.lit(SKETCH_SIZE)).alias(f"sketch_{side}"),
        ]
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), *columns)


def length_stats(sketches: DataFrame, *, by: tuple[str, ...] = ("code",), percentiles: tuple[int, ...] = (50, 90, 99)) -> DataFrame:
    """Least, greatest and mean lengths and their percentiles, from sketches of any number of pairs.

    A percentile is the least length that as large a share of the lengths does not exceed.
    """
    columns = []
    for side in SIDES:
        columns += [F.col(f"{f}_{side}").alias(f"{f}_{side}_words") for f in ("min", "max")]
        columns.append((F.col(f"sum_{side}") / F.nullif(F.col(f"n_{side}"), F.lit(0))).alias(f"avg_{side}_words"))
        columns += [
            F.when(F.col(f"n_{side}") > 0, F.kll_sketch_get_quantile_bigint(F.col(f"sketch_{side}"), F.lit(p / 100))).alias(f"p{p}_{side}_words") for p in percentiles
        ]
    return sketches.select(*by, "n", *columns)


def doc_stats(pairs: DataFrame) -> DataFrame:
    """Lengths of documents and summaries by outcome code."""
    return length_stats(length_sketches(pairs))
