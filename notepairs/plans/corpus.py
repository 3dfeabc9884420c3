"""Notes and admissions to stored pairs, outcomes and outcome lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notepairs.operators import pairs as N
from notepairs.sources.sinks import read_pairs, write_outcomes, write_pairs


def build_corpus(
    notes: DataFrame, admissions: DataFrame, path: str, *, null_time: str = "drop", **outcome_options
) -> DataFrame:
    """Write ``outcomes``, ``pairs`` (by code and heading), ``codes`` (ids as JSON) and ``lengths`` under ``path``.

    Outcomes are written first: the pairs read them twice, and a lost executor then
    costs no section work. Returns the stored pairs.
    """
    spark = notes.sparkSession
    closing = N.admission_notes(N.discharge_notes(notes), admissions)
    N.outcomes(closing, **outcome_options).write.mode("overwrite").parquet(f"{path}/outcomes")
    graded = spark.read.parquet(f"{path}/outcomes")
    write_pairs(N.build_pairs(graded, notes, null_time=null_time), f"{path}/pairs")
    pairs = read_pairs(spark, f"{path}/pairs")
    words = pairs.select("pair_id", "document_words", F.col("summary_words").alias("words"))
    listed = graded.select("pair_id", "code").join(words, "pair_id", "left").select(
        "pair_id", "code", "document_words", F.col("words").alias("summary_words")
    )
    write_outcomes(listed, f"{path}/codes")
    N.length_sketches(pairs).write.mode("overwrite").parquet(f"{path}/lengths")
    return pairs


def corpus_lengths(spark: SparkSession, *paths: str) -> DataFrame:
    """Lengths by outcome code over the corpora under ``paths``, from their stored sketches alone."""
    return N.length_stats(N.merge_lengths(spark.read.parquet(*[f"{path}/lengths" for path in paths])))


def quality_report(graded: DataFrame, masks: DataFrame | None = None, refilled: DataFrame | None = None) -> DataFrame:
    """Rows per outcome code, and how many masks did not come back as a text."""
    report = graded.groupBy(F.concat(F.lit("code "), "code").alias("what")).agg(F.count("*").alias("n"))
    if masks is not None and refilled is not None:
        lost = masks.select("pair_id").join(refilled.select("pair_id"), "pair_id", "left_anti")
        report = report.unionByName(lost.agg(F.count("*").alias("n")).select(F.lit("not refilled").alias("what"), "n"))
    return report
