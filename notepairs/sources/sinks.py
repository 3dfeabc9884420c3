"""Sinks: entity-ordered and bucketed tables, partitioned pairs, outcome lists, stored splits."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notepairs import constants as C
from notepairs.operators.splits import safe_ids, split_manifest, split_pairs


def write_by_subject(df: DataFrame, path: str, *, key: str = "subject_id") -> None:
    """One shuffle: rows of a subject lie together and sorted; only a hot subject is split."""
    df.hint("rebalance", key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, *, key: str = "subject_id", path: str | None = None) -> None:
    """Bucketed table, so that later joins on the key need no shuffle; ``path`` puts its files elsewhere than the warehouse.

    Rows are dealt by the key first, so a bucket is one file.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_bucketed_records(notes: DataFrame, admissions: DataFrame, names: tuple[str, str], buckets: int, *, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Notes and admissions bucketed alike by subject, and read back.

    All joins of a corpus are by subject and admission, so they and the groupings behind them
    find both sides in place: the shuffle is paid once, when the tables are written.
    """
    for df, name in ((notes, names[0]), (admissions, names[1])):
        write_bucketed(df, name, buckets, path=f"{folder}/{name}" if folder else None)
    spark = notes.sparkSession
    return spark.table(names[0]), spark.table(names[1])


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Pairs by outcome code and heading index.

    Rebalanced first: few files per folder, and a folder with most of the rows gets many tasks.
    """
    pairs.hint("rebalance", "code", "heading_idx").write.mode("overwrite").partitionBy("code", "heading_idx").parquet(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """All pairs of all codes and headings; filters on either prune folders."""
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV table with quotes doubled inside quotes, as ``read_csv`` reads it; texts may hold newlines."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_pipes(df: DataFrame, path: str) -> None:
    """Pipe-delimited table without quotes or header, as the concept files are."""
    df.write.mode("overwrite").csv(path, sep="|", quote="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """Stored outcome lists of all codes."""
    return spark.read.json(path)


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    """Ids (and word counts, where a pair was stored) per outcome code, one JSON line each."""
    outcomes.hint("rebalance", "code").write.mode("overwrite").partitionBy("code").json(path)


def load_or_split(
    pairs: DataFrame, path: str, prompt: str, max_tokens: int, *, seed: str = "0", learn_fraction: float = 0.9,
    ratio: tuple[float, float] = (0.9, 0.1), pad: int = C.SAFE_TOKEN_PAD, eos: str = "", counter_name: str = "spaces", **gate,
) -> DataFrame:
    """Stored splits if they were made with the same settings; an error names those that differ.

    ``counter_name`` stands for a ``counter`` given in ``gate``. The manifest is written
    last, so splits without one are leftovers of a run that died and are made again. The
    ids below the budget are stored beside them.
    """
    spark = pairs.sparkSession
    wanted = {
        "prompt": prompt, "seed": seed, "train_ratio": ratio[0], "max_tokens": max_tokens, "learn_fraction": learn_fraction,
        "pad": pad, "eos": eos, "counter": counter_name,
    }
    try:
        stored = spark.read.json(f"{path}/manifest").first()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = None
    if stored is None:
        splits = split_pairs(pairs, max_tokens, seed=seed, learn_fraction=learn_fraction, ratio=ratio, template=prompt, pad=pad, eos=eos, **gate)
        splits.write.mode("overwrite").partitionBy("split").parquet(f"{path}/splits")
        made = spark.read.parquet(f"{path}/splits")
        safe_ids(made).write.mode("overwrite").parquet(f"{path}/safe_ids")
        split_manifest(
            made, prompt, seed=seed, ratio=ratio, max_tokens=max_tokens, learn_fraction=learn_fraction, pad=pad, eos=eos, counter=counter_name
        ).write.mode("overwrite").json(f"{path}/manifest")
    else:
        there = stored.asDict()
        other = {name: there.get(name) for name, value in wanted.items() if there.get(name) != value}
        if other:
            raise ValueError(f"the splits in {path} were made with other settings: {json.dumps(other)}")
    return spark.read.parquet(f"{path}/splits")


def training_columns(splits: DataFrame, split: str) -> DataFrame:
    return splits.filter(F.col("split") == split).select("document", "summary")
