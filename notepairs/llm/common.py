"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITESPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(df: DataFrame, column: str) -> Column:
    """The text column as a string; null counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def without_whitespace(text: Column) -> Column:
    """The text without the six ASCII white-space characters."""
    for mark in WHITESPACE:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def row_key(text: Column) -> Column:
    """Tells rows with the same id but another text apart."""
    return F.xxhash64(text)


def rows_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, text, row_key`` alone, so that other columns of any name do not matter."""
    text = text_or_empty(docs, text_column)
    return docs.select(docs[id_column].alias("doc_id"), text.alias("text"), row_key(text).alias("row_key"))


def only_kept(docs: DataFrame, kept: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows of ``docs`` named by ``kept`` (``doc_id, row_key``, one row each), once each.

    All columns of ``docs`` come back as they are. Rows that agree in id and text are the
    same row repeated; one of them stays.
    """
    both = packed(docs, id_column, text_column).join(kept.select(F.col("doc_id").alias("want_id"), F.col("row_key").alias("want_key"), "copies"), same_row())
    single = both
    if not kept.where(F.col("copies") > 1).isEmpty():
        again = both.where(F.col("copies") > 1).dropDuplicates(["id", "key"])
        single = both.where(F.col("copies") == 1).unionByName(again)
    return single.select("packed.*")


def packed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id, key, packed``: whole rows in one column, so that none of their names can clash."""
    whole = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns])
    return docs.select(docs[id_column].alias("id"), row_key(text_or_empty(docs, text_column)).alias("key"), whole.alias("packed"))


def same_row() -> Column:
    """Joins ``packed`` rows with rows that name them as ``want_id, want_key``."""
    return F.expr("id <=> want_id AND key = want_key")


def record_batches(columns: dict[str, list | pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    """One Arrow batch from lists or arrays, with the declared types."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in zip(schema, (columns[f.name] for f in schema))], schema=schema
    )


def by_bytes(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cuts of a batch whose texts hold about ``limit`` bytes, or one row each beyond that."""
    start, size = 0, 0
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    for i, n in enumerate(lengths):
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)
