"""Byte-level BPE of whole texts, long ones in overlapping chunks.

A text beyond ``CHUNK`` characters is cut into chunks that overlap by ``OVERLAP``
characters, and every chunk is pre-tokenised by its own task. Where two neighbours agree
on a pre-token boundary that follows a character other than white space, both go on
alike from there: the pattern looks ahead only inside white space. The text is stitched
at these boundaries into pieces, which are encoded by tasks of their own and joined in
order. Neighbours that agree nowhere in their overlap leave their texts in one piece, so
the ids are those of the whole text in every case.

Defined cases: a null text is empty and has no ids; repeated rows are encoded each; an
empty table gives an empty result; lone surrogates cannot occur in UTF-8 tables; columns
besides id and text are not read. Ids are 32-bit little-endian numbers, one after another.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notepairs.llm.common import by_bytes, record_batches, rows_of
from notepairs.session import stage

VOCABULARY = "byte_bpe_50k.tiktoken"
CHUNK = 32_768
OVERLAP = 1_024
_BATCH = 1 << 20


@cache
def _ranks(vocabulary: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def _encoding(vocabulary: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(vocabulary), special_tokens={})


@cache
def _pattern() -> regex.Pattern:
    return regex.compile(public_tokenizers.PATTERN)


@cache
def _tokens(vocabulary: str) -> np.ndarray:
    """Bytes of every id, as an object array for lookups by id."""
    table = np.empty(max(_ranks(vocabulary).values()) + 1, object)
    for token, rank in _ranks(vocabulary).items():
        table[rank] = token
    return table


def encode_text(text: str, vocabulary: str = VOCABULARY) -> bytes:
    """Ids of one text, in order, as little-endian 32-bit numbers."""
    return np.array(_encoding(vocabulary).encode_ordinary(text), "<u4").tobytes()


def decode_ids(ids: bytes, vocabulary: str = VOCABULARY) -> bytes:
    """The raw bytes of the ids, one after another."""
    return b"".join(_tokens(vocabulary)[np.frombuffer(ids, "<u4")].tolist())


def boundaries(text: str, start: int = 0) -> Iterator[int]:
    """Ends of pre-tokens that follow a character other than white space, from ``start`` on."""
    for match in _pattern().finditer(text, start):
        end = match.end()
        if not text[end - 1].isspace():
            yield end


_CHUNKS = pa.schema([("row", pa.int64()), ("chunk", pa.int32()), ("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))])
_IDS = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("ids", pa.binary())])
_DECODED = pa.schema([*_IDS, ("decoded", pa.binary())])


def _zones(chunk: int, overlap: int):
    """Task: boundaries of a chunk in the overlaps with its neighbours, as offsets in the text.

    A pre-token that reaches the end of the chunk may go on beyond it and sets none there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in _CHUNKS.names}
            for row, k, part in zip(*(batch.column(c).to_pylist() for c in ("row", "chunk", "part"))):
                ends = [e for e in boundaries(part) if e < len(part)]
                base = k * chunk
                out["row"].append(row)
                out["chunk"].append(k)
                out["head"].append([base + e for e in ends if e <= overlap])
                out["tail"].append([base + e for e in ends if e > chunk])
            yield record_batches(out, _CHUNKS)

    return run


def _encode(vocabulary: str, decoded: bool):
    """Task: ids of the texts and, in the same pass if wanted, the bytes that the ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text", _BATCH):
                ids = [encode_text(t, vocabulary) for t in part.column("text").to_pylist()]
                columns = {"doc_id": part.column("doc_id"), "row_key": part.column("row_key"), "ids": ids}
                if decoded:
                    columns["decoded"] = [decode_ids(x, vocabulary) for x in ids]
                yield record_batches(columns, _DECODED if decoded else _IDS)

    return run


def _decode(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "ids", _BATCH):
                columns = {c: part.column(c) for c in _IDS.names}
                yield record_batches(columns | {"decoded": [decode_ids(x, vocabulary) for x in part.column("ids").to_pylist()]}, _DECODED)

    return run


def stitches(chunks: DataFrame) -> DataFrame:
    """``row, cuts``: for every text its stitching points in order, from boundaries of its chunks.

    The point of chunk ``k`` is the first boundary that it shares with chunk ``k - 1``.
    A chunk without one has no point, and its text stays in the piece of the chunk before.
    """
    left = chunks.select("row", (F.col("chunk") + 1).alias("chunk"), "tail")
    met = left.join(chunks.select("row", "chunk", "head"), ["row", "chunk"])
    shared = met.select("row", "chunk", F.array_min(F.array_intersect("tail", "head")).alias("cut")).where("cut IS NOT NULL")
    return shared.groupBy("row").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))


def encode(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY,
    chunk: int = CHUNK, overlap: int = OVERLAP, decoded: bool = False,
) -> DataFrame:
    """``doc_id, row_key, ids`` of every row.

    With ``decoded`` the tasks that encode also decode their ids, and the raw bytes of the
    pieces are joined in order like the ids: one Python process a task instead of two.
    """
    rows = rows_of(docs, id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    values = ["ids", "decoded"] if decoded else ["ids"]
    run, schema = _encode(vocabulary, decoded), ", ".join(["doc_id long, row_key long", *[f"{v} binary" for v in values]])
    short = rows.where(F.length("text") <= chunk).mapInArrow(run, schema)
    long = stage(rows.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id()))
    tasks = docs.sparkSession.sparkContext.defaultParallelism * 4
    at = F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / F.lit(chunk)).cast("int")))
    parts = long.select("row", "text", at.alias("chunk")).select(
        "row", "chunk", F.substring("text", F.col("chunk") * chunk + 1, F.lit(chunk + overlap)).alias("part")
    )
    chunks = parts.repartition(tasks, "row", "chunk").mapInArrow(_zones(chunk, overlap), "row long, chunk int, head array<int>, tail array<int>")
    cuts = stage(stitches(stage(chunks)))
    cut = long.join(cuts, "row", "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<int>")))
    edges = F.concat(F.array(F.lit(0)), "cuts", F.array(F.length("text")))
    pieces = cut.withColumn("edges", edges).select("row", "text", "edges", F.posexplode("edges").alias("piece", "start")).where("piece < size(edges) - 1")
    spans = pieces.select("row", "piece", F.substring("text", F.col("start") + 1, F.get("edges", F.col("piece") + 1) - F.col("start")).alias("text"))
    coded = spans.repartition(tasks, "row", "piece").select(F.col("row").alias("doc_id"), F.col("piece").cast("long").alias("row_key"), "text").mapInArrow(run, schema)
    whole = coded.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("row_key", *values))).alias("all"))
    joined = whole.select(F.col("doc_id").alias("row"), *[_joined(v) for v in values])
    return short.unionByName(long.select("row", "doc_id", "row_key").join(joined, "row").select("doc_id", "row_key", *values))


def _joined(value: str) -> Column:
    """The binary pieces of a text, one after another."""
    return F.unhex(F.array_join(F.transform("all", lambda x: F.hex(x[value])), "")).alias(value)


def decode(encoded: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    """Adds ``decoded``, the raw bytes of ``ids``."""
    picked = encoded.select("doc_id", "row_key", "ids")
    return picked.mapInArrow(_decode(vocabulary), "doc_id long, row_key long, ids binary, decoded binary")


def n_ids(ids: Column) -> Column:
    """Number of ids in a column of packed ids."""
    return (F.octet_length(ids) / F.lit(4)).cast("long")
