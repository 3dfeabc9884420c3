"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit of a fingerprint has a non-zero code of ``RADIUS + 1`` bits. A table is a
non-zero vector of as many bits; its mask keeps the bits whose code has an odd product
with the vector. Any ``RADIUS`` differing bits leave a vector that is even on all of
them, so two fingerprints within the radius agree under some mask: no pair is missed.

Equal fingerprints are one node. Nodes that meet another in a table are put under every
value reached by flipping at most one bit that those tables mask out. Two nodes under
one value differ in at most two bits, and every pair within two bits that met in a table
shares such a value. A value holds at most 65 nodes, so no bucket is compared in pairs,
however many fingerprints it holds.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; a
text of fewer words than a shingle is one shingle; repeated rows share their fingerprint
and component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notepairs.llm.common import by_bytes, only_kept, record_batches, rows_of
from notepairs.session import clear, stage

RADIUS = 2
SHINGLE = 3
SEED = 42
BITS = 64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLOCK = 1 << 15
_ROWS = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("fp", pa.int64())])


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The bit masks of the ``2 ** (radius + 1) - 1`` tables."""
    codes = (1 << (radius + 1)) - 1
    code = [i % codes + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (code[i] & v).bit_count() % 2) for v in range(1, codes + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def spans(text: str, shingle: int) -> list[bytes]:
    """The shingles of a text in order; none without words, one of fewer words than asked."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return []
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    width = min(shingle, len(words))
    starts = np.concatenate([[0], gaps + 1])[: len(words) - width + 1].tolist()
    ends = np.concatenate([gaps, [len(line)]])[width - 1 :].tolist()
    return [line[s:e] for s, e in zip(starts, ends)]


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text, as a signed number; zero without words."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    width = min(shingle, len(words))
    starts = np.concatenate([[0], gaps + 1])[: len(words) - width + 1].tolist()
    ends = np.concatenate([gaps, [len(line)]])[width - 1 :].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _BLOCK):
        hashes = b"".join([digest(line[s:e], SEED) for s, e in zip(starts[at : at + _BLOCK], ends[at : at + _BLOCK])])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return _signed(int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big"))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in by_bytes(batch, "text", 8 << 20):
            yield record_batches({
                "doc_id": part.column("doc_id"), "row_key": part.column("row_key"),
                "fp": [fingerprint(t) for t in part.column("text").to_pylist()],
            }, _ROWS)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, row_key, fp`` of every row."""
    rows = rows_of(docs, id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_fingerprints, "doc_id long, row_key long, fp long")


def links(nodes: DataFrame) -> DataFrame:
    """Edges ``a > b`` that connect exactly the distinct ``fp`` within ``RADIUS`` bits of each other.

    Star edges inside each shared value stand for its pairs: they have the same components.
    """
    tables = F.explode(F.array(*[
        F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket"), F.lit(_signed(~m % (1 << 64))).alias("free"))
        for i, m in enumerate(masks())
    ]))
    keyed = nodes.select("fp", tables.alias("t")).select("fp", "t.*")
    shared = stage(keyed.groupBy("table", "bucket").count().where("count > 1").select("table", "bucket"))
    free = keyed.join(shared, ["table", "bucket"]).groupBy("fp").agg(F.bit_or("free").alias("free"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(BITS)])
    near = free.withColumn("flip", F.explode(flips)).where(F.col("flip").bitwiseAND(F.col("free")) == F.col("flip"))
    values = near.select(F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), "fp")
    under = values.groupBy("value").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    star = under.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a <> b")
    return star.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a > b`` that is not itself the smallest it reaches.

    Alternates the large-star and small-star steps, whose number of rounds grows with the
    logarithm of the nodes, until the edges no longer change. Neighbour minima are
    aggregated before they meet the edges, so a hub is never gathered.
    """
    edges = stage(edges.select("a", "b"))
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")))
        large = stage(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        lower = stage(large.groupBy("a").agg(F.min("b").alias("low")))
        met = large.join(lower, "a").select(F.explode(F.when(
            F.col("b") == F.col("low"), F.array(F.struct("a", F.col("low").alias("b")))
        ).otherwise(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b"))))).alias("e"))
        new = stage(met.select("e.*").distinct())
        now = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        for done in (edges, least, large, lower):
            clear(done)
        edges = new
        if state == now:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def grouped(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds ``component_id`` to stored rows ``doc_id, row_key, fp``: the smallest id that the edges between ``fp`` reach."""
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = stage(components(edges))
    joined = stage(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    lowest = stage(joined.groupBy("root").agg(F.min("first_id").alias("component_id")))
    labels = stage(joined.join(lowest, "root").select("fp", "component_id"))
    return rows.join(labels, "fp").select("doc_id", "row_key", "fp", "component_id")


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, row_key, fp, component_id`` of every row.

    Documents are linked when their fingerprints differ in at most two bits;
    ``component_id`` is the smallest id that links reach, the own id included.
    """
    rows = stage(fingerprints(docs, id_column, text_column))
    return grouped(rows, links(stage(rows.select("fp").distinct())))


def one_of_each(docs: DataFrame, groups: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``docs`` with one row of every group, columns unchanged."""
    first = stage(groups).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Rows that share the smallest id but differ in text are one group too; one of them stays.
    kept = first.groupBy("component_id", "doc_id", "row_key").agg(F.count("*").alias("copies"))
    one = kept.groupBy("component_id", "doc_id").agg(F.min(F.struct("row_key", "copies")).alias("r"))
    return only_kept(docs, stage(one.select("doc_id", "r.row_key", "r.copies")), id_column, text_column)


def drop_near(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of every near-duplicate group (its smallest id), columns unchanged."""
    return one_of_each(docs, near_groups(docs, id_column, text_column), id_column, text_column)
