"""Filter interaction audit: what each of five filters removes in every order they can be applied in.

Four filters look at one text. The fifth, E, fails a text that a smaller id has too. It is
found by a counting Bloom filter: the tasks count the digests of their texts up to two, the
counts meet in shards of ``SHARD`` texts, and a text whose counters are not all at two occurs
once for sure. Only the others, picked in the scan by a bitmap of fixed size, move their
texts, grouped by the whole text with its least and greatest id; equal rows are combined
before they move. How many rows fail E then follows by addition: rows of repeated texts less
rows that hold the least id of theirs, both counted by part, mask and label, so that no row
of a large group of copies has to meet the others.

The counters take memory by shard, whatever the number of texts. The bitmap keeps 2 ** 26
bits, so with very many repeated texts it lets more texts through, which only costs time.

Defined cases: a null or empty text is the empty text, which fails A, and E beside a smaller
id; a null source is the part ''; a row without an id never fails E and makes none fail;
rows repeated with their id do not fail E for each other; a document is good or toxic if any
of its label rows says so; an empty table gives an empty result; other columns are not read;
texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notepairs.llm.common import by_bytes, text_or_empty
from notepairs.operators.concepts import bitmap
from notepairs.session import clear, stage

FILTERS = "ABCDE"
MIN_WORDS = 200
#: Least share of distinct words and greatest share of capitals, in percent.
MIN_DISTINCT = 50
MAX_CAPITALS = 2
SYMBOLS = "#$%&*|"
#: Texts of a shard of the counting filter, counters for each of them, and counters a text sets.
SHARD = 1 << 16
COUNTERS = 8
HASHES = 3
SCREEN_BITS = 1 << 26
_UPPER = bytes(range(65, 91))
_E = 1 << FILTERS.index("E")


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: which of the filters A to D every text fails."""
    signs = SYMBOLS.encode()
    for batch in batches:
        for part in by_bytes(batch, "text", 8 << 20):
            out = []
            lengths = pc.utf8_length(part.column("text")).to_pylist()
            for text, length in zip(part.column("text").cast(pa.binary()).to_pylist(), lengths):
                words = text.split()
                n = len(words)
                capitals = len(text) - len(text.translate(None, _UPPER))
                out.append(
                    (n < MIN_WORDS) + 2 * (100 * len(set(words)) < MIN_DISTINCT * n) + 4 * (100 * capitals > MAX_CAPITALS * length)
                    + 8 * (len(text.translate(None, signs)) < len(text))
                )
            at = part.schema.names.index("text")
            yield part.set_column(at, "mask", pa.array(out, pa.int32()))


def _digests(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Task: the digests of a batch by shard, each counted up to two."""
    for batch in batches:
        key, n = np.unique(batch.column("h").to_numpy(), return_counts=True)
        shard = (key.view(np.uint64) >> np.uint64(32)) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        names, first = np.unique(shard[order], return_index=True)
        cuts = [*first.tolist(), len(order)]
        yield pa.RecordBatch.from_arrays([
            pa.array(names.astype(np.int64)),
            pa.array([key[order[a:b]].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([np.minimum(n[order[a:b]], 2).astype(np.uint8).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        ], names=["shard", "digests", "counts"])


def places(digests: np.ndarray) -> np.ndarray:
    """Counters of each digest in the filter of its shard, one row for each hash."""
    word = digests.view(np.uint64)
    steps = [word * np.uint64(step) >> np.uint64(40) for step in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[:HASHES]]
    return np.stack(steps).astype(np.int64) % (SHARD * COUNTERS)


def _possible(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One shard: the counts of all tasks together, and the digests that may occur twice."""
    counters = np.zeros(SHARD * COUNTERS, np.uint8)
    parts = [np.frombuffer(d, np.int64) for d in table["digests"].to_pylist()]
    for digests, counts in zip(parts, table["counts"].to_pylist()):
        n = np.frombuffer(counts, np.uint8)
        for row in places(digests):
            # Digests of one task can share a counter: add them up, then stop at two.
            np.add(counters, np.minimum(np.bincount(row, n, len(counters)), 2).astype(np.uint8), out=counters)
            np.minimum(counters, 2, out=counters)
    digests = np.unique(np.concatenate(parts))
    return pa.table({"h": digests[(counters[places(digests)] == 2).all(axis=0)]})


def _screen(digests: DataFrame, bits: int) -> Column:
    """Test of a digest that all of ``digests.h`` pass, and few others."""
    place = lambda h: F.pmod(h, F.lit(bits))
    shared = digests.sparkSession.sparkContext.broadcast(bitmap(digests.select(place(F.col("h")).alias("b")), bits))

    @F.pandas_udf("boolean")
    def probe(at: pd.Series) -> pd.Series:
        b = at.to_numpy()
        return pd.Series((shared.value[b >> 6] >> (b & 63)) & 1 == 1)

    return probe(place(F.col("h")))


def mask_counts(docs: DataFrame, labels: DataFrame, *, seed: int = 0, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: rows of a part by the filters they fail (bit 0 for A), and those labelled good or toxic."""
    spark, text = docs.sparkSession, text_or_empty(docs, text_column)
    read = docs.select(
        docs[id_column].cast("long").alias("doc_id"), F.coalesce(docs[part_column].cast("string"), F.lit("")).alias("part"), text.alias("text"),
        F.xxhash64(text).alias("h"), F.xxhash64(F.lit(seed), text).alias("g"),
    )
    marked = labels.groupBy(labels["doc_id"].cast("long").alias("of_id")).agg(
        F.coalesce(F.max(labels["quality"] == 1), F.lit(False)).alias("good"), F.coalesce(F.max(labels["toxic"] == 1), F.lit(False)).alias("toxic")
    )
    masked = read.mapInArrow(_masked, "doc_id long, part string, mask int, h long, g long")
    no = F.lit(False)
    rows = stage(masked.join(marked, F.col("doc_id") == F.col("of_id"), "left").select(
        "doc_id", "part", "mask", "h", "g", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    ))
    shards = rows.count() // SHARD + 1
    packed = rows.select("h").mapInArrow(lambda b: _digests(b, shards), "shard long, digests binary, counts binary")
    possible = stage(packed.groupBy("shard").applyInArrow(_possible, "h long"))
    passes = _screen(possible, SCREEN_BITS)
    texts = read.select("text", "doc_id", "h", "g").where(passes).groupBy("h", "g", "text").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    groups = stage(texts.select("h", "g", "first", "last"))
    if not groups.groupBy("h", "g").count().where("count > 1").isEmpty():
        # Two different texts have the same two digests: take another second digest.
        for table in (rows, possible, groups):
            clear(table)
        return mask_counts(docs, labels, seed=seed + 1, id_column=id_column, text_column=text_column, part_column=part_column)
    repeated = groups.where("first < last").select("h", "g", "first")
    by = ["part", "mask", "good", "toxic"]
    some = rows.where(passes)
    named = some.where("doc_id IS NOT NULL")
    members = named.groupBy("h", "g", *by).agg(F.count("*").alias("n")).join(repeated, ["h", "g"]).select(*by, "n")
    firsts = named.join(repeated.withColumnRenamed("first", "doc_id"), ["h", "g", "doc_id"]).select(*by, F.lit(-1).cast("long").alias("n"))
    fails = stage(members.unionByName(firsts).groupBy(*by).agg(F.sum("n").alias("n")))
    every = rows.groupBy(*by).agg(F.count("*").alias("n"))
    moved = fails.withColumn("to", F.explode(F.array(F.struct(F.lit(0).alias("bit"), F.lit(-1).alias("sign")), F.struct(F.lit(_E).alias("bit"), F.lit(1).alias("sign")))))
    whole = every.unionByName(moved.select("part", (F.col("mask") + F.col("to.bit")).alias("mask"), "good", "toxic", (F.col("n") * F.col("to.sign")).alias("n")))
    count = lambda flag: F.sum(F.when(flag, F.col("n")).otherwise(0)).cast("long")
    result = stage(whole.groupBy("part", "mask").agg(F.sum("n").alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic")))
    for table in (rows, possible, groups, fails):
        clear(table)
    return result


def every_order(counts: DataFrame) -> DataFrame:
    """What each filter removes at each step of every order, from ``mask_counts``.

    One row per part, ``filter_order`` and ``step``; the counts are sums over the 32 masks.
    """
    steps = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for i, name in enumerate(order):
            own = 1 << FILTERS.index(name)
            steps.append(F.struct(F.lit(order).alias("filter_order"), F.lit(i + 1).alias("step"), F.lit(own).alias("own"), F.lit(before).alias("before")))
            before |= own
    met = counts.select("part", "mask", "n", "good", "toxic", F.explode(F.array(*steps)).alias("at")).select("part", "mask", "n", "good", "toxic", "at.*")
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda flag, column="n": F.sum(F.when(flag, F.col(column)).otherwise(0)).cast("long")
    found = met.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"), total(fails & ~gone, "good").alias("good_lost"), total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    # First of the filters that a row fails in as many orders as there are orders over filters failed.
    share = F.col("n") * (F.lit(120) / F.bit_count("mask")).cast("long")
    owned = counts.where("mask > 0").select("part", share.alias("n"), F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), (F.col("mask").bitwiseAND(F.lit(1 << i)) != 0).alias("fails")) for i, name in enumerate(FILTERS)
    ])).alias("f")).where("f.fails").groupBy(F.col("part").alias("of_part"), F.col("f.name").alias("name")).agg(F.sum("n").alias("shapley"))
    own = F.substring("filter_order", F.col("step"), F.lit(1))
    joined = found.join(owned, (F.col("part") == F.col("of_part")) & (own == F.col("name")), "left")
    return joined.select(*found.columns, F.coalesce("shapley", F.lit(0)).cast("long").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The whole audit: one row per part, order of the five filters, and step."""
    return every_order(mask_counts(docs, labels, **columns))
