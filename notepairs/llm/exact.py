"""Exact deduplication of a batch against immutable snapshots.

A snapshot is a set of exact groups, one row per digest, in shards by digest, with one
static binary fuse filter per shard. A new batch is grouped by digest on its own. The
filters screen its digests: a digest that a filter rejects is new and never meets the
snapshot's groups; a digest that passes joins the groups on the digest, and the two
representatives are compared byte for byte.

Defined cases: a null text is empty; texts are equal when they agree after removal of
ASCII white space; a null id orders before every other id; rows that agree in id and
text are one row repeated, of which one may be kept; an empty table gives an empty
result; columns besides id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notepairs.llm.common import only_kept, rows_of, without_whitespace
from notepairs.session import stage

#: Digests of one filter, and of one group in a Python task.
SHARD_KEYS = 65_536
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_FILTER = "shard long, seed long, segment int, segments int, cells binary"


def _hashes(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three cells of every key, in consecutive segments, and its fingerprint byte."""
    h = keys + np.uint64(seed)
    for _ in range(2):
        h = (h ^ (h >> np.uint64(33))) * _MIX
    h ^= h >> np.uint64(33)
    first = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Static 3-wise binary fuse filter with 8-bit fingerprints: seed, segment, segments, cells.

    Cells with a single key are peeled together, round by round; filling the rounds in
    reverse makes the three cells of every key XOR to its fingerprint.
    """
    keys = np.unique(keys)
    n = max(len(keys), 2)
    segment = min(1 << int(np.log(n) / np.log(3.33) + 2.25), 1 << 18)
    capacity = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n)))
    segments = max(1, -(-capacity // segment) - 2)
    size = (segments + 2) * segment
    for seed in range(1, 1000):
        cells, prints = _hashes(keys, seed * 0x9E3779B97F4A7C15 % (1 << 63), segment, segments)
        count = np.bincount(cells.ravel(), minlength=size)
        which = np.zeros(size, np.int64)
        for row in cells:
            np.bitwise_xor.at(which, row, np.arange(len(keys)))
        rounds, left = [], len(keys)
        while left:
            alone = np.flatnonzero(count == 1)
            if not len(alone):
                break
            owner, first = np.unique(which[alone], return_index=True)
            alone = alone[first]
            rounds.append((owner, alone))
            for row in cells[:, owner]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(which, row, owner)
            left -= len(owner)
        if not left:
            table = np.zeros(size, np.uint8)
            for owner, alone in reversed(rounds):
                a, b, c = cells[:, owner]
                table[alone] = prints[owner] ^ table[a] ^ table[b] ^ table[c] ^ table[alone]
            return seed * 0x9E3779B97F4A7C15 % (1 << 63), segment, segments, table.tobytes()
    raise ValueError("no seed gives a filter")


def may_contain(keys: np.ndarray, seed: int, segment: int, segments: int, cells: bytes) -> np.ndarray:
    """True for every key of the filter and for about one of 256 others."""
    (a, b, c), prints = _hashes(keys, seed, segment, segments)
    table = np.frombuffer(cells, np.uint8)
    return (table[a] ^ table[b] ^ table[c]) == prints


def _filter_of(key: tuple[pa.Scalar, ...], shard: pa.Table) -> pa.Table:
    seed, segment, segments, cells = build_filter(shard["key"].to_numpy().view(np.uint64))
    return pa.table({
        "shard": pa.array([key[0].as_py()], pa.int64()), "seed": pa.array([seed], pa.int64()), "segment": pa.array([segment], pa.int32()),
        "segments": pa.array([segments], pa.int32()), "cells": pa.array([cells], pa.binary()),
    })


def _screen(batch: pa.Table, filters: pa.Table) -> pa.Table:
    if not batch.num_rows or not filters.num_rows:
        return batch.select(["digest"]).slice(0, 0)
    f = filters.slice(0, 1).to_pylist()[0]
    found = may_contain(batch["key"].to_numpy().view(np.uint64), f["seed"], f["segment"], f["segments"], f["cells"])
    return batch.select(["digest"]).filter(pa.array(found))


@dataclass
class Snapshot:
    """Stored groups (``digest, key, best, size``) of a snapshot and its filters by shard."""

    groups: DataFrame
    filters: DataFrame
    shards: int


def digest_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, row_key, digest, n_chars``: the SHA-256 of a text without white space, and its length."""
    rows = rows_of(docs, id_column, text_column)
    digest = F.unhex(F.sha2(without_whitespace(F.col("text")).cast("binary"), 256))
    return rows.select("doc_id", "row_key", digest.alias("digest"), F.length("text").alias("n_chars"))


def group_digests(rows: DataFrame) -> DataFrame:
    """One row per digest: the representative (longest, then smallest id) and the number of rows."""
    best = F.min(F.struct((-F.col("n_chars")).alias("order"), "doc_id", "row_key"))
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("size")).withColumn("key", F.xxhash64("digest"))


def build_snapshot(rows: DataFrame) -> Snapshot:
    """Group the digests of a finished batch, store them and build one filter per shard."""
    groups = stage(group_digests(rows))
    shards = 1
    while shards * SHARD_KEYS < groups.count():
        shards *= 2
    keyed = groups.select(F.col("key").bitwiseAND(shards - 1).alias("shard"), "key")
    return Snapshot(groups, stage(keyed.groupBy("shard").applyInArrow(_filter_of, _FILTER)), shards)


def positives(batch: DataFrame, n_batch: int, snapshot: Snapshot) -> DataFrame:
    """Digests of a grouped batch that the snapshot's filters let pass.

    A batch larger than the snapshot sends several parts of a shard, each with its own
    copy of the small filter, so a task never holds more than about ``SHARD_KEYS`` digests.
    """
    parts = max(1, -(-n_batch // (snapshot.shards * SHARD_KEYS)))
    left = batch.select(
        "digest", "key", F.col("key").bitwiseAND(snapshot.shards - 1).alias("shard"),
        F.pmod(F.shiftright("key", 40), F.lit(parts)).alias("part"),
    )
    right = snapshot.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")))
    return left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(_screen, "digest binary")


def _same_bytes(pairs: DataFrame, docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Digests of ``pairs`` (``digest, old, new``) whose two representatives have equal bytes."""
    wanted = pairs.select("digest", F.explode(F.array("old", "new")).alias("row")).select(
        "digest", F.col("row.doc_id").alias("want_id"), F.col("row.row_key").alias("want_key")
    )
    rows = rows_of(docs, id_column, text_column)
    # The number of pairs grows with the input, so the join is one that does not depend on it.
    texts = rows.join(wanted.hint("merge"), rows["doc_id"].eqNullSafe(wanted["want_id"]) & (rows["row_key"] == wanted["want_key"]))
    bare = texts.select("digest", without_whitespace(F.col("text")).cast("binary").alias("bare"))
    return bare.groupBy("digest").agg(F.min("bare").alias("a"), F.max("bare").alias("b")).where("a = b").select("digest")


def exact_groups(
    docs: DataFrame, *, in_snapshot: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The group of every row: ``doc_id, row_key, keep_id, keep_key, group_size, kept, copies, digest``.

    ``in_snapshot`` is an SQL condition on ``doc_id`` that names the rows of the earlier,
    immutable snapshot; the others are the new batch. Without it every second id by
    checksum is in the snapshot. The result does not depend on the cut.

    The longest text, then the smallest id represents a group, over snapshot and batch
    together. Group sizes are counted before any join, and rows meet their group in a
    join of two stored tables, which adaptive execution splits for a hot group.
    """
    cut = F.expr(in_snapshot or "pmod(crc32(cast(doc_id AS string)), 2) = 0")
    rows = stage(digest_rows(docs, id_column, text_column).withColumn("new", ~F.coalesce(cut, F.lit(False))))
    snapshot = build_snapshot(rows.where(~F.col("new")))
    batch = stage(group_digests(rows.where("new")))
    screened = positives(batch, batch.count(), snapshot)
    old = snapshot.groups.select("digest", F.col("best").alias("old"), F.col("size").alias("old_size"))
    met = stage(batch.withColumnRenamed("best", "mine").join(screened, "digest").join(old, "digest"))
    same = _same_bytes(met.select("digest", "old", F.col("mine").alias("new")), docs, id_column, text_column)
    merged = stage(met.join(same, "digest").select(
        "digest", F.least("old", "mine").alias("best"), (F.col("old_size") + F.col("size")).alias("size")
    ))
    untouched = snapshot.groups.join(merged, "digest", "left_anti").select("digest", "best", "size", F.lit(False).alias("new"))
    fresh = batch.join(merged, "digest", "left_anti").select("digest", "best", "size", F.lit(True).alias("new"))
    both = merged.withColumn("new", F.explode(F.array(F.lit(False), F.lit(True)))).select("digest", "best", "size", "new")
    groups = stage(untouched.unionByName(fresh).unionByName(both))
    repeats = rows.groupBy("digest", "new", "doc_id", "row_key").agg(F.count("*").alias("copies"))
    found = stage(repeats).join(groups, ["digest", "new"])
    first = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("row_key") == F.col("best.row_key"))
    return found.select(
        "doc_id", "row_key", F.col("best.doc_id").alias("keep_id"), F.col("best.row_key").alias("keep_key"),
        F.col("size").alias("group_size"), first.alias("first"), "copies", "digest",
    ).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", "row_key", "keep_id", "keep_key", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"), "copies", "digest"
    )


def drop_exact(docs: DataFrame, *, in_snapshot: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts, columns unchanged."""
    kept = stage(
        exact_groups(docs, in_snapshot=in_snapshot, id_column=id_column, text_column=text_column)
        .where("kept").select("doc_id", "row_key", "copies")
    )
    return only_kept(docs, kept, id_column, text_column)


