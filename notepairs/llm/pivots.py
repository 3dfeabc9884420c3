"""Exact top-k search by inner product with a pivot-distance index.

Vectors are whole numbers (components times ``scale``, rounded down). One more component
gives all of them the same length, so the largest inner products are the nearest vectors and
distances obey the triangle inequality. A vector is keyed by its nearest pivot and its
distance to it; the vectors of a pivot are cut into annuli by distance. For a query at
distance ``d`` of a pivot, nothing in an annulus from ``low`` to ``high`` is nearer than
``low - d`` or ``d - high``, which bounds its scores.

A query visits annuli in the order of their bounds, in rounds of 1, 8, 64, ... annuli, and
stops when no bound left reaches its k-th best score so far, ties included. Inside an annulus
only the ring that the bound leaves is compared. So results are exact, whatever the pivots;
these come from at most ``SAMPLE`` vectors and decide the cost alone. Vectors without
structure leave nothing to skip: then all annuli are visited, and rows made stay in
proportion to the queries times the rounds.

Equal vectors are one entry with its ``k + 1`` smallest ids: no other of them can be in a
result. Pivots and annuli are at most ``PIVOTS`` and ``PIVOTS * RINGS``; a full annulus is
cut into parts of about ``PART`` entries, so a crowded one spreads over tasks.

Defined cases: vectors that are null or hold a null or non-finite component, and rows without
an id, take no part; a vector shorter than others counts as filled up with zeros; rows that
agree in id and vector are one row; ties go to the smaller id; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notepairs.session import clear, stage

SAMPLE = 4096
PIVOTS = 256
RINGS = 16
#: Entries of an annulus before it is cut by distance, and of a part of one.
RING = 2048
PART = 8192
GROWTH = 8
_SWEEPS = 5
_SALTS = 64
_NONE = -(1 << 62)
_FOUND = "node long, score long, vec_id long"


def whole_numbers(vector: Column, scale: int) -> Column:
    """Components times ``scale`` rounded down; null where a component is null or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.when(F.forall(vector, finite), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """``node, v, ids``: one row per different vector of ``vec_id, v``, with its ``k + 1`` smallest ids."""
    salted = rows.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS)))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("vec_id"))
    few = salted.withColumn("at", place("v", "salt")).where(F.col("at") <= k + 1).drop("at")
    few = few.withColumn("at", place("v")).where(F.col("at") <= k + 1)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.monotonically_increasing_id().alias("node"), "v", "ids")


def _dense(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of equal width, filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def _lifted(x: np.ndarray, longest: int) -> np.ndarray:
    """Vectors with one more component, so that all have the squared length ``longest``."""
    x = x.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` centres of a sample, by a few sweeps from evenly spaced rows of it."""
    centres = sample[np.linspace(0, len(sample) - 1, n).astype(int)]
    for _ in range(_SWEEPS):
        near = _distances(sample, centres).argmin(axis=1)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=n)
        np.add.at(sums, near, sample)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _keyed(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, dim: int, longest: int) -> Iterator[pa.RecordBatch]:
    """Task: nearest pivot and distance of every entry, its vector packed."""
    for batch in batches:
        if batch.num_rows:
            x = _dense(batch.column("v"), dim)
            away = _distances(_lifted(x, longest), pivots)
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), pa.array(away.argmin(axis=1)), pa.array(away.min(axis=1)),
                pa.array([row.tobytes() for row in x.astype(_width(longest))], pa.binary()), batch.column("ids"),
            ], names=["node", "pivot", "r", "x", "ids"])


def _width(longest: int) -> type:
    """Smallest integer type for the components."""
    return np.int16 if longest < 1 << 30 else np.int64


def _bounds(rows: np.ndarray, pivots: np.ndarray, rings: dict[str, np.ndarray], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances of queries to pivots, and for each annulus the most that a score can be."""
    x = rows.astype(np.float64)
    away = _distances(np.hstack([x, np.zeros((len(x), 1))]), pivots)
    d = away[:, rings["pivot"]]
    gap = np.maximum(np.maximum(rings["low"] - d, d - rings["high"]), 0)
    most = ((x * x).sum(axis=1)[:, None] + longest - gap * gap) / 2
    return away, np.floor(most + 1e-6 * (1 + np.abs(most)))


def _routed(batches: Iterator[pa.RecordBatch], pivots, rings, dim: int, longest: int, first: int, last: int) -> Iterator[pa.RecordBatch]:
    """Task: its queries packed for each annulus that stands from ``first`` to ``last`` in their order and can still score."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _dense(batch.column("v"), dim)
        node, best = batch.column("node").to_numpy(), batch.column("best").to_numpy()
        away, most = _bounds(x, pivots, rings, longest)
        order = np.argsort(-most, axis=1, kind="stable")[:, first:last]
        row, at = np.nonzero(np.take_along_axis(most, order, axis=1) >= best[:, None])
        ring = order[row, at]
        by = np.argsort(ring, kind="stable")
        names, starts = np.unique(ring[by], return_index=True)
        out: dict[str, list] = {c: [] for c in ("ring", "part", "nodes", "x", "away", "best")}
        for name, rows in zip(names.tolist(), np.split(row[by], starts[1:])):
            for part in range(rings["parts"][name]):
                out["ring"].append(name)
                out["part"].append(part)
                out["nodes"].append(node[rows].tobytes())
                out["x"].append(x[rows].astype(_width(longest)).tobytes())
                out["away"].append(away[rows, rings["pivot"][name]].tobytes())
                out["best"].append(best[rows].tobytes())
        yield pa.RecordBatch.from_arrays([
            pa.array(out["ring"], pa.int64()), pa.array(out["part"], pa.int64()), *(pa.array(out[c], pa.binary()) for c in ("nodes", "x", "away", "best")),
        ], names=list(out))


def _product(x: np.ndarray, y: np.ndarray, longest: int) -> np.ndarray:
    """Inner products, exact: in floating point while every sum stays below 2 ** 53."""
    if longest < 1 << 52:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return x.astype(np.int64) @ y.astype(np.int64).T


def _searched(queries: pa.Table, index: pa.Table, k: int, dim: int, longest: int) -> pa.Table:
    """One part of an annulus: the best entries of every query that reach its best score so far."""
    nodes, scores, found = [], [], []
    if queries.num_rows and index.num_rows:
        index = index.sort_by("r")
        r, kind = index["r"].to_numpy(), _width(longest)
        y = np.frombuffer(b"".join(index["x"].to_pylist()), kind).reshape(-1, dim)
        ids = index["ids"].combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        begin, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
        for packed in queries.to_pylist():
            node, away, best = (np.frombuffer(packed[c], t) for c, t in (("nodes", np.int64), ("away", np.float64), ("best", np.int64)))
            x = np.frombuffer(packed["x"], kind).reshape(-1, dim)
            for a in range(0, len(node), 256):
                cut = slice(a, a + 256)
                q = x[cut].astype(np.float64)
                # The ring around the pivot that can hold a score of at least ``best``.
                wide = np.sqrt(np.maximum((q * q).sum(axis=1) + longest - 2.0 * np.maximum(best[cut], -(1 << 52)), 0)) * (1 + 1e-9) + 1e-6
                low, high = np.searchsorted(r, (away[cut] - wide).min(), "left"), np.searchsorted(r, (away[cut] + wide).max(), "right")
                if low >= high:
                    continue
                score = _product(x[cut], y[low:high], longest)
                least = best[cut].copy()
                if high - low > k:
                    least = np.maximum(least, np.partition(score, high - low - k - 1, axis=1)[:, high - low - k - 1])
                row, at = np.nonzero(score >= least[:, None])
                n = begin[low + at + 1] - begin[low + at]
                nodes.append(np.repeat(node[cut][row], n))
                scores.append(np.repeat(score[row, at], n))
                offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                found.append(flat[np.repeat(begin[low + at], n) + offset])
    join = lambda xs: pa.array(np.concatenate(xs) if xs else np.zeros(0, np.int64), pa.int64())
    return pa.table({"node": join(nodes), "score": join(scores), "vec_id": join(found)})


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k + 1`` best of every query: the highest scores, then the smallest ids."""
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("at", rank).where(F.col("at") <= k + 1)


def search(
    vectors: DataFrame, *, queries: Column, k: int = 20, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of every row that ``queries`` holds for, its own row aside."""
    rows = vectors.select(vectors[id_column].cast("long").alias("vec_id"), whole_numbers(vectors[vector_column], scale).alias("v"), queries.alias("asks"))
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL")
    nodes = stage(entries(rows.select("vec_id", "v"), k))
    asked = stage(rows.where("asks").select("vec_id", "v").distinct().join(nodes.select("node", "v"), "v").select(
        F.col("vec_id").alias("query_id"), "node", "v", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x).alias("own")
    ))
    square = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)
    n, dim, longest = nodes.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(square), F.lit(0))).first()
    dim = max(dim, 1)
    sample = nodes.orderBy(F.xxhash64("v"), "node").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    sample = sample.chunk(0) if isinstance(sample, pa.ChunkedArray) else sample
    found = None
    if n:
        few = min(PIVOTS, max(1, math.isqrt(n) // 4), len(sample))
        pivots = choose_pivots(_lifted(_dense(sample, dim), longest), few)
        keyed = stage(nodes.mapInArrow(lambda b: _keyed(b, pivots, dim, longest), "node long, pivot long, r double, x binary, ids array<long>"))
        index, rings = _annuli(keyed)
        state = stage(asked.groupBy("node").agg(F.first("v").alias("v")).withColumn("best", F.lit(_NONE).cast("long")))
        found, first, last = None, 0, 1
        while first < len(rings["low"]):
            args = (pivots, rings, dim, longest, first, last)
            routed = state.mapInArrow(lambda b, args=args: _routed(b, *args), "ring long, part long, nodes binary, x binary, away binary, best binary")
            new = routed.groupBy("ring", "part").cogroup(index.groupBy("ring", "part")).applyInArrow(lambda q, i: _searched(q, i, k, dim, longest), _FOUND)
            better = stage(_best(new if found is None else new.unionByName(found.drop("at")), k))
            full = better.where(F.col("at") == k + 1).select(F.col("node").alias("of"), F.col("score").alias("reached"))
            now = stage(state.join(full, F.col("node") == F.col("of"), "left").select("node", "v", F.coalesce("reached", "best").alias("best")))
            for old in (state, found):
                if old is not None:
                    clear(old)
            found, state = better, now
            first, last = last, last * GROWTH
        clear(state)
        clear(keyed)
    clear(nodes)
    if found is None:
        return asked.select("query_id", F.lit(0).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    copies = Window.partitionBy("node", "score", "vec_id").orderBy("at")
    met = asked.drop("v").join(found.withColumn("copy", F.row_number().over(copies)), "node")
    others = met.where(~((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own")) & (F.col("copy") == 1)))
    ranked = others.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "node").orderBy("at")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _annuli(keyed: DataFrame) -> tuple[DataFrame, dict[str, np.ndarray]]:
    """The entries by annulus and part, and the bounded list of annuli."""
    cuts = [i / RINGS for i in range(1, RINGS)]
    edges = keyed.groupBy("pivot").agg(F.count("*").alias("n"), F.percentile_approx("r", cuts, 1000).alias("cuts")).collect()
    rows = []
    for e in edges:
        rings = min(RINGS, e["n"] // RING + 1)
        rows.append((e["pivot"], [e["cuts"][round(i * RINGS / rings) - 1] for i in range(1, rings)]))
    bounds = {p: np.array(c) for p, c in rows}

    def ringed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, r = batch.column("pivot").to_numpy(), batch.column("r").to_numpy()
            ring = np.zeros(len(r), np.int64)
            for p in np.unique(pivot).tolist():
                mine = pivot == p
                ring[mine] = p * RINGS + np.searchsorted(bounds[p], r[mine], "left")
            yield batch.append_column("ring", pa.array(ring))

    marked = keyed.mapInArrow(ringed, "node long, pivot long, r double, x binary, ids array<long>, ring long")
    known = marked.groupBy("ring").agg(F.min("pivot").alias("pivot"), F.min("r").alias("low"), F.max("r").alias("high"), F.count("*").alias("n")).orderBy("ring").collect()
    place = F.lit(0).cast("long")
    number, parts = {k["ring"]: i for i, k in enumerate(known)}, np.array([k["n"] // PART + 1 for k in known])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ringed(batches):
            ring = np.array([number[x] for x in batch.column("ring").to_pylist()], np.int64)
            part = batch.column("salt").to_numpy() % parts[ring] if len(ring) else ring
            yield pa.RecordBatch.from_arrays([pa.array(ring), pa.array(part), batch.column("r"), batch.column("x"), batch.column("ids")], names=["ring", "part", "r", "x", "ids"])

    salted = keyed.withColumn("salt", F.shiftrightunsigned(F.xxhash64("node"), 1) + place)
    index = salted.mapInArrow(numbered, "ring long, part long, r double, x binary, ids array<long>")
    return index, {
        "pivot": np.array([k["pivot"] for k in known], np.int64), "low": np.array([k["low"] for k in known], float),
        "high": np.array([k["high"] for k in known], float), "parts": parts,
    }
