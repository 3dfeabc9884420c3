import math
import random

import numpy as np
import pytest

from notepairs.llm import pivots

COLUMNS = "vec_id long, embedding array<float>"


def brute(rows, k=20, every=20):
    """Full comparison of every query with all other rows."""
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i, tuple(math.floor(64 * float(np.float32(x))) for x in v)] = True
    out = []
    for i, v in whole:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if (j, w) != (i, v))[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def found(table, **how):
    return sorted(tuple(r) for r in pivots.search(table, queries=table["vec_id"] % 20 == 0, **how).collect())


def test_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert found(table) == brute([(r.vec_id, r.embedding) for r in table.collect()])


@pytest.mark.parametrize("ring, part, growth", [(2048, 8192, 8), (10, 7, 2)])
def test_clusters_ties_and_equal_vectors(spark, monkeypatch, ring, part, growth):
    """Crowded annuli, a third of all rows equal, and bounds that stop early."""
    for name, value in (("RING", ring), ("PART", part), ("GROWTH", growth)):
        monkeypatch.setattr(pivots, name, value)
    rng = np.random.default_rng(ring)
    centres = rng.normal(size=(12, 6)) * 3
    rows = [(i, [0.5, -0.25, 1.0, 0.0, 2.0, -1.0] if i % 3 == 0 else (centres[i % 12] + rng.normal(size=6) * 0.05).tolist()) for i in range(900)]
    rng.shuffle(rows)
    table = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in rows], COLUMNS).repartition(7)
    assert found(table) == brute(rows)
    assert found(table, k=3) == brute(rows, k=3)


def test_annuli_are_skipped(spark, monkeypatch):
    """With well-parted clusters, a query meets few annuli beyond its own."""
    monkeypatch.setattr(pivots, "RING", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 4)) * 50
    rows = [(i, (centres[i % 8] + rng.normal(size=4)).tolist()) for i in range(1600)]
    nodes = pivots.entries(spark.createDataFrame(rows, COLUMNS).select("vec_id", pivots.whole_numbers(pivots.F.col("embedding"), 64).alias("v")), 20)
    x = pivots._dense(pivots.pa.array(nodes.select("v").toArrow()["v"].to_pylist(), pivots.pa.list_(pivots.pa.int64())), 4)
    longest = int((x * x).sum(axis=1).max())
    centre = pivots.choose_pivots(pivots._lifted(x, longest), 8)
    away = pivots._distances(pivots._lifted(x, longest), centre)
    near, r = away.argmin(axis=1), away.min(axis=1)
    rings = {"pivot": np.arange(8), "low": np.array([r[near == p].min() for p in range(8)]), "high": np.array([r[near == p].max() for p in range(8)])}
    score = x @ x.T
    best = np.sort(score, axis=1)[:, -21]
    _, most = pivots._bounds(x, centre, rings, longest)
    true = np.stack([score[:, near == p].max(axis=1) for p in range(8)], axis=1)
    assert (most >= true).all()
    assert (most >= best[:, None]).mean() < 0.5


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (20, None), (40, [None, 1.0]), (60, [nan, 1.0]), (80, [inf, 0.0]), (100, []), (120, [0.5]), (None, [1.0, 1.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]),
        (3, [-1.0, 0.3]), (3, [-1.0, 0.3]), (140, [1.0, 2.0]), (140, [1.0, 2.0]), (160, [2.0, 2.0]), (160, [-3.0, 2.0]),
    ]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS + ", score int, node string")
    assert found(table) == brute(rows)
    assert found(table.limit(0)) == []
    assert found(table.where("vec_id = 20")) == []
    one = spark.createDataFrame([(0, [1.0])], COLUMNS)
    assert found(one) == []


def test_large_components_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randrange(-(1 << 20), 1 << 20)) for _ in range(5)]) for i in range(120)]
    assert found(spark.createDataFrame(rows, COLUMNS)) == brute(rows)
