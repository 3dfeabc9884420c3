"""Scores of candidate texts against reference texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notepairs.functions.stemming import stem_tokens
from notepairs.functions.text import count_tokens
from notepairs.operators.splits import within_budget


def eval_pairs(
    pairs: DataFrame, candidates: DataFrame, *, max_tokens: int | None = None,
    counter: Callable[[Column], Column] = count_tokens,
) -> DataFrame:
    """References with a document and a candidate; optionally only short documents."""
    kept = pairs.filter(F.col("document") != "")
    if max_tokens is not None:
        kept = kept.filter(within_budget(F.col("document"), max_tokens, counter=counter))
    return kept.select("pair_id", F.col("summary").alias("reference")).join(
        candidates.select("pair_id", "candidate"), "pair_id", "inner"
    )


def score_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), 0)


def _grams(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    runs = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " ")
    )
    return F.when(F.size(tokens) >= n, runs).otherwise(F.array().cast("array<string>"))


def with_score_tokens(evals: DataFrame, *extra: str, stemmed: bool = True) -> DataFrame:
    """Token arrays of both texts in ``ref`` and ``cand``, and further columns as they are."""
    wrap = stem_tokens if stemmed else (lambda c: c)
    return evals.select(
        "pair_id", *extra, wrap(score_tokens(F.col("reference"))).alias("ref"),
        wrap(score_tokens(F.col("candidate"))).alias("cand"),
    )


def prf(name: str, overlap: Column, n_ref: Column, n_cand: Column) -> list[Column]:
    """Precision, recall and their harmonic mean, each zero without overlap."""
    one = F.lit(1)
    p = overlap.cast("double") / F.greatest(n_cand, one)
    r = overlap.cast("double") / F.greatest(n_ref, one)
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return [p.alias(f"{name}_precision"), r.alias(f"{name}_recall"), f.alias(f"{name}_f1")]


#: Tokens of one side that a tile of the comparison table holds.
LCS_TILE = 1 << 13


def longest_common(xs: Sequence[str], ys: Sequence[str], *, tile: int = LCS_TILE) -> int:
    """Length of the longest common subsequence of two token sequences.

    One bit per token of ``xs``: each token of ``y`` updates a whole row of the comparison
    table with a few operations on a wide integer. The table is cut into tiles of ``tile``
    tokens of ``xs``; what the addition carries over from a tile at each token of ``ys``
    is handed to the next one, so memory is bound by a tile and one byte per token of
    ``ys``, whatever the lengths. Tokens that only one side has cannot count and are left out.
    """
    shared = set(xs) & set(ys)
    xs, ys = [x for x in xs if x in shared], [y for y in ys if y in shared]
    carries, length = bytearray(len(ys)), 0
    for at in range(0, len(xs), tile):
        part = xs[at : at + tile]
        where: dict[str, int] = {}
        for i, x in enumerate(part):
            where[x] = where.get(x, 0) | (1 << i)
        full = (1 << len(part)) - 1
        row = full
        for j, y in enumerate(ys):
            match = row & where.get(y, 0)
            if match or carries[j]:
                total = row + match + carries[j]
                carries[j] = total >> len(part)
                row = (total & full) | (row & ~match)
        length += len(part) - row.bit_count()
    return length


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two token arrays."""

    @F.pandas_udf("int")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([longest_common(x, y) for x, y in zip(left, right)], dtype="int32")

    return run(a, b)


def _clipped(sides: list[tuple[np.ndarray, np.ndarray]], n: int) -> list[np.ndarray]:
    """Grams that both sides of each of ``n`` rows hold, as often as both do, and the totals of both."""
    most = 1 + max((int(grams.max()) for _, grams in sides if len(grams)), default=0)
    (a, x), (b, y) = (np.unique(rows * most + grams, return_counts=True) for rows, grams in sides)
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = np.bincount(both // most, weights=np.minimum(x[i], y[j]), minlength=n).astype(np.int64)
    return [shared, *(np.bincount(rows, minlength=n) for rows, _ in sides)]


def _own(sizes: tuple[int, ...]) -> list[str]:
    return [*(f"{x}{n}" for n in sizes for x in ("both", "ref", "cand")), "lcs"]


def _row_overlaps(ref: Column, cand: Column, sizes: tuple[int, ...]) -> Column:
    """Struct of clipped overlap and both totals of one row per gram size, and its longest common subsequence.

    Tokens and grams of a whole batch are numbers, which are sorted and counted together.
    """
    names = _own(sizes)

    @F.arrow_udf(", ".join(f"{x} {'int' if x == 'lcs' else 'long'}" for x in names))
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        lengths = [x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for x in (left, right)]
        rows = [np.repeat(np.arange(len(n)), n) for n in lengths]
        flat = pa.concat_arrays([left.flatten(), right.flatten()])
        tokens = np.split(flat.dictionary_encode().indices.to_numpy().astype(np.int64), [len(rows[0])])
        grams, out = tokens, []
        for n in range(1, max(sizes) + 1):
            if n > 1:
                # Runs that pass the end of their row are left out where grams are counted.
                longer = [g[: max(len(t) - n + 1, 0)] * (len(flat) + 1) + t[n - 1 :] for g, t in zip(grams, tokens)]
                grams = np.split(np.unique(np.concatenate(longer), return_inverse=True)[1], [len(longer[0])])
            if n in sizes:
                inside = [r[: len(g)] == r[n - 1 :] for g, r in zip(grams, rows)]
                out += _clipped([(r[: len(g)][i], g[i]) for g, r, i in zip(grams, rows, inside)], len(left))
        a, b = ([t[end - k : end].tolist() for k, end in zip(n, np.cumsum(n))] for t, n in zip(tokens, lengths))
        out.append(np.array([longest_common(x, y) for x, y in zip(a, b)], np.int32))
        return pa.StructArray.from_arrays([pa.array(x) for x in out], names=names)

    return run(ref, cand)


def _gram_rows(tokens: DataFrame, sizes: tuple[int, ...], extra: tuple[str, ...] = (), only: Column | None = None) -> DataFrame:
    """Every gram of both sides as a row (pair_id, n, g, r, c), and one row without a gram; where ``only`` is false, that one alone."""
    def entry(n: int, r: int, c: int) -> Callable[[Column], Column]:
        return lambda gram: F.struct(
            F.lit(n).alias("n"), gram.alias("g"), F.lit(r).alias("r"), F.lit(c).alias("c")
        )

    # The first entry keeps pairs without any token.
    entries = [F.array(entry(0, 0, 0)(F.lit("")))]
    for n in sizes:
        entries.append(F.transform(_grams(F.col("ref"), n), entry(n, 1, 0)))
        entries.append(F.transform(_grams(F.col("cand"), n), entry(n, 0, 1)))
    every = F.concat(*entries)
    return tokens.select("pair_id", *extra, F.explode(every if only is None else F.when(only, every).otherwise(entries[0])).alias("e")).select(
        "pair_id", *extra, "e.*"
    )


def _gram_overlaps(rows: DataFrame, sizes: tuple[int, ...], extra: tuple[str, ...] = ()) -> DataFrame:
    """Per pair and gram size: clipped overlap and both totals.

    Everything is keyed by the pair, so after a join on the pair no further shuffle is
    needed; otherwise only counts per gram move.
    """
    keep = [F.first(x).alias(x) for x in extra]
    counts = rows.groupBy("pair_id", "n", "g").agg(F.sum("r").alias("r"), F.sum("c").alias("c"), *keep)
    of = lambda n, x: F.coalesce(F.sum(F.when(F.col("n") == n, x)), F.lit(0))
    totals = []
    for n in sizes:
        totals += [
            of(n, F.least("r", "c")).alias(f"both{n}"), of(n, F.col("r")).alias(f"ref{n}"),
            of(n, F.col("c")).alias(f"cand{n}"),
        ]
    return counts.groupBy("pair_id").agg(*totals, *keep)


def _counted_rows(evals: DataFrame, sizes: tuple[int, ...], *, stemmed: bool) -> DataFrame:
    """``_gram_rows`` of the pairs in several rows, whose counts add up before they are clipped.

    A pair in one row, the common case, is counted where it is: it is ``alone`` and gives one
    row with its counts in ``own_*``, so the texts move once and its grams never.
    """
    alone = F.count("*").over(Window.partitionBy("pair_id")) == 1
    known = evals.withColumn("alone", alone).filter("reference IS NOT NULL AND candidate IS NOT NULL")
    tokens = with_score_tokens(known, "alone", stemmed=stemmed)
    counted = tokens.withColumn("own", _row_overlaps(F.col("ref"), F.col("cand"), sizes))
    own = _own(sizes)
    return _gram_rows(counted, sizes, ("alone", "own"), ~F.col("alone")).select("*", *(F.col(f"own.{x}").alias(f"own_{x}") for x in own)).drop("own")


def rouge_n(evals: DataFrame, n: int, *, stemmed: bool = True) -> DataFrame:
    """Overlap of token runs of length ``n``."""
    found = _gram_overlaps(_gram_rows(with_score_tokens(evals, stemmed=stemmed), (n,)), (n,))
    return found.select("pair_id", *prf(f"rouge{n}", F.col(f"both{n}"), F.col(f"ref{n}"), F.col(f"cand{n}")))


def rouge_l(evals: DataFrame, *, stemmed: bool = True) -> DataFrame:
    """Longest common subsequence of tokens."""
    tokens = with_score_tokens(evals, stemmed=stemmed)
    return tokens.withColumn("lcs", lcs_length(F.col("ref"), F.col("cand"))).select(
        "pair_id", *prf("rougeL", F.col("lcs"), F.size("ref"), F.size("cand"))
    )


def rouge(evals: DataFrame, *, stemmed: bool = True) -> DataFrame:
    """All nine overlap scores in one pass over the texts."""
    sizes = (1, 2)
    own = _own(sizes)
    found = _gram_overlaps(_counted_rows(evals, sizes, stemmed=stemmed), sizes, ("alone", *(f"own_{x}" for x in own)))
    c = lambda x: F.when(F.col("alone"), F.col(f"own_{x}")).otherwise(F.col(x))
    return found.select(
        "pair_id", *prf("rouge1", c("both1"), c("ref1"), c("cand1")),
        *prf("rouge2", c("both2"), c("ref2"), c("cand2")), *prf("rougeL", F.col("own_lcs"), c("ref1"), c("cand1")),
    )


def rescaled(score: Column, baseline: float) -> Column:
    """Score relative to a baseline: one stays one, the baseline becomes zero."""
    return (score - F.lit(baseline)) / F.lit(1 - baseline)


def metric_means(model: str, *tables: DataFrame) -> DataFrame:
    """Mean of every numeric column of every table, one row per metric; nulls are skipped."""
    out = None
    for table in tables:
        numeric = [f.name for f in table.schema if f.dataType.typeName() in ("double", "float", "integer", "long")]
        means = table.agg(*[F.avg(n).alias(n) for n in numeric]).unpivot([], numeric, "metric", "mean")
        out = means if out is None else out.unionByName(means)
    return out.select(F.lit(model).alias("model"), "metric", "mean")
