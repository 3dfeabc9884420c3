"""Reproducible exact-size splits behind a token budget."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notepairs import constants as C
from notepairs.functions.prompts import render
from notepairs.functions.text import count_tokens, settle
from notepairs.session import clear, stage

_PREFIX = 4  # hex digits of the shuffle key: at most 65,536 counters reach the driver


def shuffle_key(key: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def cut_key(
    df: DataFrame, key: str, seed: str, fraction: float, *, where: Column | None = None
) -> tuple[int, str]:
    """Row count and the largest shuffle key among the first ``int(n * fraction)`` rows.

    Counts per key prefix find the one prefix the cut falls into; only that prefix,
    one row in 65,536, is then put in order, and only there ``where`` is tested again.
    Keys are unique by contract.
    """
    where = F.lit(True) if where is None else where
    h = shuffle_key(F.col(key), seed)
    prefix = F.substring(h, 1, _PREFIX)
    counts = df.filter(where).groupBy(prefix.alias("p")).count().collect()
    total = sum(r["count"] for r in counts)
    wanted = int(total * fraction)
    if wanted == 0:
        return total, ""
    seen = 0
    for p, n in sorted((r["p"], r["count"]) for r in counts):
        if seen + n >= wanted:
            break
        seen += n
    near = df.filter(prefix == p).filter(where).select(h.alias("h"))
    return total, near.orderBy("h").offset(wanted - seen - 1).limit(1).first()["h"]


def first_part(df: DataFrame, key: str, seed: str, fraction: float, *, where: Column | None = None) -> Column:
    """Condition that holds for exactly ``int(n * fraction)`` rows, picked at random by seed."""
    _, cut = cut_key(df, key, seed, fraction, where=where)
    return shuffle_key(F.col(key), seed) <= F.lit(cut)


def within_budget(
    text: Column, max_tokens: int, *, pad: int = 0, counter: Callable[[Column], Column] = count_tokens
) -> Column:
    return counter(text) + F.lit(pad) < F.lit(max_tokens)


def fits(
    max_tokens: int, *, template: str = C.SUMMARY_TEMPLATE, eos: str = "", pad: int = C.SAFE_TOKEN_PAD,
    counter: Callable[[Column], Column] = count_tokens,
) -> Column:
    """The filled training prompt of a pair stays below the budget, padding included."""
    text = F.concat(render(template, F.col("document"), F.col("summary")), F.lit(eos))
    return within_budget(text, max_tokens, pad=pad, counter=counter)


def length_gate(pairs: DataFrame, max_tokens: int, **gate) -> DataFrame:
    """Pairs that fit the budget; options as for ``fits``."""
    return pairs.filter(fits(max_tokens, **gate))


def split_pairs(
    pairs: DataFrame, max_tokens: int, *, seed: str = "0", learn_fraction: float = 0.9,
    ratio: tuple[float, float] = (0.9, 0.1), **gate,
) -> DataFrame:
    """Add ``split``: train and val below the token budget, test as it is.

    Both cuts are made on a stored table of ids and budget tests; the result reads the
    texts once and counts the tokens of a row once.
    """
    if abs(sum(ratio) - 1) > 1e-9:
        raise ValueError("the ratio must add up to 1")
    tested = stage(pairs.select("pair_id", fits(max_tokens, **gate).alias("fits")))
    learn = first_part(tested, "pair_id", f"{seed}:test", learn_fraction)
    train = first_part(tested, "pair_id", f"{seed}:val", ratio[0], where=learn & F.col("fits"))
    clear(tested)
    part = F.when(~learn, "test").when(fits(max_tokens, **gate), F.when(train, "train").otherwise("val"))
    return settle(pairs.withColumn("split", part), "split").filter(F.col("split").isNotNull())


def safe_ids(splits: DataFrame) -> DataFrame:
    """Ids of the pairs below the token budget: those of train and val."""
    return splits.filter(F.col("split") != "test").select("pair_id")


def split_manifest(
    splits: DataFrame, prompt: str, *, seed: str, ratio: tuple[float, float], max_tokens: int, **settings: object
) -> DataFrame:
    """One row that says how the splits were made and how many rows each holds."""
    size = lambda s: F.count_if(F.col("split") == s).alias(f"n_{s}")
    return splits.agg(size("train"), size("val"), size("test")).select(
        "*", F.lit(prompt).alias("prompt"), F.lit(seed).alias("seed"),
        F.lit(ratio[0]).alias("train_ratio"), F.lit(max_tokens).alias("max_tokens"),
        *[F.lit(value).alias(name) for name, value in settings.items()],
    )
