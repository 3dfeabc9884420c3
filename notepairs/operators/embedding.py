"""Greedy matching of token vectors: each token counts with its best cosine on the other side."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512
#: Blocks of a side while these are small enough, and vectors of a block beyond.
SIDE_BLOCKS, MOST = 8, 1 << 13
#: Cosines that a task holds at a time.
_CELLS = 1 << 21


def _units(column: pa.ListArray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Tokens and unit vectors of every row of a column of lists of both."""
    items = column.flatten()
    tokens, vectors = items.field("token"), items.field("vector")
    if vectors.null_count:
        raise ValueError("a vector is null")
    ends = np.cumsum([0, *column.value_lengths().to_numpy()])
    lengths = vectors.value_lengths().to_numpy()
    places = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    numbers = vectors.flatten().to_numpy(zero_copy_only=False)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if b > a and (lengths[a:b] != lengths[a]).any():
            raise ValueError("the vectors of a pair differ in length")
        m = numbers[places[a] : places[b]].astype("float64").reshape(b - a, lengths[a] if b > a else 0)
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        yield tokens.slice(a, b - a), m / np.where(norm == 0, 1, norm)


def _best_matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pair, side, token, best = [], [], [], []
        for i, ((ref_tokens, refs), (cand_tokens, cands)) in enumerate(zip(_units(batch.column("refs")), _units(batch.column("cands")))):
            if len(refs) == 0 or len(cands) == 0:
                continue
            rows, columns = np.empty(len(refs)), np.full(len(cands), -np.inf)
            step = max(1, _CELLS // len(cands))
            for at in range(0, len(refs), step):
                cos = refs[at : at + step] @ cands.T
                rows[at : at + step] = cos.max(axis=1)
                columns = np.maximum(columns, cos.max(axis=0))
            pair.append(np.full(len(refs) + len(cands), i))
            side.append(np.repeat([0, 1], [len(refs), len(cands)]))
            token += [ref_tokens, cand_tokens]
            best += [rows, columns]
        if pair:
            names = pa.array(["reference", "candidate"])
            yield pa.RecordBatch.from_arrays([
                batch.column("pair_id").take(pa.array(np.concatenate(pair))), names.take(pa.array(np.concatenate(side))), pa.concat_arrays(token), pa.array(np.concatenate(best)),
            ], names=["pair_id", "side", "token", "best"])


def tiles(vectors: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """Vectors dealt to the tiles of their pair: each once for every block of the other side.

    A side has a block for about ``block`` vectors, but no more than ``SIDE_BLOCKS`` as long as
    these hold at most ``MOST`` vectors: so large pairs spread over tasks, while the rows grow
    no faster than the vectors.
    """
    def blocks(side: str) -> Column:
        n = F.count_if(F.col("side") == side)
        return F.least(F.ceil(n / F.lit(block)), F.greatest(F.lit(SIDE_BLOCKS), F.ceil(n / F.lit(MOST)))).cast("int")

    sizes = vectors.groupBy("pair_id").agg(
        blocks("reference").alias("n_ref"), blocks("candidate").alias("n_cand")
    ).filter("n_ref > 0 AND n_cand > 0")
    own = lambda n: F.pmod(F.xxhash64("token"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    is_ref = F.col("side") == "reference"
    return (
        vectors.join(sizes, "pair_id")
        .withColumn("ref_block", F.explode(F.when(is_ref, F.array(own("n_ref"))).otherwise(every("n_ref"))))
        .withColumn("cand_block", F.explode(F.when(is_ref, every("n_cand")).otherwise(F.array(own("n_cand")))))
    )


def greedy_scores(vectors: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """Precision, recall and F1 per pair from rows (pair_id, side, token, vector).

    ``side`` is ``reference`` or ``candidate``. Both sides of a pair are cut into blocks and
    every block meets every block of the other side in a tile of its own, so a pair of any
    size spreads over tasks and no vector pair is ever a row. Pairs that lack a side are left out.
    """
    is_ref, item = F.col("side") == "reference", F.struct("token", "vector")
    packed = tiles(vectors, block=block).groupBy("pair_id", "ref_block", "cand_block").agg(
        F.collect_list(F.when(is_ref, item)).alias("refs"), F.collect_list(F.when(~is_ref, item)).alias("cands")
    )
    token_type = vectors.schema["token"].dataType.simpleString()
    best = packed.select("pair_id", "refs", "cands").mapInArrow(
        _best_matches, f"pair_id string, side string, token {token_type}, best double"
    )
    per_token = best.groupBy("pair_id", "side", "token").agg(F.max("best").alias("best"))
    mean = lambda side: F.avg(F.when(F.col("side") == side, F.col("best")))
    p, r = F.col("p"), F.col("r")
    return per_token.groupBy("pair_id").agg(mean("candidate").alias("p"), mean("reference").alias("r")).select(
        "pair_id", "p", "r", F.when(p + r != 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1")
    )
