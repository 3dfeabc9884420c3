"""References and candidates to stored scores and their means."""

from __future__ import annotations

from pyspark.sql import DataFrame

from notepairs.operators import scores
from notepairs.operators.concepts import concept_scores
from notepairs.operators.embedding import greedy_scores


def evaluate(
    model: str, pairs: DataFrame, candidates: DataFrame, path: str, *, concepts: DataFrame | None = None,
    vectors: DataFrame | None = None, max_tokens: int | None = None,
) -> DataFrame:
    """Write the evaluated pairs and the score tables of one model under ``path`` and return the mean of every metric.

    ``concepts`` adds concept precision and recall, ``vectors`` the greedy embedding score;
    ``max_tokens`` restricts the evaluation to short documents.
    """
    spark = pairs.sparkSession
    # Every metric reads the joined texts, so they are stored first.
    scores.eval_pairs(pairs, candidates, max_tokens=max_tokens).write.mode("overwrite").parquet(f"{path}/pairs")
    evals = spark.read.parquet(f"{path}/pairs")
    tables = {"rouge": scores.rouge(evals)}
    if concepts is not None:
        tables["concepts"] = concept_scores(evals, concepts)
    if vectors is not None:
        # An empty candidate has no embedding score; the other metrics keep it.
        with_text = evals.filter("candidate <> ''").select("pair_id")
        tables["embedding"] = greedy_scores(vectors.join(with_text, "pair_id", "left_semi"))
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    return scores.metric_means(model, *[spark.read.parquet(f"{path}/{name}") for name in tables])
