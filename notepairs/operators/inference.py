"""Batched prediction over a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notepairs import constants as C
from notepairs.session import stage

Predictor = Callable[[list[str]], list[str]]
_PREDICTORS: dict[str, Predictor] = {}


def _predictor(token: str, factory: Callable[[], Predictor]) -> Predictor:
    """The predictor of a job, built once in each worker process; that of an earlier job is let go."""
    if token not in _PREDICTORS:
        _PREDICTORS.clear()
        _PREDICTORS[token] = factory()
    return _PREDICTORS[token]


#: Steps of an octave of cost that ``balanced`` tells apart; rows of one step count as equally costly.
COST_STEPS = 64


def _step(cost: Column) -> Column:
    """Steps of like cost: 64 to a doubling, so a few thousand whatever the costs are."""
    return F.floor(F.log2(F.greatest(cost, F.lit(1)).cast("double")) * COST_STEPS).cast("int")


def balanced(rows: DataFrame, tasks: int, cost: Column, *, key: str = "pair_id") -> DataFrame:
    """``rows`` in ``tasks`` partitions of nearly equal total ``cost``, each from the dearest row to the cheapest.

    Rows go by cost, so neighbours are alike and a batch wastes little on filling up. The
    cuts come from a histogram of a few thousand steps of cost, whatever the number of rows;
    inside a step, which may hold most of all rows, a digest of the key spreads them evenly.
    """
    known = rows.withColumn("_cost", F.greatest(cost.cast("double"), F.lit(0.0)) + 1).withColumn("_step", _step(F.col("_cost")))
    histogram = known.groupBy("_step").agg(F.sum("_cost").alias("total")).orderBy(F.desc("_step")).collect()
    if not histogram:
        return rows
    low, high, before = histogram[-1]["_step"], histogram[0]["_step"], 0.0
    starts, totals = [0.0] * (high - low + 1), [0.0] * (high - low + 1)
    for h in histogram:
        starts[h["_step"] - low], totals[h["_step"] - low] = before, h["total"]
        before += h["total"]
    of_step = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("_step") - low)
    share = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 20)) / float(1 << 20)
    at = of_step(starts) + share * of_step(totals)
    task = F.least(F.floor(at / before * tasks).cast("int"), F.lit(tasks - 1))
    dealt = known.withColumn("_task", task).repartitionById(tasks, F.col("_task")).sortWithinPartitions(F.desc("_cost"))
    return dealt.drop("_cost", "_step", "_task")


def batch_infer(
    prompts: DataFrame, factory: Callable[[], Predictor], *, key: str = "pair_id", text: str = "text",
    batch_size: int = C.INFERENCE_BATCH, tasks: int | None = None, cost: Column | None = None, profile: ResourceProfile | None = None,
    keep_failed: bool = False,
) -> DataFrame:
    """Run a predictor over ``text``; it is built once per worker and fed fixed-size batches.

    ``tasks`` spreads the rows over that many tasks first, evenly by number, or by ``cost``
    (such as the number of tokens) where one is given; ``profile`` bounds the tasks
    that run at once by what they need, e.g. one accelerator each.

    An error of the predictor ends the job, or with ``keep_failed`` only costs the rows it
    is about: the rows of a failing batch are tried one by one, and those that fail again
    have a null text and the error in a further column ``error``.
    """
    token = uuid.uuid4().hex
    rows = prompts.select(key, text)
    if tasks:
        rows = rows.repartition(tasks) if cost is None else balanced(prompts, tasks, cost, key=key).select(key, text)

    def one_by_one(predict: Predictor, texts: list[str]) -> tuple[list[str | None], list[str | None]]:
        try:
            return list(predict(texts)), [None] * len(texts)
        except Exception as error:  # noqa: BLE001
            if len(texts) == 1:
                return [None], [f"{type(error).__name__}: {error}"[:1000]]
        parts = [one_by_one(predict, [t]) for t in texts]
        return [p[0][0] for p in parts], [p[1][0] for p in parts]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            predict = _predictor(token, factory)
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at : at + batch_size]
                texts = part[text].tolist()
                answers, errors = one_by_one(predict, texts) if keep_failed else (predict(texts), None)
                out = {key: part[key].tolist(), "prompt": texts, "generated_text": answers}
                yield pd.DataFrame(out | {"error": errors} if keep_failed else out)

    key_type = prompts.schema[key].dataType.simpleString()
    columns = f"{key} {key_type}, prompt string, generated_text string" + (", error string" if keep_failed else "")
    return rows.mapInPandas(run, columns, profile=profile)


def stored_inference(prompts: DataFrame, factory: Callable[[], Predictor], path: str, **options) -> DataFrame:
    """Predictions written once to ``path``; all readers share the stored table, so the model runs once."""
    made = batch_infer(prompts, factory, **options)
    schema = made.schema
    made.write.mode("overwrite").parquet(path)
    return prompts.sparkSession.read.schema(schema).parquet(path)


def _read_if_there(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    try:
        return getattr(spark.read, kind)(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return None


def run_records(spark: SparkSession, path: str) -> DataFrame:
    """``run, wave, asked, answered, failed``: what every wave of every run left in the store."""
    found = _read_if_there(spark, f"{path}/manifest", "json")
    if found is None:
        return spark.createDataFrame([], "run string, wave long, asked long, answered long, failed long")
    return found.select("run", "wave", "asked", "answered", "failed")


def stored_responses(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the store, failed ones included: key, digest of the prompt, prompt, text, error, run."""
    return _read_if_there(spark, f"{path}/responses", "parquet")


def resume_inference(
    prompts: DataFrame, factory: Callable[[], Predictor], path: str, *, key: str = "pair_id", text: str = "text", rows_per_wave: int = 1 << 20,
    keep_failed: bool = True, **options,
) -> DataFrame:
    """Predictions for all ``prompts``, asking only for those that the store under ``path`` does not have.

    The store keeps responses by key and digest of the prompt, so a changed prompt is asked
    again and an unchanged one never is. What is left is asked in waves of about
    ``rows_per_wave`` rows; each is appended by a write that commits as a whole, then told in
    the manifest. A run that dies, whatever the reason, loses at most one wave, and the next
    call goes on from there. Rows whose predictor failed are stored with their error, so they
    can be looked at, and are asked again by the next call.

    Equal rows of (key, prompt) are one row. Two runs at once may ask for the same rows; of
    several answers the one that is smallest in order of run and text counts. Returns
    ``key, prompt, generated_text`` of every prompt that has an answer.
    """
    spark = prompts.sparkSession
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    asked = prompts.select(key, F.col(text).alias("text"), digest.alias("digest")).dropDuplicates([key, "digest"])
    stored = stored_responses(spark, path)
    done = None if stored is None else stored.where("error IS NULL").select(key, "digest").distinct()
    same = lambda a, b: a[key].eqNullSafe(b[key]) & (a["digest"] == b["digest"])
    left = stage(asked if done is None else asked.join(done, same(asked, done), "left_anti"))
    waves, run = -(-left.count() // rows_per_wave), uuid.uuid4().hex
    for wave in range(waves):
        # The digest picks the wave: the same rows whenever the stored table is read again.
        mine = left.where(F.pmod(F.xxhash64("digest"), F.lit(waves)) == wave)
        made = batch_infer(mine, factory, key=key, text="text", keep_failed=keep_failed, **options)
        made = made if keep_failed else made.withColumn("error", F.lit(None).cast("string"))
        rows = made.withColumn("digest", F.sha2(F.coalesce("prompt", F.lit("")), 256)).withColumn("run", F.lit(run)).withColumn("wave", F.lit(wave).cast("long"))
        rows.write.mode("append").parquet(f"{path}/responses")
        mine_now = stored_responses(spark, path).where((F.col("run") == run) & (F.col("wave") == wave))
        counted = mine_now.agg(F.count("*").alias("asked"), F.count(F.when(F.col("error").isNull(), 1)).alias("answered"), F.count("error").alias("failed"))
        counted.select(F.lit(run).alias("run"), F.lit(wave).alias("wave"), "asked", "answered", "failed").coalesce(1).write.mode("append").json(f"{path}/manifest")
    now = stored_responses(spark, path)
    if now is None:
        return asked.select(key, F.col("text").alias("prompt"), F.lit("").alias("generated_text")).limit(0)
    answers = now.where("error IS NULL").groupBy(key, "digest").agg(F.min(F.struct("run", "generated_text")).alias("first"))
    want = asked.alias("w")
    met = want.join(answers.alias("s"), F.expr(f"w.`{key}` <=> s.`{key}` AND w.digest = s.digest"))
    return met.select(F.col(f"w.`{key}`").alias(key), F.col("w.text").alias("prompt"), "first.generated_text")
