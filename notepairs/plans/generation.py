"""Summaries and cloze answers from any predictor: prompts, stored responses, refilled texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notepairs import constants as C
from notepairs.functions.answers import mask_count
from notepairs.functions.prompts import chat, render, render_chat
from notepairs.operators import cloze
from notepairs.operators.inference import Predictor, resume_inference, stored_inference


def chat_prompts(pairs: DataFrame, system: str, user: str, *values: Column) -> DataFrame:
    """``pair_id, text``: the system prompt and the filled user template as one chat text."""
    return pairs.select("pair_id", render_chat(chat(F.lit(system), render(user, *values))).alias("text"))


def zero_shot_prompts(pairs: DataFrame) -> DataFrame:
    """Prompts that ask for a summary of every document."""
    return chat_prompts(pairs, C.ZERO_SHOT_SYSTEM, C.ZERO_SHOT_USER, F.col("document"))


def hallucination_prompts(pairs: DataFrame) -> DataFrame:
    """Prompts that ask for an edited, wrong version of every summary."""
    return chat_prompts(pairs, C.HALLUCINATION_SYSTEM, C.HALLUCINATION_USER, F.col("document"), F.col("summary"))


def cloze_prompts(masks: DataFrame) -> DataFrame:
    """Prompts that ask for the words behind the masks, with the number of masks of each text.

    Only masks that agree in number with their answers are asked for.
    """
    masked = F.col("masked_summary")
    return chat_prompts(cloze.usable_masks(masks), C.CLOZE_SYSTEM, C.CLOZE_USER, mask_count(masked), F.col("document"), masked)


def generate(prompts: DataFrame, factory: Callable[[], Predictor], path: str, *, resume: bool = False, **options) -> DataFrame:
    """``pair_id, response``: predictions stored under ``path``; options as for ``batch_infer``.

    With ``resume``, answers that an earlier run stored for the same prompts are kept and
    only the others are asked for; without, the table is made anew.
    """
    made = (resume_inference if resume else stored_inference)(prompts, factory, path, **options)
    return made.select("pair_id", F.col("generated_text").alias("response"))


def rewrite_summaries(
    pairs: DataFrame, mentions: DataFrame, factory: Callable[[], Predictor], path: str, *, types: Sequence[str] = C.MASK_TYPES,
    form: str = "json", **options,
) -> DataFrame:
    """Mask, ask, parse and refill every summary; writes ``masks``, ``responses`` and ``texts`` under ``path``.

    Raises an error that names some ids where summaries and extractions do not cover each
    other, before the model runs. Returns the stored texts.
    """
    spark = pairs.sparkSession
    uncovered = cloze.coverage(pairs, mentions).filter("missing = 'summary'").limit(5).collect()
    if uncovered:
        raise ValueError(f"extractions without a summary, such as {[r['pair_id'] for r in uncovered]}")
    cloze.mask_all(pairs, mentions, types=types).write.mode("overwrite").parquet(f"{path}/masks")
    masks = spark.read.parquet(f"{path}/masks")
    responses = generate(cloze_prompts(masks), factory, f"{path}/responses", **options)
    cloze.refilled(masks, responses, form=form).write.mode("overwrite").parquet(f"{path}/texts")
    return spark.read.parquet(f"{path}/texts")
