import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from notepairs.functions.text import count_tokens
from notepairs.operators import inference as I
from notepairs.plans.generation import generate

SCHEMA = "pair_id string, text string"


def asking(log, fails=lambda text: False, dies=lambda text: False):
    """Predictor that writes down every prompt it answers; errors or the end of the run on some."""

    def factory():
        def run(texts):
            if any(dies(t) for t in texts):
                os._exit(1)
            if any(fails(t) for t in texts):
                raise ValueError("refused")
            with open(f"{log}/{os.getpid()}", "a") as out:
                out.write("".join(t + "\n" for t in texts))
            return [t.upper() for t in texts]

        return run

    return factory


def asked(log):
    return Counter(line for f in os.listdir(log) for line in open(f"{log}/{f}").read().splitlines())


@pytest.fixture
def log(tmp_path):
    (tmp_path / "log").mkdir()
    return str(tmp_path / "log")


def prompts(spark, n=200, mark=""):
    return spark.createDataFrame([(f"p{i}", f"prompt {i}{mark}") for i in range(n)], SCHEMA)


def test_failed_rows_are_recorded_and_asked_again(spark, tmp_path, log):
    path, table = str(tmp_path / "store"), prompts(spark)
    bad = lambda t: int(t.split()[1]) % 3 == 0
    first = I.resume_inference(table, asking(log, fails=bad), path, rows_per_wave=60)
    assert sorted(r.pair_id for r in first.collect()) == sorted(f"p{i}" for i in range(200) if i % 3)
    failed = I.stored_responses(spark, path).where("error IS NOT NULL").collect()
    assert {r.pair_id for r in failed} == {f"p{i}" for i in range(0, 200, 3)} and {r.error for r in failed} == {"ValueError: refused"}
    second = I.resume_inference(table, asking(log), path)
    assert {(r.pair_id, r.prompt, r.generated_text) for r in second.collect()} == {(f"p{i}", f"prompt {i}", f"PROMPT {i}") for i in range(200)}
    assert set(asked(log).values()) == {1} and len(asked(log)) == 200
    records = I.run_records(spark, path).collect()
    assert len(records) == 5 and sum(r.asked for r in records) == 267 and sum(r.failed for r in records) == 67
    third = I.resume_inference(table, asking(log, dies=lambda t: True), path)
    assert third.count() == 200


def test_a_run_that_dies_keeps_its_waves(spark, tmp_path, log):
    """The worker process is killed in the middle; finished waves are not asked for again."""
    path, table = str(tmp_path / "store"), prompts(spark)
    last = table.withColumn("d", F.pmod(F.xxhash64(F.sha2("text", 256)), F.lit(4))).where("d = 2").first().text
    with pytest.raises(Exception):
        I.resume_inference(table, asking(log, dies=lambda t: t == last), path, rows_per_wave=50)
    kept = {r.prompt for r in I.stored_responses(spark, path).collect()}
    assert 50 < len(kept) < 150 and len(I.run_records(spark, path).collect()) == 2
    whole = I.resume_inference(table, asking(log), path)
    assert {r.generated_text for r in whole.collect()} == {f"PROMPT {i}" for i in range(200)}
    assert all(asked(log)[p] == 1 for p in kept)


def test_changed_and_repeated_prompts(spark, tmp_path, log):
    path = str(tmp_path / "store")
    table = prompts(spark, 20).unionByName(prompts(spark, 20))
    assert I.resume_inference(table, asking(log), path).count() == 20
    other = prompts(spark, 10, " again").unionByName(prompts(spark, 20).where("length(pair_id) = 3"))
    got = {(r.pair_id, r.generated_text) for r in I.resume_inference(other, asking(log), path).collect()}
    assert got == {(f"p{i}", f"PROMPT {i} AGAIN") for i in range(10)} | {(f"p{i}", f"PROMPT {i}") for i in range(10, 20)}
    assert set(asked(log).values()) == {1} and len(asked(log)) == 30


def test_empty_and_null_prompts(spark, tmp_path, log):
    path = str(tmp_path / "store")
    assert I.resume_inference(spark.createDataFrame([], SCHEMA), asking(log), path).count() == 0
    odd = spark.createDataFrame([(None, "x"), ("a", ""), (None, "x")], SCHEMA)
    assert sorted(r.generated_text for r in I.resume_inference(odd, asking(log), path).collect()) == ["", "X"]
    assert sorted(r.generated_text for r in I.resume_inference(odd, asking(log, dies=lambda t: True), path).collect()) == ["", "X"]


def test_generate_resumes(spark, tmp_path, log):
    path = str(tmp_path / "store")
    generate(prompts(spark, 10), asking(log), path, resume=True)
    assert generate(prompts(spark, 15), asking(log), path, resume=True).count() == 15
    assert set(asked(log).values()) == {1}


def words_by_task(df):
    return [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.sum(count_tokens(F.col("text"))).alias("n")).collect()]


@pytest.mark.parametrize("hot", [1, 7])
def test_tasks_get_equal_costs(spark, hot):
    """A few long texts and many short ones; or two thirds of all rows of one length."""
    rows = spark.range(20_000).select(
        F.concat(F.lit("p"), "id").alias("pair_id"),
        F.repeat(F.lit("word "), F.when(F.col("id") % 100 == 0, 900 + F.col("id") % 1000).when(F.col("id") % 3 < 2, hot).otherwise(5 + F.col("id") % 60).cast("int")).alias("text"),
    )
    even = words_by_task(I.balanced(rows, 8, count_tokens(F.col("text"))))
    assert len(even) == 8 and max(even) <= 1.2 * sum(even) / 8
    back = I.balanced(rows, 8, count_tokens(F.col("text")))
    assert back.columns == rows.columns and back.exceptAll(rows).isEmpty() and back.count() == 20_000


def test_batches_hold_like_lengths(spark, tmp_path):
    rows = spark.range(4000).select(F.concat(F.lit("p"), "id").alias("pair_id"), F.repeat(F.lit("w "), (F.pmod(F.xxhash64("id"), F.lit(500)) + 1).cast("int")).alias("text"))

    def factory():
        return lambda texts: [f"{min(map(len, texts))} {max(map(len, texts))}" for _ in texts]

    def filling(**how):
        got = [tuple(map(int, r.generated_text.split())) for r in I.batch_infer(rows, factory, tasks=4, **how).collect()]
        return sum(b for _, b in got) / sum(a for a, _ in got)

    assert filling(cost=count_tokens(F.col("text"))) < 1.3 < filling()
    empty = I.batch_infer(rows.limit(0), factory, tasks=4, cost=count_tokens(F.col("text")))
    assert empty.count() == 0
