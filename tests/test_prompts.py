import pytest
from pyspark.sql import functions as F

from notepairs import constants as C
from notepairs.functions import prompts as P
from notepairs.operators.inference import batch_infer
from notepairs.operators.preference import preference_triples, rejected_summary


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_render(spark):
    assert one(spark, P.render("a {} b {}%", F.lit("{x} %s"), F.lit(3))) == "a {x} %s b 3%"
    assert one(spark, P.render("{}|", F.lit(None).cast("string"))) == "|"
    with pytest.raises(ValueError):
        P.render("{}", F.lit(1), F.lit(2))
    assert P.inference_template(C.SUMMARY_TEMPLATE) + "{}" == C.SUMMARY_TEMPLATE
    with pytest.raises(ValueError):
        P.inference_template("x")


def test_spans(spark):
    text = F.lit("ask: q THE ANSWER: a THE ANSWER: b")
    assert one(spark, P.prompt_part(text, "THE ANSWER:")) == "ask: q THE ANSWER:"
    assert one(spark, P.completion_part(text, "THE ANSWER:")) == " a THE ANSWER: b"
    assert one(spark, P.completion_part(text, "nothing")) == "" and one(spark, P.prompt_part(text, "nothing")).startswith("ask")


@pytest.mark.parametrize("text", ["", "a", "a\nb", "a\nb\n", "a\nb\nc", "a\nb\n\nd\n", "\n\n\n", "\n"])
def test_response_body(spark, text):
    assert one(spark, P.response_body(F.lit(text))) == "\n".join(text.split("\n")[2:])


def test_chat(spark):
    assert one(spark, P.render_chat(P.chat(F.lit("s"), F.lit("u")))) == "<|system|>\ns\n<|user|>\nu\n"
    assert one(spark, P.join_outputs(F.array(F.lit("a"), F.lit("b")))) == "a b"


REJECTED = {
    "": "",
    "body": "",
    "Hallucinated Summary:": "",
    "Hallucinated Summary:\nbody": "body",
    "before\nHallucinated Summary:\n\nbody\n\nmore\n": "body\n\nmore",
    "Hallucinated Summary:\nbody\nhallucination list\nmore": "body",
    "Hallucinated Summary:\nbody\nI hallucinate here\nmore": "body",
    "Hallucinated Summary:\nHallucinated Summary:\nbody": "",
    "HALLUCINATED SUMMARY\nbody": "body",
    "A Hallucinated Summary that is far too long to open\nbody": "",
    "A Hallucinated Summary that is far too long to open\nHallucinated Summary:\nbody": "body",
    "hallucination list\nbody\nHallucinated Summary:\nrest": "rest",
    "Hallucinated Summary: same line": "",
    "the hallucinated summary 567890\nbody": "",
    "the hallucinated summary 56789\nbody": "body",
    "Hallucinated Summary:\n  body  \n": "  body  ",
}


@pytest.mark.parametrize("text", list(REJECTED))
def test_rejected_summary(spark, text):
    assert one(spark, rejected_summary(F.lit(text))) == REJECTED[text]


def test_preference(spark):
    rej = spark.createDataFrame([("1", "bad"), ("2", "worse")], "pair_id string, rejected_summary string")
    pairs = spark.createDataFrame([("1", "doc", "good")], "pair_id string, document string, summary string")
    got = {r.pair_id: tuple(r)[1:] for r in preference_triples(rej, pairs, eos="!", template="d: {}").collect()}
    assert got == {"1": ("d: doc", "good!", "bad!"), "2": ("d: ", "!", "worse!")}
    assert preference_triples(rej, pairs, eos="!", template="d: {}", max_prompt_tokens=2).count() == 1


def test_batches(spark):
    def factory():
        return lambda texts: [f"{len(texts)}:{t}" for t in texts]

    df = spark.range(70).select(F.col("id").cast("string").alias("pair_id"), F.lit("t").alias("text")).coalesce(1)
    sizes = sorted(int(r.generated_text.split(":")[0]) for r in batch_infer(df, factory).collect())
    assert sizes == [6] * 6 + [32] * 64
    assert batch_infer(df, factory, tasks=5).count() == 70


def test_predictors_are_built_once_per_worker_and_stored(spark, tmp_path):
    from notepairs.operators.inference import stored_inference

    def factory():
        import os
        import uuid

        made = f"{os.getpid()}-{uuid.uuid4().hex}"
        return lambda texts: [made] * len(texts)

    df = spark.range(400).select(F.col("id").cast("string").alias("pair_id"), F.lit("t").alias("text"))
    got = stored_inference(df, factory, str(tmp_path / "out"), tasks=40)
    made = {r.generated_text for r in got.collect()}
    assert got.count() == 400 and len(made) == len({m.split("-")[0] for m in made})
