from pyspark.sql import functions as F

from notepairs.plans.corpus import build_corpus, quality_report
from notepairs.plans.evaluation import evaluate
from notepairs.session import tune
from notepairs.sources.tables import NOTES
from tests.test_pairs import ROWS


def test_corpus(spark, tmp_path):
    notes = spark.createDataFrame(ROWS, NOTES)
    admissions = spark.createDataFrame([(7, 70), (7, 71), (7, 72), (8, 80)], "subject_id long, hadm_id long")
    path = str(tmp_path)
    pairs = build_corpus(notes, admissions, path)
    assert {(r.pair_id, r.code, r.heading_idx) for r in pairs.collect()} == {("1_7_70", 1, 18), ("7_8_80", 1, 18)}
    codes = {(r.pair_id, r.code, r.summary_words) for r in spark.read.json(f"{path}/codes").collect()}
    assert codes == {("1_7_70", 1, 40), ("7_8_80", 1, 40), ("8_7_71", 8, None), ("9_7_72", -1, None)}
    report = {r.what: r.n for r in quality_report(spark.read.parquet(f"{path}/outcomes"), pairs, pairs.limit(1)).collect()}
    assert report == {"code 1": 2, "code 8": 1, "code -1": 1, "not refilled": 1}


def test_evaluation(spark, tmp_path):
    pairs = spark.createDataFrame([("a", "d", "heart failure"), ("b", "d d", "x")], "pair_id string, document string, summary string")
    cands = spark.createDataFrame([("a", "heart failure"), ("b", "")], "pair_id string, candidate string")
    concepts = spark.createDataFrame([("C1", "heart", ["T047"])], "cui string, name string, type_ids array<string>")
    vectors = spark.createDataFrame(
        [(p, s, 1, [1.0, 0.0]) for p in "ab" for s in ("reference", "candidate")], "pair_id string, side string, token int, vector array<double>"
    )
    means = {r.metric: r["mean"] for r in evaluate("m", pairs, cands, str(tmp_path), concepts=concepts, vectors=vectors).collect()}
    assert means["rouge1_f1"] == 0.5 and means["precision"] == means["recall"] == 1.0 and means["p"] == 1.0
    assert spark.read.parquet(f"{tmp_path}/embedding").count() == 1
    short = evaluate("m", pairs, cands, str(tmp_path / "short"), max_tokens=2)
    assert {r.metric: r["mean"] for r in short.collect()}["rouge1_f1"] == 1.0


def test_rewriting_from_summaries_to_texts(spark, tmp_path):
    from notepairs.operators import concepts as K
    from notepairs.plans.generation import rewrite_summaries

    pairs = spark.createDataFrame(
        [("p", "doc", "heart failure then aspirin"), ("q", "doc", "aspirin only")], "pair_id string, document string, summary string"
    )
    names = spark.createDataFrame([("C1", "heart failure"), ("C2", "aspirin")], "cui string, name string")
    types = spark.createDataFrame([("C1", "T047"), ("C2", "T121")], "cui string, type_id string")
    texts = pairs.selectExpr("pair_id", "summary AS text")
    mentions = K.mention_texts(K.match_exact(texts, K.concept_table(names, types)), texts)

    def factory():
        import re

        def answer(prompts):
            counts = [int(re.search(r"There are exactly (\d+) number", p)[1]) for p in prompts]
            return ["{" + ", ".join(f'{i}: "w{i}"' for i in range(1, n + 1)) + "}" for n in counts]

        return answer

    done = rewrite_summaries(pairs, mentions, factory, str(tmp_path / "job"))
    assert {r.pair_id: r.text for r in done.collect()} == {"p": "w1 then w2", "q": "w1 only"}
    assert spark.read.parquet(str(tmp_path / "job" / "responses")).count() == 2
    import pytest

    extra = mentions.union(mentions.limit(1).withColumn("pair_id", mentions["cui"]))
    with pytest.raises(ValueError, match="without a summary"):
        rewrite_summaries(pairs, extra, factory, str(tmp_path / "again"))


def test_batches_are_bounded_in_bytes(spark):
    """What a Python task holds at a time does not grow with the size of the rows."""
    import pyarrow as pa

    rows = tune(spark).range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("text"))
    sizes = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert len(sizes) > 3 and max(r.n for r in sizes) < 5 << 20
