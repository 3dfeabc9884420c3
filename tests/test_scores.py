import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from notepairs.functions.stemming import score_stem, stem, stem_table
from notepairs.operators import scores
from notepairs.operators.embedding import SIDE_BLOCKS, greedy_scores, tiles
from tests.restated import lcs

WORDS = ["the", "running", "runs", "patient", "patients", "stable", "stably", "a1", "Ünder", "well."]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    some = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 30)))
    return [(str(i), some(), some()) for i in range(120)] + [("same", "the patient runs", "the patient runs"), ("none", "", "")]


@pytest.fixture(scope="module")
def evals(spark, texts):
    return spark.createDataFrame(texts, "pair_id string, reference string, candidate string")


def tokens(text, stemmed):
    import re

    found = re.findall("[a-z0-9]+", text.lower())
    return [score_stem(t) for t in found] if stemmed else found


def expected(ref, cand, n):
    from collections import Counter

    grams = lambda ts: Counter(tuple(ts[i : i + n]) for i in range(len(ts) - n + 1))
    a, b = grams(ref), grams(cand)
    both = sum((a & b).values())
    p, r = both / max(sum(b.values()), 1), both / max(sum(a.values()), 1)
    return p, r, (2 * p * r / (p + r) if p + r else 0.0)


@pytest.mark.parametrize("stemmed", [False, True])
def test_rouge(evals, texts, stemmed):
    got = {r.pair_id: r for r in scores.rouge(evals, stemmed=stemmed).collect()}
    assert len(got) == len(texts)
    for key, ref, cand in texts:
        a, b, row = tokens(ref, stemmed), tokens(cand, stemmed), got[key]
        for n in (1, 2):
            assert (row[f"rouge{n}_precision"], row[f"rouge{n}_recall"], row[f"rouge{n}_f1"]) == pytest.approx(expected(a, b, n))
        k = lcs(a, b)
        assert row.rougeL_precision == pytest.approx(k / max(len(b), 1)) and row.rougeL_recall == pytest.approx(k / max(len(a), 1))
    assert got["same"].rouge2_f1 == got["same"].rougeL_f1 == 1.0 and got["none"].rougeL_f1 == 0.0


def test_sides_swap(evals):
    swapped = evals.select("pair_id", F.col("reference").alias("candidate"), F.col("candidate").alias("reference"))
    one = {r.pair_id: (r.rougeL_precision, r.rougeL_recall) for r in scores.rouge_l(evals).collect()}
    assert one == {r.pair_id: (r.rougeL_recall, r.rougeL_precision) for r in scores.rouge_l(swapped.repartition(3)).collect()}


def test_grams_of_a_pair_in_one_row_are_no_rows(spark, evals, texts):
    assert scores._counted_rows(evals, (1, 2), stemmed=False).count() == len(texts)


@pytest.mark.parametrize("n", [1, 2])
def test_pairs_in_several_rows(spark, n):
    """Counts of a pair's rows add up before they are clipped; null is an id like others."""
    from collections import Counter

    rows = [("a", "x y x", "x x z"), ("a", "x y x", "x x z"), ("b", "x y z w", "p q"), ("b", "p q", "x y z w"), (None, "x y", "x"), (None, "x", "x y"), ("c", "x y x y x", "y x y"), ("d", "", "x")]
    got = {r.pair_id: r for r in scores.rouge(spark.createDataFrame(rows, "pair_id string, reference string, candidate string"), stemmed=False).collect()}
    grams = lambda text: Counter(tuple(text.split()[i : i + n]) for i in range(len(text.split()) - n + 1))
    assert set(got) == {key for key, _, _ in rows}
    for key, row in got.items():
        a, b = (sum((grams(r[side]) for r in rows if r[0] == key), Counter()) for side in (1, 2))
        both = sum((a & b).values())
        assert row[f"rouge{n}_precision"] == pytest.approx(both / max(sum(b.values()), 1)) and row[f"rouge{n}_recall"] == pytest.approx(both / max(sum(a.values()), 1))


def test_null_texts(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", "x y", "x y"), ("c", "x", None)], "pair_id string, reference string, candidate string")
    assert {r.pair_id: r.rouge1_f1 for r in scores.rouge(df, stemmed=False).collect()} == {"b": 1.0}
    assert {r.pair_id: r.rouge2_f1 for r in scores.rouge_n(df, 2, stemmed=False).collect()} == {"a": 0.0, "b": 1.0, "c": 0.0}


def test_no_shuffle_after_the_join(spark, evals):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = evals.select("pair_id", F.lit("d").alias("document"), F.col("reference").alias("summary"))
        joined = scores.eval_pairs(pairs, evals.select("pair_id", "candidate"))
        plan = scores.rouge_n(joined, 1, stemmed=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("hashpartitioning") == 2, plan


# Published examples of the algorithm, and the extensions.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
    "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "skies": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "digitizer": "digit", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal", "sensitiviti": "sensit",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal", "electrical": "electr", "hopeful": "hope",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "adjustable": "adjust",
    "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "communism": "commun", "activate": "activ", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll", "dying": "die", "died": "die", "spied": "spi", "by": "by", "enjoy": "enjoy",
    "succeed": "succeed", "generalizations": "gener", "oscillators": "oscil", "geology": "geolog",
}


def test_stems(spark):
    assert {w: stem(w) for w in STEMS} == STEMS
    assert score_stem("was") == "was" and score_stem("dies") == "die"
    df = spark.createDataFrame([(w,) for w in [*STEMS, *STEMS]], "token string")
    assert {r.token: r.stem for r in stem_table(df).collect()} == {w: score_stem(w) for w in STEMS}


@pytest.mark.parametrize("block", [512, 3])
def test_greedy(spark, block):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for pair, (n, m) in {"a": (5, 9), "b": (1, 1), "c": (20, 2), "d": (3, 0)}.items():
        r, c = rng.normal(size=(n, 8)), rng.normal(size=(m, 8))
        rows += [(pair, "reference", i, v.tolist()) for i, v in enumerate(r)] + [(pair, "candidate", i, v.tolist()) for i, v in enumerate(c)]
        if m:
            cos = (r / np.linalg.norm(r, axis=1)[:, None]) @ (c / np.linalg.norm(c, axis=1)[:, None]).T
            want[pair] = (cos.max(axis=0).mean(), cos.max(axis=1).mean())
    df = spark.createDataFrame(rows, "pair_id string, side string, token int, vector array<double>")
    got = {x.pair_id: (x.p, x.r) for x in greedy_scores(df, block=block).collect()}
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_tiles_grow_with_the_vectors(spark):
    """A vector stands in a fixed number of tiles, however many its pair has."""
    for n in (400, 1600):
        rows = spark.range(n).select(
            F.lit("a").alias("pair_id"), F.when(F.col("id") % 2 == 0, "reference").otherwise("candidate").alias("side"), F.col("id").alias("token"),
            F.array(F.sin("id"), F.cos("id")).alias("vector"),
        )
        dealt = tiles(rows, block=2)
        assert dealt.count() == SIDE_BLOCKS * n and dealt.groupBy("ref_block", "cand_block").count().count() == SIDE_BLOCKS**2
        angles = np.arange(n)
        cos = np.cos(angles[::2, None] - angles[None, 1::2])
        got = greedy_scores(rows, block=2).first()
        assert (got.p, got.r) == (pytest.approx(cos.max(axis=0).mean()), pytest.approx(cos.max(axis=1).mean()))


def test_rescale_and_means(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 0.5, 0.25)], "pair_id string, p double, r double")
    got = df.select(scores.rescaled(F.col("p"), 0.5).alias("x")).collect()
    assert [r.x for r in got] == [1.0, 0.0]
    assert {(r.model, r.metric, r["mean"]) for r in scores.metric_means("m", df).collect()} == {("m", "p", 0.75), ("m", "r", 0.25)}


def test_eval_pairs(spark):
    pairs = spark.createDataFrame([("a", "x y", "s"), ("b", "", "s"), ("c", None, "s"), ("d", "x y z", "s")], "pair_id string, document string, summary string")
    cands = spark.createDataFrame([("a", ""), ("b", "t"), ("c", "t"), ("d", "t")], "pair_id string, candidate string")
    assert {r.pair_id for r in scores.eval_pairs(pairs, cands).collect()} == {"a", "d"}
    assert {r.pair_id for r in scores.eval_pairs(pairs, cands, max_tokens=3).collect()} == {"a"}


def plain_lcs(xs, ys):
    row = [0] * (len(ys) + 1)
    for x in xs:
        last = 0
        for j, y in enumerate(ys, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@pytest.mark.parametrize("tile", [1, 2, 3, 64, 1 << 13])
def test_tiles_hand_their_carries_on(tile):
    rng = random.Random(tile)
    for _ in range(200):
        xs, ys = (rng.choices("abcd" if rng.random() < 0.7 else "abcdefghijklmnop", k=rng.randrange(40)) for _ in range(2))
        assert scores.longest_common(xs, ys, tile=tile) == plain_lcs(xs, ys)


def test_texts_of_document_length():
    """A hundred thousand tokens a side: known by how they were made."""
    rng = random.Random(3)
    common = [f"c{i}" for i in range(60_000)]

    def mixed(mark):
        out = list(common)
        for i in range(40_000):
            out.insert(rng.randrange(len(out)), f"{mark}{i}")
        return out

    assert scores.longest_common(mixed("x"), mixed("y")) == 60_000
    words = [rng.choice("abcdefgh") for _ in range(100_000)]
    assert scores.longest_common(words, words) == 100_000
    assert scores.longest_common(words, words[50_000:] + ["z"] * 50_000) == 50_000
    few = rng.choices("abcd", k=3000), rng.choices("abcd", k=3000)
    assert scores.longest_common(*few, tile=500) == plain_lcs(*few)
