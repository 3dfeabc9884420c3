import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from notepairs.functions import answers as A
from notepairs.operators import cloze
from notepairs.operators import concepts as K
from notepairs.operators.tokens import gram_sets, text_hashes

NAMES = [("C1", "heart failure"), ("C2", "failure"), ("C3", "acute heart failure"), ("C4", "Fièvre"), ("C5", "aspirin"), ("C6", "heart")]


@pytest.fixture(scope="module")
def concepts(spark):
    names = spark.createDataFrame(NAMES, "cui string, name string")
    types = spark.createDataFrame([(c, "T047") for c, _ in NAMES] + [("C5", "T074"), ("C6", "T999")], "cui string, type_id string")
    return K.concept_table(names, types)


def texts_of(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "pair_id string, text string")


def test_exact(spark, concepts):
    df = texts_of(spark, "Acute heart-failure; fièvre, ASPIRIN x", "", "none here")
    got = {(r.pair_id, r.start_at, r.end_at, r.cui, r.source_value) for r in K.mention_texts(K.match_exact(df, concepts), df).collect()}
    assert got == {
        ("0", 0, 19, "C3", "Acute heart-failure"), ("0", 6, 19, "C1", "heart-failure"), ("0", 6, 11, "C6", "heart"),
        ("0", 12, 19, "C2", "failure"), ("0", 21, 27, "C4", "fièvre"), ("0", 29, 36, "C5", "ASPIRIN"),
    }
    typed = K.match_exact(df, concepts, types=("T074", "T999"))
    assert {r.cui for r in typed.collect()} == {"C5", "C6"}


def test_sieve_keeps_all_names_and_few_others(spark, concepts):
    df = texts_of(spark, "Acute heart-failure; fièvre, ASPIRIN x", "", "none here", "heart " * 50)
    assert K.match_exact(df, concepts).count() == 56
    norms = concepts.select(K.normal_name(F.col("name")).alias("norm"))
    names = [r.norm for r in norms.collect()]
    for bits in (1 << 14, 1 << 20):
        test = K.name_sieve(norms, bits=bits)
        assert test(text_hashes(names)).all()
        assert test(text_hashes([f"w{i}" for i in range(2000)])).sum() < 50


ANCHOR_NAMES = [("C1", "the heart"), ("C2", "the"), ("C3", "the acute the heart"), ("C4", "of the acute"), ("C5", "heart of the"), ("C6", "a a a"), ("C7", "!?"), ("C8", "one two three four five six")]


@pytest.mark.parametrize("seed", range(3))
def test_anchored_matches_are_the_exact_ones(spark, seed):
    """Anchors at every place of a name, repeated words, and names at the edges of a text."""
    rng = random.Random(seed)
    words = ["the", "acute", "heart", "of", "a", "Two", "ONE"]
    texts = texts_of(spark, *(rng.choice((" ", ", ", "; ")).join(rng.choices(words, k=rng.randrange(9))) for _ in range(80)), None, "", "of the acute", "heart of the")
    table = spark.createDataFrame(ANCHOR_NAMES, "cui string, name string").withColumn("type_ids", F.array(F.lit("T047")))
    rows = lambda df: sorted(map(str, df.collect()))
    exact = rows(K.match_exact(texts, table))
    assert exact and rows(K.match_anchored(texts, table)) == exact


def test_anchors_are_the_rarest_words(spark):
    table = spark.createDataFrame([("the heart",), ("the",), ("the acute the heart",), ("acute",), ("b a",)], "norm string")
    got = {r.norm: (r.anchor, r.at) for r in K.anchors(table).collect()}
    assert got == {"the heart": ("heart", 1), "the": ("the", 0), "the acute the heart": ("acute", 1), "acute": ("acute", 0), "b a": ("a", 1)}


def test_only_anchors_enter_the_join(spark):
    table = spark.createDataFrame([("C1", "the heart"), ("C2", "the lung")], "cui string, name string").withColumn("type_ids", F.array(F.lit("T047")))
    texts = texts_of(spark, "the " * 500 + "heart", "the lung of the heart")
    index = K.anchors(table.withColumn("norm", K.normal_name(F.col("name")))).select(F.col("anchor").alias("norm"))
    places = K.anchored_words(texts, index).collect()
    assert sorted(r.anchor for r in places) == ["heart", "heart", "lung"]
    assert {tuple(r.before) for r in places} == {("the",) * 4, ("the",), ("the", "of", "lung", "the")}


def grams(s):
    return {s[i : i + 3] for i in range(max(len(s) - 2, 1))}


@pytest.mark.parametrize("threshold", [1.0, 0.9, 0.85, 0.8, 0.7, 0.5, 0.3])
@pytest.mark.parametrize("longest", [9, 60])
def test_similar_is_exact(spark, threshold, longest):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, longest)))
    left, right = {word() for _ in range(250)}, {word() for _ in range(200)}
    for x in sorted(right)[::2]:
        # Some differ in one or two letters, or in a piece that is longer.
        at = rng.randrange(len(x))
        left |= {x[:at] + rng.choice(("", "x", "ab", "xyz")) + x[at + rng.randrange(2) :] or "x"}
    df = lambda xs: spark.createDataFrame([(x,) for x in xs], "norm string")
    got = {(r.left_norm, r.right_norm): r.similarity for r in K.similar_names(df(left), df(right), threshold).collect()}
    want = {}
    for x in left:
        for y in right:
            j = len(grams(x) & grams(y)) / len(grams(x) | grams(y))
            if j >= threshold - 1e-12:
                want[(x, y)] = j
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("longest", [1, 3, None])
def test_sums_of_overlapping_sets(longest):
    """Running sums give the sizes, part sums and unknown grams of every window's set, repeats and short words included."""
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("ab\U0001F600é") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 40))) for _ in range(30)] + ["", "a", "ab ab ab ab", "aaaaaaaaaaaaaaa"]
    scheme, seen = K._Parts(0.8), 0
    for shown in K._shown(texts, longest):
        sums = K._PartSums(shown.chars, shown.first, shown.last)
        known = np.zeros(K.KNOWN_GRAM_BITS // 64, np.int64)
        some = K._bits(sums.mixed[::3], K.KNOWN_GRAM_BITS)
        np.bitwise_or.at(known, some >> 6, np.int64(1) << (some & 63))
        for which, n, table in gram_sets(shown.chars, shown.first, shown.last):
            mixed = np.where(table == K._NONE, np.uint64(0), K._mixed(table))
            assert (sums.n[which] == n).all()
            new = ~K._set(known, K._bits(mixed, K.KNOWN_GRAM_BITS)) & (table != K._NONE)
            assert (sums.lacking(known)[which] == new.sum(axis=1)).all()
            for p in (1, 2, 5):
                want = [(mixed * (scheme.part(mixed, p) == i)).sum(axis=1, dtype=np.uint64) for i in range(p)]
                assert (sums.of(scheme, p, which) == np.array(want)).all()
            seen += len(which)
    assert seen >= len(texts)


def test_all_windows_of_a_stretch(monkeypatch):
    """Windows of all lengths, cut into stretches of words, are those of each length."""
    texts = ["a b c d e f g", None, "h", "i j k l m n o p q", ""]
    said = [t.split() if t else [] for t in texts]
    want = sorted(" ".join(w[i : i + n]) for w in said for n in range(1, 5) for i in range(len(w) - n + 1))
    for most in (1, 9, 1 << 14):
        monkeypatch.setattr(K, "WINDOWS", most)
        assert sorted(x for shown in K._shown(texts, 4) for x in shown.written(np.arange(len(shown.first)))) == want


def test_keys_stand_once_for_equal_windows(spark, concepts):
    """Windows that are equal nearby carry their keys once, and those with too many foreign grams none."""
    names = concepts.select(K.normal_name(F.col("name")).alias("norm"))
    texts = texts_of(spark, "heart failure aspirin " * 200).select("pair_id", F.col("text").alias("_text")).coalesce(1)
    found, _ = K._candidates(texts, "pair_id", names, 0.9, 5)
    rows = found.collect()
    assert len(rows) >= 800 and sum(r.ks is not None for r in rows) == len({r.norm for r in rows}) < 10


@pytest.mark.parametrize("threshold", [0.9, 0.5])
def test_near_matches_in_small_pieces(spark, concepts, monkeypatch, threshold):
    """Texts cut into pieces, windows into runs, pairs into groups and names into blocks give the same rows."""
    texts = texts_of(spark, "aspirins given for heart failures", None, "", "acute heart-failure \U0001F600 fièvres " * 40, "failure")
    rows = lambda: sorted(map(str, K.match_similar(texts, concepts, threshold=threshold).collect()))
    want = rows()
    monkeypatch.setattr(K, "NAME_BLOCK", 2)
    monkeypatch.setattr(K, "MET_BYTES", 40)
    assert want and rows() == want


@pytest.mark.parametrize("windows,pairs", [(16, 32), (1 << 14, 1 << 20)])
def test_a_block_of_names_finds_all(monkeypatch, windows, pairs):
    """Windows and pairs are gone through in runs; each window meets each name that reaches the threshold once."""
    monkeypatch.setattr(K, "WINDOWS", windows)
    monkeypatch.setattr(K, "PAIRS", pairs)
    rng = random.Random(pairs)
    word = lambda: "".join(rng.choice("abc\U0001F600") for _ in range(rng.randint(1, 9)))
    names, text = sorted({word() for _ in range(150)}), " ".join(word() for _ in range(150)).replace("\U0001F600", "")
    index, got = K._NameIndex(names, 0.5, K.GramOrder([])), []
    for shown in K._shown([text, None], 2):
        for which, name, similarity in index.near(shown):
            got += zip(shown.written(which), (names[j] for j in name.tolist()), similarity.tolist())
    said = text.split()
    want = [(w, x) for w in said + [f"{a} {b}" for a, b in zip(said, said[1:])] for x in names if 2 * len(grams(w) & grams(x)) >= len(grams(w) | grams(x))]
    assert want and sorted((w, x) for w, x, _ in got) == sorted(want)
    assert all(s == pytest.approx(len(grams(w) & grams(x)) / len(grams(w) | grams(x))) for w, x, s in got)


def test_pairs_that_fail_are_never_rows(spark):
    """At a low threshold windows share first grams with many names; no join of theirs is left in the plan."""
    names = spark.createDataFrame([(f"C{i}", f"abc{chr(97 + i % 26)}{i}") for i in range(200)], "cui string, name string").withColumn("type_ids", F.array(F.lit("T047")))
    plan = K.match_similar(texts_of(spark, "abcd1 abce2 " * 50), names, threshold=0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(ks" not in plan and "similarity" in plan


@pytest.mark.parametrize("threshold", [0.5, 0.3])
def test_few_pairs_are_compared(monkeypatch, threshold):
    """Signatures are compared only where both sets' first grams, as many as their two sizes allow, have one in common."""
    rng = random.Random(5)
    syllables = ["tion", "en", "the", "er", "an", "wh", "ed", "ing", "es", "ou"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    names, said = sorted({" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(300)}), [word() for _ in range(120)]
    index = K._NameIndex(names, threshold, K.GramOrder([]))
    compared, count = [], np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: compared.append(len(x)) or count(x))
    shown = list(K._shown([" ".join(said)], 3))
    hits = sum(len(which) for one in shown for which, _, _ in index.near(one))
    held = {x: sorted(grams(x)) for x in names}
    want = pairs = 0
    for one in shown:
        for w in one.written(np.arange(len(one.first))):
            a = sorted(grams(w))
            for b in held.values():
                common = -int(-(threshold * (len(a) + len(b)) / (1 + threshold) - 1e-9) // 1)
                want += len(set(a[: max(len(a) - common + 1, 0)]) & set(b[: max(len(b) - common + 1, 0)]))
                pairs += len(set(a) & set(b)) * (1 + threshold) >= threshold * (len(a) + len(b)) - 1e-9
    assert hits == pairs > 0
    # The second words of signatures are compared where the first ones are near.
    assert want <= sum(compared) < 2 * want


def test_large_sets_of_any_size():
    """Sizes beyond those that are a class each, up to hundreds of grams."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz\U0001F600"
    word = lambda n: "".join(rng.choices(letters, k=n))
    names = sorted({word(n) for n in range(1, 400, 3)})
    texts = names + [x[: int(len(x) * rng.uniform(0.3, 1))] + word(rng.randint(0, len(x))) for x in names]
    for threshold in (0.3, 0.5, 0.75):
        index = K._NameIndex(names, threshold, K.GramOrder([x[:3] for x in names[:20]]))
        got = {(int(w), int(j)): s for shown in K._shown(texts, None) for which, name, similarity in index.near(shown) for w, j, s in zip(which, name, similarity)}
        sets, want = [grams(x) for x in names], {}
        for i, a in enumerate(map(grams, texts)):
            want |= {(i, j): s for j, b in enumerate(sets) if (s := len(a & b) / len(a | b)) >= threshold - 1e-12}
        assert len(want) > len(names) and got == want


@pytest.mark.parametrize("block", [2, 1 << 15])
def test_every_entry_of_a_near_name(spark, monkeypatch, block):
    """A name that stands for several concepts, in several spellings, repeated or null: one row for each of its entries."""
    monkeypatch.setattr(K, "NAME_BLOCK", block)
    rows = [("C1", "Heart failure", ["T1"]), ("C2", "heart-failure", ["T2", "T3"]), ("C2", "heart-failure", ["T2", "T3"]), (None, "heart", None), ("C4", None, ["T1"]), ("C5", "!?", ["T1"]), ("C6", "aspirin", [])]
    table = spark.createDataFrame(rows, "cui string, name string, type_ids array<string>")
    texts = texts_of(spark, "heart failures", None, "Aspirin")
    got = sorted(str((r.pair_id, r.start_at, r.end_at, r.cui, r.detected_name, r.type_ids)) for r in K.match_similar(texts, table, threshold=0.6).collect())
    want = [("0", 0, 5, None, "heart", None), ("0", 0, 14, "C1", "Heart failure", ["T1"]), *[("0", 0, 14, "C2", "heart-failure", ["T2", "T3"])] * 2, ("2", 0, 7, "C6", "aspirin", [])]
    assert got == sorted(map(str, want))


def test_matches_are_not_joined_again(spark, concepts):
    """At a low threshold texts meet names once; their matches bring the entries along instead of being moved to them."""
    plan = K.match_similar(texts_of(spark, "heart failures"), concepts, threshold=0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Join Cross" in plan


def test_match_similar(spark, concepts):
    df = texts_of(spark, "aspirins given for heart failures")
    got = {(r.cui, r.start_at) for r in K.match_similar(df, concepts, threshold=0.8).collect()}
    assert ("C5", 0) in got and ("C1", 19) in got and ("C6", 19) in got


def test_concept_scores(spark, concepts):
    evals = spark.createDataFrame(
        [("a", "heart failure", "failure and aspirin"), ("b", "nothing", "nothing"), ("c", "aspirin", "nothing")],
        "pair_id string, reference string, candidate string",
    )
    got = {r.pair_id: (r.precision, r.recall) for r in K.concept_scores(evals, concepts).collect()}
    # heart failure holds C1, C2 and C6; the other side C2 and C5
    assert got["a"] == pytest.approx((0.5, 1 / 3)) and got["b"] == (1.0, 1.0) and got["c"] == (1.0, 0.0)


def test_near_matches_count_in_scores(spark, concepts):
    evals = spark.createDataFrame([("a", "heart failure", "heart failures")], "pair_id string, reference string, candidate string")
    near, exact = (K.concept_scores(evals, concepts, matcher=m).first() for m in (K.match_similar, K.match_exact))
    assert near.recall == pytest.approx(2 / 3) and exact.recall == pytest.approx(1 / 3)


def test_code_map(spark):
    df = spark.createDataFrame([("C1", "I1", 1), ("C1", "I9", 3), ("C1", "I5", 2)], "cui string, code string, line_no int")
    assert [(r.cui, r.code) for r in K.code_map(df).collect()] == [("C1", "I9")]


PAIRS = [("p", "doc", "acute heart failure with {fever} and heart failure"), ("q", "doc", "no mention"), ("r", "doc", "é aspirin")]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, "pair_id string, document string, summary string")


@pytest.fixture(scope="module")
def mentions(pairs, concepts):
    texts = pairs.select("pair_id", F.col("summary").alias("text"))
    return K.mention_texts(K.match_exact(texts, concepts), texts)


def test_mask_all_and_back(pairs, mentions):
    masks = cloze.mask_all(pairs, mentions)
    got = {r.pair_id: (r.masked_summary, r.answers) for r in masks.collect()}
    assert got == {"p": ("MASK with {fever} and MASK", "acute heart failure WORD_SEP heart failure"), "r": ("é MASK", "aspirin")}
    back = masks.select("pair_id", A.fill_masks(F.col("masked_summary"), A.answers_of(F.col("answers"))).alias("t"))
    assert {r.pair_id: r.t for r in back.collect()} == {p: s for p, _, s in PAIRS if p != "q"}


@pytest.mark.parametrize("seed", range(4))
def test_longest_spans_stay(seed):
    rng = random.Random(seed)
    for _ in range(300):
        spans = sorted({(a, a + rng.randint(1, 6)) for a in (rng.randrange(20) for _ in range(rng.randrange(12)))})
        left, want = sorted(spans, key=lambda s: (s[0] - s[1], s[0])), []
        while left:
            want.append(left[0])
            left = [s for s in left if s[1] <= want[-1][0] or s[0] >= want[-1][1]]
        assert [spans[i] for i in cloze.longest_spans(spans, 30)] == sorted(want)


def test_many_mentions_of_one_text(spark):
    """A text with tens of thousands of mentions is masked in one pass."""
    n = 30_000
    text = "ab " * n
    pairs = spark.createDataFrame([("p", "d", text)], "pair_id string, document string, summary string")
    rows = spark.range(n).select(
        F.lit("p").alias("pair_id"), (F.col("id") * 3).cast("int").alias("start_at"), (F.col("id") * 3 + 2).cast("int").alias("end_at"), F.lit("C").alias("cui"),
        F.lit("ab").alias("detected_name"), F.array(F.lit("T047")).alias("type_ids"), F.lit("ab").alias("source_value"),
    )
    row = cloze.mask_all(pairs, rows).first()
    assert row.masked_summary == "MASK " * n and row.answers.count("WORD_SEP") == n - 1


def test_raw_overlaps_are_caught(pairs, mentions):
    raw = cloze.mask_all(pairs, mentions, overlaps="raw")
    checks = {r.pair_id: (r.n_masks, r.n_answers) for r in cloze.mask_checks(raw).collect()}
    assert checks["r"] == (1, 1) and checks["p"][0] != checks["p"][1]
    assert [r.pair_id for r in cloze.usable_masks(raw).collect()] == ["r"]


def test_raw_masks_a_span_once_for_each_concept(pairs, mentions):
    twice = mentions.filter("pair_id = 'r'").unionByName(mentions.filter("pair_id = 'r'").withColumn("cui", F.lit("other")))
    row = cloze.mask_all(pairs, twice, overlaps="raw").first()
    assert row.answers == "aspirin WORD_SEP aspirin"
    assert cloze.mask_all(pairs, twice).first().answers == "aspirin"


def test_mask_one_and_integrity(pairs, mentions):
    ones = {r.mention_id: (r.masked_summary, r.answer) for r in cloze.mask_one(pairs, mentions).collect()}
    assert ones["r_2_9"] == ("é MASK", "aspirin") and ones["p_6_19"][0].startswith("acute MASK with")
    broken = mentions.withColumn("source_value", F.when(F.col("start_at") == 2, "x").otherwise(F.col("source_value")))
    assert [(r.pair_id, r.found) for r in cloze.broken_mentions(pairs, broken).collect()] == [("r", "aspirin")]
    assert "r" not in {r.pair_id for r in cloze.mask_all(pairs, broken).collect()}


# What each response says about the originals o1 and o2; None where it cannot be used.
JSON_ANSWERS = {
    '{1: "a", 2: "b"}': ["a", "b"],
    'Sure {1: "a", 2: "NOT_FOUND"} {3: "x"}': ["a", "o2"],
    '{1: "a"}': None,
    '{1: "a", 3: "b"}': None,
    "none": None,
    "} {": None,
    '{"1": "a", "2": "b"}': ["a", "b"],
    '{1: "at 10:30", 2: "b"}': None,
    '{01: "a", 2: "b"}': ["a", "b"],
    '{1: "a", 2: "b", 2: "c"}': ["a", "c"],
    "{1: 'a', 2: 'b'}": None,
    '{1: "a", 2: 5}': ["a", "5"],
    '{1: "a", 2: null}': ["a", "None"],
    "{}": None,
    '{1: "a{", 2: "b"}': ["a{", "b"],
    '{1: "a", 2: "b",}': None,
    '{1: "a" 2: "b"}': None,
    '{x: "a", 2: "b"}': None,
    '{1: "a\nb", 2: "c"}': None,
    '{2: "b", 1: "a"}': ["a", "b"],
    '{1: "a", 01: "z", 2: "b"}': ["z", "b"],
    '{ 1 : "a", 2: "b"}': None,
    '{1: "é\\u00e9", 2: "\\"q\\""}': ["éé", '"q"'],
    '{1: "", 2: " "}': ["", " "],
    '{1: "$1", 2: "\\\\"}': ["$1", "\\"],
}


def test_json_answers(spark):
    df = spark.createDataFrame([(r,) for r in JSON_ANSWERS], "r string")
    col = A.json_answers(F.col("r"), F.array(F.lit("o1"), F.lit("o2")))
    got = {x.r: x.a for x in df.select("r", col.alias("a")).collect()}
    assert got == JSON_ANSWERS


def test_listed_answers(spark):
    df = spark.createDataFrame([("a , b\t,c,d",), ("a",), ("",), ("a,b,c",)], "r string")
    col = A.listed_answers(F.col("r"), F.array(F.lit("o1"), F.lit("o2"), F.lit("o3")))
    assert [r.a for r in df.select(col.alias("a")).collect()] == [["a", "b", "c"], ["a", "o2", "o3"], ["", "o2", "o3"], ["a", "b", "c"]]


def test_refilled_and_training(spark, pairs, mentions):
    masks = cloze.mask_all(pairs, mentions)
    responses = spark.createDataFrame([("p", '{1: "x", 2: "NOT_FOUND"}'), ("r", "bad")], "pair_id string, response string")
    got = {r.pair_id: r.text for r in cloze.refilled(masks, responses).collect()}
    assert got == {"p": "x with {fever} and heart failure"}
    listed = {r.pair_id: r.text for r in cloze.refilled(masks, responses, form="list").collect()}
    assert listed["r"] == "é bad"
    texts = {r.pair_id: r.text for r in cloze.training_texts(masks, eos="!").collect()}
    assert texts["p"].endswith("the MASK words should be acute heart failure, heart failure!")


def test_lists_overrides_coverage(spark, pairs, mentions):
    lists = {'"[\'T1\', \'T2\']"': ["T1", "T2"], "['T1']": ["T1"], "[]": []}
    df = spark.createDataFrame([(k,) for k in lists], "t string")
    assert {r.t: r.p for r in df.select("t", A.parse_list(F.col("t")).alias("p")).collect()} == lists
    given = spark.createDataFrame([("p", "new")], "pair_id string, text string")
    assert {r.pair_id: r.summary for r in cloze.override_summaries(pairs, given).collect()} == {"p": "new", "q": "no mention", "r": "é aspirin"}
    extra = mentions.select("pair_id").union(spark.createDataFrame([("z",)], "pair_id string"))
    assert {(r.pair_id, r.missing) for r in cloze.coverage(pairs, extra).collect()} == {("q", "extraction"), ("z", "summary")}


def test_extractor_as_a_table_function(spark):
    """Built once per worker, its offsets checked, null texts left out, any key."""
    texts = spark.createDataFrame([({"a": i}, t) for i, t in enumerate(["Heart and lung", None, "", "é Fever", "bad"])], "k map<string,int>, body string").select(F.col("k")["a"].alias("k"), "body")

    def factory():
        built = []
        built.append(1)

        def run(batch):
            assert len(built) == 1
            return [[(0, 5, "C1", "heart", ["T047", "T1"])] if "Heart" in t else [(2, 7, "C2", "fever", [])] if "Fever" in t else [(1, 9, "C3", "x", ["T1"]), (2, 2, "C4", "y", [])] if t else [] for t in batch]

        return run

    got = sorted(K.extract_mentions(texts, factory, key="k", text="body", batch_size=2).collect())
    assert [(r.k, r.cui, r.source_value, r.intact) for r in got] == [(0, "C1", "Heart", True), (3, "C2", "Fever", True), (4, "C3", None, False), (4, "C4", None, False)]
    assert got[0].type_ids == ["T047", "T1"] and got[1].type_ids == []
    with pytest.raises(Exception, match="answers"):
        K.extract_mentions(texts, lambda: lambda batch: [], key="k", text="body").collect()
