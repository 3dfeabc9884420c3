import random

from pyspark.sql import functions as F

from notepairs.functions import text as T
from notepairs.functions.sections import strip_signature, with_outcome
from tests.restated import cleaned, outcome

LINES = [
    "", "", " ", "#", ".", "end", "end", "end ", "Some plain words here", "\tTabbed\xa0text  here ", "RENAL: stable",
    "UNKNOWN HEAD: foo", "Hospital Course:", "HOSPITAL COURSE:", "HOSPITAL COURSE: well", "Brief Hospital Course: " + "word " * 40,
    "HOSPITAL COURSE BY", "SYSTEMS: a", "DISPOSITION: home", "Medications on Admission:", "  DISCHARGE CONDITION: good", "x: y",
    "#1 HOSPITAL COURSE: no", "HOSPITAL COURSE 2: no", "Dictated By: X", "[**A 1**] [**B 2**] MD [**C 3**]", "ÉTAT: é", "\x1codd\x85",
    "word " * 35, "Hospital course", ":", "FEN: fluids", "²UP: x", "DISPOSITION : x",
]


def notes(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        pool = rng.sample(LINES, rng.randint(2, 12))
        out.append("\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14))))
    return out


def as_df(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(8)


def test_clean_text_matches_the_rules(spark):
    texts = notes(3000, 1)
    got = {r.id: r.c for r in as_df(spark, texts).select("id", T.clean_text(F.col("text")).alias("c")).collect()}
    wrong = [(t, got[i], cleaned(t.split("\n"))) for i, t in enumerate(texts) if got[i] != cleaned(t.split("\n"))]
    assert not wrong, wrong[:2]


def test_outcomes_match_the_rules(spark):
    texts = notes(6000, 2)
    for skip in (False, True):
        df = with_outcome(as_df(spark, texts), skip_own_heading=skip)
        got = {r.id: (r.code, r.heading, r.summary) for r in df.collect()}
        want = {i: outcome(t, skip_own=skip) for i, t in enumerate(texts)}
        wrong = [(texts[i], got[i], want[i]) for i in want if got[i] != want[i]]
        assert not wrong, wrong[:2]
        assert {c for c, _, _ in want.values()} >= {-1, 0, 1, 4, 5, 6, 7, 9} | ({2} if skip else {3})


LONG = "the patient did well " * 10


def test_one_note_per_code(spark):
    cases = {
        1: f"HOSPITAL COURSE:\n{LONG}\n\nDISPOSITION: home", 2: f"x\n\nHOSPITAL COURSE: {LONG}",
        3: f"HOSPITAL COURSE:\n{LONG}\n\nNEW HEAD: x\n\nend", 4: f"Hospital Course:\n{LONG}\n\nFEN: x\n\nend",
        5: f"Hospital Course:\n{LONG}\n\nNEW HEAD: x\n\nend", 6: f"My Hospital Course:\n{LONG}\n\nend", 7: LONG,
        0: f"Hospital Course:\n{LONG}\n\nHOSPITAL COURSE: again", 9: "Hospital Course: short\n\nDISPOSITION: home", -1: "Dictated By: X",
    }
    got = with_outcome(as_df(spark, list(cases.values()))).select("id", "code", "summary").collect()
    assert {list(cases)[r.id]: r.code for r in got} == {c: c for c in cases}
    assert next(r.summary for r in got if r.code == 1) == LONG.strip()


def test_null_text_and_flags(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, text string")
    assert {r.code for r in with_outcome(df).collect()} == {-1, 7}
    assert {r.code for r in with_outcome(df, addendum=F.lit(True)).collect()} == {8}
    assert {r.code for r in with_outcome(df, timeless=F.lit(True)).collect()} == {-1}


def test_signature(spark):
    texts = ["a\nDictated By X\nb\nDictated By Y", "a\n\n", "a\n\n\n", "a\n[**x**] y [**z**][**w**]", "Dictated By", ""]
    got = {r.id: r.s for r in as_df(spark, texts).select("id", strip_signature(F.col("text")).alias("s")).collect()}
    assert got == {0: "a", 1: "a\n", 2: "a\n\n", 3: "a", 4: None, 5: None}


def test_note_block_and_counts(spark):
    df = spark.createDataFrame([("2150-01-01", "ECG", " ", "x"), ("2150-01-01", None, "Report", "x")], "t string, c string, d string, x string")
    got = [r[0] for r in df.select(T.note_block(F.col("t"), F.col("c"), F.col("d"), F.col("x"))).collect()]
    assert got == ["chart time: 2150-01-01\nnote category: ecg\nx", "chart time: 2150-01-01\nnote category: \nnote category description: report\nx"]
    row = spark.range(1).select(T.space_words(F.lit("")), T.space_words(F.lit("a  b\nc")), T.count_tokens(F.lit(" a\tb \n"))).first()
    assert tuple(row) == (1, 3, 2)
