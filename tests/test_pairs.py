import pytest
from pyspark.sql import functions as F

from notepairs.operators import pairs as N
from notepairs.session import stage
from notepairs.sources.tables import NOTES

LONG = "the patient did well " * 10
SUMMARY = f"Hospital Course: {LONG}\n\nDISPOSITION: home"
ROWS = [
    (1, 7, 70, "2150-01-03", "2150-01-03 10:00:00", "Discharge summary", "Report", SUMMARY),
    (2, 7, 70, "2150-01-03", "2150-01-03 10:00:00", "ECG", "Report", "at the anchor"),
    (3, 7, 70, "2150-01-03", "2150-01-03 10:00:01", "ECG", "Report", "after the anchor"),
    (4, 7, 70, "2150-01-02", "2150-01-02 08:00:00", None, "", "no category"),
    (5, 7, 70, "2150-01-01", None, "ECG", "Report", "no time"),
    (6, 7, None, "2150-01-01", "2150-01-01 00:00:00", "ECG", "Report", "no admission"),
    (7, 8, 80, "2150-01-03", None, "Discharge summary", "Report", SUMMARY),
    (8, 7, 71, "2150-01-03", None, "Discharge summary", "Addendum", SUMMARY),
    (9, 7, 72, None, None, "Discharge summary", "Report", SUMMARY),
    (10, 7, 70, "2150-01-03", "2150-01-03 10:00:00", "ECG", "Report", "tie"),
    (11, 8, 70, "2150-01-01", "2150-01-01 10:00:00", "ECG", "Report", "other patient"),
]


@pytest.fixture(scope="module")
def notes(spark):
    return spark.createDataFrame(ROWS, NOTES).repartition(4)


def test_anchor(notes):
    got = {r.row_id: str(r.anchor) for r in N.discharge_notes(notes).collect()}
    assert got == {1: "2150-01-03 10:00:00", 7: "2150-01-04 00:00:00", 8: "2150-01-04 00:00:00", 9: "None"}


def test_prior_notes(notes):
    closing = N.discharge_notes(notes)
    ids = lambda **o: {r.row_id for r in N.prior_notes(closing, N.other_notes(notes, **o)).filter("pair_id = '1_7_70'").collect()}
    assert ids() == {2, 4, 10}
    assert ids(null_time="chartdate") == {2, 4, 5, 10}
    with pytest.raises(ValueError):
        N.other_notes(notes, null_time="x")


def test_pairs(spark, notes):
    graded = stage(N.outcomes(N.discharge_notes(notes)))
    assert {r.pair_id: r.code for r in graded.collect()} == {"1_7_70": 1, "7_8_80": 1, "8_7_71": 8, "9_7_72": -1}
    pairs = {r.pair_id: r for r in N.build_pairs(graded, notes).collect()}
    assert set(pairs) == {"1_7_70", "7_8_80"}
    assert pairs["7_8_80"].document == "" and pairs["7_8_80"].document_words == 1
    parts = pairs["1_7_70"].document.split(" [DOC_SEP] ")
    assert [p.split("\n")[-1] for p in parts] == ["no category", "at the anchor", "tie"]
    assert pairs["1_7_70"].heading_idx == 18 and pairs["1_7_70"].summary == LONG.strip()


def test_positions(notes):
    prior = N.prior_notes(N.discharge_notes(notes), N.other_notes(notes))
    got = {(r.row_id, r.position) for r in N.note_positions(prior).filter("pair_id = '1_7_70'").collect()}
    assert got == {(4, 1), (2, 2), (10, 3)}


def test_hot_admission_is_split_and_whole(spark):
    """A third of all notes in one admission: same documents whether or not it is split."""
    n = 6000
    base = spark.range(n).select(
        F.col("id").alias("row_id"), F.lit(1).cast("long").alias("subject_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 200).cast("long").alias("hadm_id"),
        F.lit("2150-01-01").alias("chartdate"),
        F.concat(F.lit("2150-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"), F.lit(" 08:00:00")).alias("charttime"),
        F.lit("ECG").alias("category"), F.lit("").alias("description"), F.concat(F.lit("note "), F.repeat(F.col("id").cast("string"), 40)).alias("text"),
    )
    closing = base.filter("row_id < 200").withColumn("pair_id", F.col("row_id").cast("string")).withColumn(
        "anchor", F.lit("2150-02-01").cast("timestamp_ntz")
    ).withColumn("hadm_id", F.col("row_id")).repartition(8)
    notes = stage(base.repartition(8))

    def run(**conf):
        old = {k: spark.conf.get(k) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            docs = N.documents(N.prior_notes(closing, N.with_blocks(N.other_notes(notes))))
            rows = {r.pair_id: r.document for r in docs.collect()}
            return rows, docs._jdf.queryExecution().executedPlan().toString()
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)

    plain, _ = run(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    split, plan = run(**{
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    })
    assert plain == split and "skew=true" in plan
    assert len(plain["0"].split(" [DOC_SEP] ")) == sum(i % 3 == 0 or i % 200 == 0 for i in range(n))


def test_documents_need_no_shuffle_after_the_join(spark, notes):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = N.documents(N.prior_notes(N.discharge_notes(notes), N.with_blocks(N.other_notes(notes))))
        plan = docs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("hashpartitioning") == 2, plan


def test_pairs_shuffle_note_texts_once(spark, notes):
    graded = stage(N.outcomes(N.discharge_notes(notes)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = N.build_pairs(graded, notes)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # closing notes twice (keys, then sections), note blocks once
    assert plan.count("Exchange hashpartitioning") == 3, plan


def test_shuffle_partitions_follow_the_input(spark):
    from notepairs.session import tune

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        tune(spark, shuffle_bytes=100 << 40)
        assert int(spark.conf.get(key)) == (100 << 40) // (128 << 20) + 1
    finally:
        spark.conf.unset(key)


def test_bucketed_records_are_joined_in_place(spark, tmp_path):
    """Both joins of a corpus and the groupings behind them need no shuffle."""
    from notepairs.sources.sinks import write_bucketed_records

    rows = [(i, i % 7, i % 7 * 10 + i % 2, "2150-01-01", f"2150-01-01 {i % 24:02d}:00:00", "Discharge summary" if i % 5 == 0 else "Nursing", "", f"text {i}") for i in range(200)]
    notes = spark.createDataFrame(rows, "row_id long, subject_id long, hadm_id long, chartdate string, charttime string, category string, description string, text string")
    on_record = notes.where("row_id % 3 = 0").select("subject_id", "hadm_id")
    stored = write_bucketed_records(notes, on_record, ("bucketed_notes", "bucketed_admissions"), 4, folder=str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def joined(n, a):
            return N.prior_notes(N.admission_notes(N.discharge_notes(n), a), N.other_notes(n))

        # What follows the last join is one grouping by admission and pair.
        place, plain = joined(*stored), joined(notes, on_record)
        for df in (N.admission_notes(stored[0], stored[1]), place, N.documents(N.with_blocks(place))):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
        key = lambda df: sorted(map(tuple, df.select("pair_id", "row_id", "time").collect()))
        assert key(place) == key(plain) != []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_notes", "bucketed_admissions"):
            spark.sql(f"DROP TABLE {name}")


def lengths(spark, n, seed=0):
    return spark.range(n).select((F.col("id") % 2).cast("int").alias("code"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10_000)).cast("int").alias("document_words"),
                                 F.when(F.col("id") % 3 > 0, (F.col("id") % 100).cast("int")).alias("summary_words"))


def test_lengths_merge_over_runs(spark):
    runs = [lengths(spark, 900, seed) for seed in range(3)]
    whole = runs[0].unionByName(runs[1]).unionByName(runs[2])
    sketches = [N.length_sketches(r) for r in runs]
    merged = N.merge_lengths(sketches[0].unionByName(sketches[1]).unionByName(sketches[2]))
    order = lambda df: sorted(map(tuple, df.collect()))
    got = order(N.length_stats(merged))
    assert got == order(N.doc_stats(whole))
    for code, rows in ((0, []), (1, [])):
        rows = sorted(r.document_words for r in whole.where(f"code = {code}").collect())
        row = N.length_stats(merged).where(f"code = {code}").first()
        assert (row.p50_document_words, row.p99_document_words) == (rows[-(-len(rows) // 2) - 1], rows[-(-len(rows) * 99 // 100) - 1])


def test_large_sketches_stay_within_their_error(spark):
    table = lengths(spark, 400_000)
    row = N.doc_stats(table).where("code = 0").first()
    for p in (50, 90, 99):
        share = table.where("code = 0").agg(F.avg((F.col("document_words") <= row[f"p{p}_document_words"]).cast("int"))).first()[0]
        assert abs(share - p / 100) < 0.002


def test_lengths_of_nothing(spark):
    none = spark.createDataFrame([(1, None, None)], "code int, document_words int, summary_words int")
    row = N.doc_stats(none).first()
    assert row.n == 1 and row.p50_document_words is None and row.avg_summary_words is None
    assert N.doc_stats(none.limit(0)).count() == 0
