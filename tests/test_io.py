import gzip

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from notepairs.sources import sinks, tables, textfiles


def test_csv_with_lines_quotes_and_gzip(spark, tmp_path):
    text = 'ROW_ID,SUBJECT_ID,HADM_ID,CHARTDATE,CHARTTIME,CATEGORY,DESCRIPTION,TEXT,EXTRA\n1,2,3,2150-01-01,,ECG,Report,"line one\n\nsaid ""hi"", ok",x\n2,2,,2150-01-01,2150-01-01 10:00:00,ECG,,plain,y\n'
    (tmp_path / "a.csv").write_text(text)
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write(text)
    for name in ("a.csv", "b.csv.gz"):
        df = tables.read_csv(spark, str(tmp_path / name), tables.NOTES, partitions=2)
        rows = sorted(df.collect(), key=lambda r: r.row_id)
        assert [r.text for r in rows] == ['line one\n\nsaid "hi", ok', "plain"]
        assert rows[0].charttime is None and rows[1].hadm_id is None and df.schema["row_id"].dataType.typeName() == "long"
    with pytest.raises(ValueError, match="nothing_here"):
        tables.read_csv(spark, str(tmp_path / "a.csv"), "nothing_here string")


def test_missing_tables(spark, tmp_path):
    from notepairs.constants import EXPECTED_TABLES

    for t in EXPECTED_TABLES[2:]:
        (tmp_path / f"{t}.csv{'.gz' if len(t) % 2 else ''}").write_text("x")
    (tmp_path / "README.csv").write_text("x")
    (tmp_path / f"{EXPECTED_TABLES[-1]}.csv").write_text("")
    got = {r.missing for r in tables.missing_tables(tables.folder_files(spark, str(tmp_path))).collect()}
    assert got == set(EXPECTED_TABLES[:2])


def test_text_folder(spark, tmp_path):
    df = spark.createDataFrame([("1_2_3", "a\nb\n"), ("4_5_6", ""), ("7_8_9", None), ("0_0_0", "é")], "pair_id string, text string")
    textfiles.export_texts(df, f"file://{tmp_path}/out")
    assert [f.read_text() for f in (tmp_path / "out").rglob("1_2_3.txt")] == ["a\nb\n"]
    got = {r.pair_id: r.text for r in tables.read_texts(spark, f"{tmp_path}/out").collect()}
    assert got == {"1_2_3": "a\nb\n", "4_5_6": "", "7_8_9": "", "0_0_0": "é"}


def test_text_folder_from_elsewhere(spark, tmp_path):
    for name, text in (("1_2_3.txt", "a\nb\n"), ("4_5_6.v2.txt", ""), ("0_0_0", "é")):
        (tmp_path / name).write_text(text)
    got = {r.pair_id: r.text for r in tables.read_texts(spark, str(tmp_path)).collect()}
    assert got == {"1_2_3": "a\nb\n", "4_5_6": "", "0_0_0": "é"}


def texts(spark, n, fail_at=None):
    """``n`` texts in several tasks, one of which fails, after it has written some of its own, where asked."""

    def run(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                if i == fail_at:
                    raise RuntimeError("killed")
                yield pa.RecordBatch.from_arrays([pa.array([f"k{i}"]), pa.array([f"text {i}"])], names=["pair_id", "text"])

    return spark.range(0, n, 1, 4).mapInArrow(run, "pair_id string, text string")


def test_a_killed_export_leaves_nothing(spark, tmp_path):
    folder = tmp_path / "out"
    with pytest.raises(Exception, match="killed"):
        textfiles.export_texts(texts(spark, 400, fail_at=399), str(folder))
    assert list(tmp_path.iterdir()) == []
    textfiles.export_texts(texts(spark, 400), str(folder))
    assert {r.pair_id: r.text for r in tables.read_texts(spark, str(folder)).collect()} == {f"k{i}": f"text {i}" for i in range(400)}


def test_a_killed_export_leaves_what_was_there(spark, tmp_path):
    folder = str(tmp_path / "out")
    textfiles.export_texts(texts(spark, 8), folder)
    with pytest.raises(Exception, match="killed"):
        textfiles.export_texts(texts(spark, 400, fail_at=200), folder, overwrite=True)
    with pytest.raises(Exception, match="exists"):
        textfiles.export_texts(texts(spark, 9), folder)
    assert tables.read_texts(spark, folder).count() == 8
    textfiles.export_texts(texts(spark, 9), folder, overwrite=True)
    assert tables.read_texts(spark, folder).count() == 9 and [p.name for p in tmp_path.iterdir()] == ["out"]
    textfiles.export_texts(texts(spark, 0), folder, overwrite=True)
    assert tables.read_texts(spark, folder).count() == 0


def test_attempts_that_did_not_count_are_left_out(tmp_path):
    """A repeated task attempt wrote files too; only those of the attempts that were committed are moved."""
    writer = textfiles.TextFileWriter(f"file://{tmp_path}/out", False)
    batch = lambda *rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["key", "text"])
    lost, kept = writer.write(iter([batch(("a", "half"))])), writer.write(iter([batch(("a", "whole"), ("b", ""))]))
    assert lost.attempt != kept.attempt and not (tmp_path / "out").exists()
    writer.commit([kept, None])
    assert {p.name: p.read_text() for p in (tmp_path / "out" / "texts").rglob("*.txt")} == {"a.txt": "whole", "b.txt": ""}
    assert len(list((tmp_path / "out" / "keys").iterdir())) == 1


def test_concept_files(spark, tmp_path):
    (tmp_path / "MRCONSO.RRF").write_text('C1|ENG|P|L|PF|S|Y|A||||ICD10|PT|I50|Heart "failure"|0|N||\n')
    (tmp_path / "MRSTY.RRF").write_text("C1|T047|B2|Disease or Syndrome|AT1||\n")
    name = tables.read_concept_names(spark, str(tmp_path / "MRCONSO.RRF")).first()
    assert tuple(name) == ("C1", "ICD10", "I50", 'Heart "failure"')
    assert tuple(tables.read_concept_types(spark, str(tmp_path / "MRSTY.RRF")).first()) == ("C1", "T047")


def test_pair_and_outcome_sinks(spark, tmp_path):
    pairs = spark.createDataFrame(
        [("a", 1, 0, "d", "s"), ("b", 1, 3, "d", "s"), ("c", 4, 0, "d", "s")], "pair_id string, code int, heading_idx int, document string, summary string"
    )
    path = str(tmp_path / "pairs")
    sinks.write_pairs(pairs, path)
    back = sinks.read_pairs(spark, path)
    assert {r.pair_id for r in back.filter("code = 1 AND heading_idx = 3").collect()} == {"b"} and back.count() == 3
    plan = back.filter("code = 4")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(code" in plan
    sinks.write_outcomes(pairs.select("pair_id", "code"), str(tmp_path / "codes"))
    assert spark.read.json(str(tmp_path / "codes")).filter("code = 1").count() == 2


def test_subject_layout(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 37).alias("subject_id"), "id")
    path = str(tmp_path / "by_subject")
    sinks.write_by_subject(df, path)
    files = spark.read.parquet(path).select("subject_id", F.col("_metadata.file_name").alias("f")).distinct()
    assert files.groupBy("subject_id").count().filter("count > 1").count() == 0
    spark.sql("DROP TABLE IF EXISTS layout_test")
    sinks.write_bucketed(df, "layout_test", 4)
    t = spark.table("layout_test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t.join(t.withColumnRenamed("id", "id2"), "subject_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    spark.sql("DROP TABLE layout_test")


def test_shared_folder(spark, monkeypatch):
    from notepairs import session

    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    stand_in = lambda master: type("S", (), {
        "conf": type("C", (), {"get": staticmethod(lambda key, default=None: None if key == "spark.checkpoint.dir" else "/w/")}),
        "sparkContext": type("X", (), {"master": master}),
    })
    assert session.shared_folder(stand_in("local[2]")) == "/w-stages"
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(stand_in(master))


def test_stages_can_be_removed(spark):
    from notepairs.session import clear, clear_all, stage

    kept, gone = stage(spark.range(5)), stage(spark.range(7))
    clear(gone)
    assert kept.count() == 5
    with pytest.raises(Exception, match="FILE|file"):
        gone.collect()
    clear_all(spark)
    with pytest.raises(Exception, match="FILE|file"):
        kept.collect()
