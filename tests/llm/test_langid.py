import pytest
from pyspark.sql import functions as F

from notepairs.llm import langid


def predict(docs, held="doc_id % 3 = 1"):
    return langid.predict(docs, held_out=F.expr(held))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    met = predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = met.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.98 and 0 <= right[1] <= right[2] <= 1
    sure = met.where("NOT rejected").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert sure[0] > 0.99 and sure[1] > 0.9 * met.count()


def test_predictions_use_the_text_alone(documents):
    given = {r.doc_id: r.lang_pred for r in predict(documents).collect()}
    other = documents.withColumn("lang", F.when(F.expr("doc_id % 3 = 1"), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert {r.doc_id: r.lang_pred for r in predict(other).collect()} == given


@pytest.mark.parametrize("text, letter", [("123 !?", False), ("½ ² Ⅷ", False), ("ß", True), ("漢", True), ("", False), ("12a", True)])
def test_letters(text, letter):
    assert langid.has_letter(text) == letter


def test_odd_rows(odd_docs, no_docs):
    got = predict(odd_docs).collect()
    assert len(got) == odd_docs.count() and {r.lang_pred for r in got} <= {"en", "de", "und"}
    assert [r.score for r in got if r.lang_pred == "und"] == [0.0] * 4
    assert predict(no_docs).count() == 0
    assert {r.lang_pred for r in predict(odd_docs, "true").collect()} == {"und"}


def test_classify_is_brute_force_over_the_dictionaries():
    """Sizes by a plain compressor for each window and dictionary."""
    import random

    import zstandard

    rng = random.Random(4)
    words = {lang: [f"{lang}{rng.randrange(300)}x".replace("0", "o").replace("1", "i") for _ in range(400)] for lang in ("aa", "bb", "cc")}
    dictionaries = {lang: langid.shaped(" ".join(ws)) for lang, ws in words.items()} | {"dd": b"q".ljust(langid.LEAST)}
    packers = langid.compressors(dictionaries)
    for _ in range(40):
        lang = rng.choice(["aa", "bb", "cc"])
        text = " ".join(rng.choices(words[lang], k=rng.randrange(1, 150)))
        data = langid.shaped(text)
        sizes = {}
        for name, content in dictionaries.items():
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            plain = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)
            sizes[name] = sum(len(plain.compress(data[i : i + langid.WINDOW])) for i in range(0, len(data), langid.WINDOW))
        got = langid.classify(text, packers)
        assert sizes[got[0]] == min(sizes.values()) and got[0] == min(n for n, s in sizes.items() if s == min(sizes.values()))
        assert 0 < got[1] <= 1


def test_sample_is_the_smallest_checksums(spark, monkeypatch):
    """A language of most rows and one of a single short text are both learned, and the sample does not depend on the layout."""
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 20)
    rows = [(f"wort nummer {i} im text", "de") for i in range(3000)] + [("hi", "xx")] + [("ein text von vielen", "de")] * 1500
    table = spark.createDataFrame(rows, "text string, lang string")
    marks = sorted(r.m for r in table.where("lang = 'de'").select(langid.F.xxhash64("text").alias("m")).distinct().collect())[:20]
    texts = {r.m: r.text for r in table.select("text", langid.F.xxhash64("text").alias("m")).collect()}
    got = langid.learn(table.repartition(7))
    assert got == {"de": b"".join(langid.shaped(texts[m]) + b" " for m in marks), "xx": b"hi ".ljust(langid.LEAST)} == langid.learn(table.coalesce(1))
