import re

from notepairs.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def base(df):
    return sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect())


def test_base_counts(documents, odd_docs, no_docs):
    for docs in (documents, odd_docs):
        assert base(quality.line_quality(docs)) == sorted(plain(r.text) for r in docs.collect())
    assert quality.line_quality(no_docs).count() == 0


def test_repeats_overlap(spark):
    docs = spark.createDataFrame([(1, "a a a a b"), (2, "a b c d a b c"), (3, "a b")], "doc_id long, text string")
    assert {r.doc_id: r.n_repeat_words for r in quality.line_quality(docs).collect()} == {1: 4, 2: 6, 3: 0}


def test_lines(spark):
    lines = {
        "A sentence that ends.": True, "Home | About us | Contact": False, "no closing mark": False, "THIS IS SHOUTED AT ALL.": False,
        "We use cookies to improve it.": False, "a## b** c$$ d%%.": False, "Ein Satz, der endet!": True, "SHORT ONE.": True, "«Ça va?»": True,
    }
    df = spark.createDataFrame(list(lines.items()), "line string, want boolean")
    assert df.select("line", "want", quality.line_passes(df["line"]).alias("got")).where("want <> got").count() == 0


def test_verdict_and_kept_rows(spark, documents, odd_docs, no_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    judged = quality.line_quality(documents).join(labels, "doc_id").where("NOT base_failed")
    assert judged.where("quality = 1 AND NOT kept").count() == 0
    assert judged.where("quality = 0 AND kept").count() == 0
    for docs in (odd_docs, no_docs):
        kept = quality.keep_good(docs)
        assert kept.columns == docs.columns
        assert kept.count() == quality.line_quality(docs).where("kept").count()


def test_cleaned_text_has_first_passing_lines(spark):
    docs = spark.createDataFrame([(1, "One.\nTwo\nOne.\n\nThree!")], "doc_id long, text string")
    assert quality.line_quality(docs).first().cleaned == "One.\nThree!"
