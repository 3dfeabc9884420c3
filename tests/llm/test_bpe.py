import numpy as np
import pytest
from pyspark.sql import functions as F

from notepairs.llm import bpe


def ids(text):
    return np.array(bpe._encoding(bpe.VOCABULARY).encode_ordinary(text or ""), "<u4").tobytes()


@pytest.mark.parametrize("chunk, overlap", [(bpe.CHUNK, bpe.OVERLAP), (64, 16), (7, 3)])
def test_ids_are_those_of_the_whole_text(documents, odd_docs, chunk, overlap):
    for docs in (documents.limit(60), odd_docs.where("length(text) < 10000 OR text IS NULL")):
        want = sorted(((r.doc_id, ids(r.text)) for r in docs.collect()), key=repr)
        got = bpe.encode(docs, chunk=chunk, overlap=overlap)
        assert sorted(((r.doc_id, bytes(r.ids)) for r in got.collect()), key=repr) == want


def test_long_texts_without_shared_boundaries(spark):
    texts = ["x" * 500, " " * 300 + "a" + "\n" * 200 + "b", "don't" * 90, "漢字" * 200, "a  b\n\n\nc   " * 60, "1234567890" * 40, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = bpe.decode(bpe.encode(docs, chunk=50, overlap=10)).collect()
    assert {r.doc_id: (bytes(r.ids), bytes(r.decoded)) for r in coded} == {i: (ids(t), t.encode()) for i, t in enumerate(texts)}


def test_round_trip(odd_docs, no_docs):
    coded = bpe.decode(bpe.encode(odd_docs))
    assert sorted(bytes(r.decoded) for r in coded.collect()) == sorted((r.text or "").encode() for r in odd_docs.collect())
    assert coded.where(bpe.n_ids(F.col("ids")) * 4 != F.octet_length("ids")).count() == 0
    assert bpe.encode(no_docs).count() == 0
    rows = lambda df: sorted((bytes(r.ids), bytes(r.decoded)) for r in df.collect())
    assert rows(bpe.encode(odd_docs, decoded=True)) == rows(coded)
