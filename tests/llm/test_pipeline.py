"""The stages against plain Python over the smallest table."""

import hashlib
import importlib
import re
from collections import Counter

import pytest

import corpus_pipeline
from notepairs.llm import bpe
from tests.llm.test_exact import brute as exact_brute
from tests.llm.test_similar import brute as similar_brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, documents):
    """Rows after each stage, every one read by the next from its stored form."""
    out, docs = [documents], documents
    for _, stage in corpus_pipeline.STAGES:
        from notepairs.session import stage as store

        docs = store(stage(spark, docs, SF))
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]
    assert all(df.columns == steps[0].columns for df in steps[:-1])


def test_quality_keeps_clean_documents(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = set(ids(steps[1]))
    for r in steps[0].collect():
        words = len(re.findall(r"[^\x20\x09-\x0d]+", r.text or ""))
        if labels.get(r.doc_id) is not None and words >= 50:
            assert (r.doc_id in kept) == (labels[r.doc_id] == 1)


def test_dedup_stages(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    assert ids(steps[2]) == sorted({keep for _, keep, _, _ in exact_brute(rows)})
    assert ids(steps[3]) == sorted(set(similar_brute([(r.doc_id, r.text) for r in steps[2].collect()]).values()))


def test_mix_and_encoding(steps):
    texts = {r.doc_id: r.text for r in steps[3].collect()}
    mixed = Counter(ids(steps[4]))
    assert set(mixed) <= set(texts) and max(mixed.values()) <= 3
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t))
    total = sum(words(t) for t in texts.values())
    assert abs(sum(words(texts[i]) * n for i, n in mixed.items()) - total) < 0.2 * total
    want = Counter((i, hashlib.sha256(bpe.encode_text(texts[i])).hexdigest()) for i, n in mixed.items() for _ in range(n))
    got = steps[5].collect()
    assert Counter((r.doc_id, r.ids_sha256) for r in got) == want
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)


def test_run_is_the_stages_in_order(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, steps[-1].collect()))


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs):
    """No text passes the rules; equal texts, repeated rows, empty texts and an id with two texts leave one row each."""
    want = {
        "quality": [], "exact_dedup": [2, 5, 6, 8, 8], "near_dedup": [1, 3, 6, 8],
        "byte_bpe": [None, None, 1, 1, 2, 3, 4, 5, 6, 7, 8, 8],
    }
    order = lambda i: (i is not None, i or 0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0, name
        got = sorted((r.doc_id for r in stage(spark, odd_docs, SF).collect()), key=order)
        if name == "mixing":
            assert set(got) <= set(want["byte_bpe"]) and max(Counter(got).values()) <= 6
        else:
            assert got == want[name], name


def test_queries_are_registered():
    entry = importlib.import_module("__spark_entry__")
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert "pipeline" in entry.queries()
