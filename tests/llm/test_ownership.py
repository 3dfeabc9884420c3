import hashlib
import re

import pytest
from pyspark.sql import functions as F

from notepairs.llm import ownership

A = "q7Zk9Xw2Lm4Vt8Rb1Ns6Pd3"
B = "a1b2c3d4e5f60718293a4b5c6d7e8f90"


def plain(text):
    """Base spans of a text: kind, start, end."""
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 12 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def label(spans):
    return ",".join(f"{ownership.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs):
    return ownership.scan(docs, repository=F.concat("source", F.lit("/"), "lang"), owner=docs["source"])


def test_base_spans(documents, odd_docs, no_docs):
    for docs in (documents, odd_docs):
        want = sorted(((r.doc_id, hashlib.sha256(label(plain(r.text)).encode()).hexdigest()) for r in docs.collect()), key=repr)
        assert sorted(((r.doc_id, r.base_sha256) for r in scan(docs).collect()), key=repr) == want
    assert scan(no_docs).count() == 0


@pytest.mark.parametrize("text", [
    f"𝒯 token: secret: {A} and password = '{A}'", f"API_KEY={A} apikey: \"{A}", "token=short secret=alsoshort", f"AKIA{'Z9' * 8} AKIAZZ x{B}y {B}",
    f"{B}" * 3, f"tokentoken==={A}", "", f"ſecret={A}",
])
def test_base_spans_of_hard_texts(spark, text):
    docs = spark.createDataFrame([(1, text, "s", "en")], "doc_id long, text string, source string, lang string")
    got = scan(docs).first()
    assert ",".join(x for x in got.spans.split(",") if not x.startswith("owned")) == label(plain(text))


def test_owned_runs_are_added_and_examples_are_not(spark):
    rows = [(1, f"see {A} here", "s1", "en"), (2, f"token = {A}", "s1", "en"), (3, f"key {A[::-1]}", "s1", "en"), (4, f"key {A[::-1]}", "s2", "en"),
            (5, f"key {A[::-1]}", "s3", "en"), (6, f"secret={B}", "s1", "en"), (7, f"secret={B}", "s2", "de"), (8, f"secret={B}", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in scan(docs).collect()}
    assert got[1].spans == f"owned:4:{4 + len(A)}" and got[1].n_owned == 1
    assert got[2].n_owned == 0 and got[2].n_live == 1 and got[2].n_assign == 1
    assert [got[i].spans for i in (3, 4, 5)] == ["", "", ""]
    assert all(got[i].n_examples == 2 and got[i].n_live == 0 and got[i].n_assign == 1 and got[i].n_hex == 1 for i in (6, 7, 8))


def test_one_value_in_most_rows(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(f"token={A}").alias("text"), (F.col("id") % 2).cast("string").alias("source"), F.lit("en").alias("lang"))
    assert scan(docs).where("n_live = 1 AND n_assign = 1").count() == 3000


def test_copies_inside_one_owner_are_examples(spark):
    """One value in many repositories of a single source, another in few of them."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 500 == 7, f"key {A[::-1]}").otherwise(f"key {A}").alias("text"), F.lit("s").alias("source"), (F.col("id") % 100).alias("repo")
    )
    got = ownership.scan(docs, repository=docs["repo"], owner=docs["source"])
    assert {(r.doc_id, r.spans) for r in got.where("spans <> ''").collect()} == {(i, f"owned:4:{4 + len(A)}") for i in range(7, 3000, 500)}
    few = ownership.scan(docs, repository=docs["repo"] % 3, owner=docs["source"])
    assert few.where("n_owned = 1").count() == 3000
