import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from notepairs.llm import interaction

LABELS = "doc_id long, quality int, toxic int, text string"


def fails(rows):
    """Filters that each row ``(doc_id, text, part)`` fails."""
    out = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0d]+", text)
        bad = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows),
        }
        out.append({f for f, is_bad in bad.items() if is_bad})
    return out


def brute(rows, labels):
    """Applies the filters to the rows themselves, order by order."""
    failed, out = fails(rows), {}
    # A label without an id is of no document.
    good, toxic = {i for i, q, _, _ in labels if q == 1} - {None}, {i for i, _, t, _ in labels if t == 1} - {None}
    parts = {p or "" for _, _, p in rows}
    for order in map("".join, permutations("ABCDE")):
        for part in parts:
            left = [k for k, r in enumerate(rows) if (r[2] or "") == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [k for k in left if f in failed[k]]
                left = [k for k in left if f not in failed[k]]
                out[part, order, step] = [
                    len(left), len(removed), sum(f in failed[k] for k in gone), sum(failed[k] == {f} for k in [*left, *removed, *gone]),
                    sum(rows[k][0] in good for k in removed), sum(rows[k][0] in toxic for k in removed),
                ]
                gone += removed
    owned = Counter()
    for (part, order, step), counts in out.items():
        owned[part, order[step - 1]] += counts[1]
    return {key: (*counts, owned[key[0], key[1][key[2] - 1]]) for key, counts in out.items()}


def audited(docs, labels):
    got = interaction.audit(docs, labels).collect()
    table = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}
    assert len(table) == len(got)
    return table


def test_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    assert audited(documents, labels) == brute(rows, [(r.doc_id, r.quality, r.toxic, None) for r in labels.collect()])


def test_odd_rows(spark, odd_docs, no_docs):
    """Nulls, empty and long texts, repeated rows and ids, clashing names, several labels of a document."""
    labels = [(1, 1, 0, "x"), (1, 0, 1, "x"), (6, None, None, None), (7, 1, 1, None), (None, 1, 1, None), (99, 1, 1, None)]
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    assert audited(odd_docs, spark.createDataFrame(labels, LABELS)) == brute(rows, labels)
    assert audited(odd_docs, spark.createDataFrame([], LABELS)) == brute(rows, [])
    assert audited(no_docs, spark.createDataFrame(labels, LABELS)) == {}


def test_a_third_of_all_rows_are_one_text(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i} of its own", "hot" if i % 2 else f"s{i % 5}") for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(16)
    got = {(r.part, r.mask): r.n for r in interaction.mask_counts(table, spark.createDataFrame([], LABELS)).collect()}
    want, seen = Counter(), set()
    for i, text, part in rows:
        want[part, 1 + 16 * (text in seen)] += 1
        seen.add(text)
    assert {k: n for k, n in got.items() if n} == want


def test_two_texts_with_equal_digests(spark, monkeypatch):
    """A clash of both digests is seen by the whole texts and resolved by another digest."""
    true = interaction.F.xxhash64

    def weak(*columns):
        return true(*columns) if len(columns) == 1 else interaction.F.when(columns[0] > 0, true(*columns)).otherwise(0)

    monkeypatch.setattr(interaction, "text_or_empty", lambda df, c: df[c])
    monkeypatch.setattr(interaction.F, "xxhash64", lambda *c: weak(*c) if len(c) == 2 else interaction.F.length(c[0]).cast("long"))
    rows = [(1, "aaa", "s"), (2, "bbb", "s"), (3, "aaa", "s"), (4, "bbb", "s"), (5, "ccc", "s"), (6, "dd", "s")]
    counts = interaction.mask_counts(spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame([], LABELS))
    assert {r.mask: r.n for r in counts.collect() if r.n} == {1: 4, 17: 2}


@pytest.mark.parametrize("n", [1, 500, 20000])
def test_counting_filter_misses_no_repeat(n):
    rng = np.random.default_rng(n)
    digests = rng.integers(-(1 << 62), 1 << 62, n)
    again = digests[::7]
    batches = [pa.RecordBatch.from_arrays([pa.array(x)], names=["h"]) for x in (digests, again, again[:3])]
    packed = pa.Table.from_batches(list(interaction._digests(iter(batches), 1)))
    possible = set(interaction._possible((pa.scalar(0),), packed)["h"].to_pylist())
    assert possible >= set(again.tolist())
    assert len(possible - set(again.tolist())) <= 0.2 * n
