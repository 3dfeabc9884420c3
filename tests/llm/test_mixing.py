import re
from collections import Counter
from fractions import Fraction

import pytest

from notepairs.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))


def plain_targets(rows):
    """Targets by repeated sharing, in fractions."""
    size = Counter()
    for source, text in rows:
        size[source] += words(text)
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    capped, total = {}, sum(size.values())
    while True:
        rest = [s for s in order if s not in capped]
        left = Fraction(total - sum(capped.values()))
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * size[s]]
        if not over:
            return size, share | capped
        capped |= {s: 3 * size[s] for s in over}


def test_targets_and_taken(documents, odd_docs):
    for docs in (documents, odd_docs):
        size, target = plain_targets([(r.source, r.text) for r in docs.collect()])
        got = mixing.mixture(docs).collect()
        assert len(got) == docs.count()
        taken, largest = Counter(), Counter()
        for r in got:
            assert r.source_size == size[r.source]
            assert r.target == pytest.approx(float(target[r.source]))
            assert r.taken == r.epochs * r.size <= 3 * r.size and 0 <= r.position <= 1
            taken[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r.size)
        for s in size:
            assert abs(taken[s] - float(target[s])) <= largest[s] / 2 + 1e-6


def test_reruns_agree_and_sources_follow_their_schedule(documents):
    first = [(r.doc_id, r.taken, r.position) for r in mixing.mixture(documents).orderBy("doc_id").collect()]
    again = [(r.doc_id, r.taken, r.position) for r in mixing.mixture(documents.repartition(5)).orderBy("doc_id").collect()]
    assert first == again
    for rise in mixing.RISE:  # the share of demand before half time
        early = rise * 0.5 + (1 - rise) * 0.25
        t = documents.sparkSession.range(1).select(mixing.position(mixing.F.lit(early), mixing.F.lit(rise))).first()[0]
        assert t == pytest.approx(0.5)


def test_mix_repeats_rows_in_order(documents, odd_docs, no_docs):
    plan = {(r.doc_id): r.epochs for r in mixing.mixture(documents).collect()}
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == Counter({k: v for k, v in plan.items() if v})
    odd = mixing.mix(odd_docs)
    assert odd.columns == odd_docs.columns
    assert odd.count() == sum(r.epochs for r in mixing.mixture(odd_docs).collect())
    assert mixing.mix(no_docs).count() == 0 and mixing.mixture(no_docs).count() == 0


def test_ranks_over_many_sources(spark):
    names = [f"s{i:04d}" for i in range(500)] + [None]
    df = spark.createDataFrame([(n, n) for n in names], "part string, source string").repartition(7)
    assert [r.source for r in mixing.ranked(df).orderBy("rank").collect()] == names
    assert [r.rank for r in mixing.ranked(df).orderBy("rank").collect()] == list(range(501))
