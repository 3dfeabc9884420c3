import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from notepairs.llm import class_lm


def tokens(text):
    return (text or "").encode().translate(class_lm._LOWER).split() + [class_lm.END]


def score(docs, held="doc_id % 5 = 1", **more):
    return class_lm.score_texts(docs, held_out=F.expr(held), **more)


def test_counts_and_base_scores(documents, odd_docs):
    for docs in (documents, odd_docs):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        train = Counter(t for i, x in rows if i is None or i % 5 != 1 for t in tokens(x))
        n, v = sum(train.values()), len(train)
        want = sorted((
            (i, len(tokens(x)), sum(t in train for t in tokens(x)), n, round(sum(math.log10((train[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x)), 4))
            for i, x in rows), key=repr)
        got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in score(docs).collect()), key=repr)
        assert got == want


def test_held_out_texts_score_better_than_single_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = score(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert held[0] > held[1] + 0.2 * held[2]


def test_transition_rows_sum_to_one():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, (5, 5)).astype(float)
    counts[:, -1] = np.minimum(counts[:, -1], counts[:, :-1].sum(axis=1) / 4)
    logs = class_lm.transition_logs(counts, np.array([0.4, 0.3, 0.2, 0.1]))
    assert (10**logs).sum(axis=1) == pytest.approx(np.ones(5))


def test_without_training_texts_or_rows(odd_docs, no_docs):
    got = score(odd_docs, "true").collect()
    assert len(got) == odd_docs.count() and all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 for r in got)
    assert score(no_docs).count() == 0


def test_classes_follow_neighbours(spark):
    """Two languages without a common word end up in different classes."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"{'xy'[i % 2]}{k}" for k in rng.zipf(1.5, 60) % 40)) for i in range(300)]
    mixed = spark.createDataFrame(rows + [(1001, "x1 x2 x3 x4 x1 x2"), (1006, "x1 y2 x3 y4 x1 y2")], "doc_id long, text string")
    got = {r.doc_id: r for r in score(mixed, "doc_id > 1000", classes=8).collect()}
    assert got[1001].score - got[1001].base_score > got[1006].score - got[1006].base_score + 1


def test_scores_by_hand(spark, monkeypatch):
    """Neighbour counts, classes, transitions and emissions of a small table in plain loops, with the profiles the sweeps ended in."""
    seen = []
    true = class_lm.profile_logs
    monkeypatch.setattr(class_lm, "profile_logs", lambda sums: seen.append(true(sums)) or seen[-1])
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"{'uv'[i % 2]}{k}" for k in rng.zipf(1.4, 30) % 50)) for i in range(80)] + [(101, "u1 u2 new u3 u1"), (106, ""), (111, None), (116, "v1 new v2 u1")]
    got = {r.doc_id: r for r in score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id > 100", classes=6, contexts=40).collect()}
    logs = seen[-1]
    train = [tokens(x) for i, x in rows if i <= 100]
    n = Counter(t for x in train for t in x)
    end = class_lm.END
    frequent = [end] + [w for w, _ in sorted(n.items(), key=lambda x: (-x[1], x[0])) if w != end][:39]
    # The end token is among the forty most frequent words here, as in any table of texts.
    width = len(frequent) + 1
    where = {w: i for i, w in enumerate(frequent)}
    near = {w: Counter() for w in n}
    for text in train:
        for at, w in enumerate(text):
            near[w][where.get(text[at - 1] if at else end, width - 1)] += 1
            if w != end:
                near[w][width + where.get(text[at + 1], width - 1)] += 1
    cls = {w: int(np.argmax(sum(logs[p].astype(float) * k for p, k in c.items()))) for w, c in near.items()}
    size = Counter()
    for w, k in n.items():
        size[cls[w]] += k
    counts = np.zeros((7, 7))
    for text in train:
        for at, w in enumerate(text):
            before = text[at - 1] if at else end
            for row in [cls[before]] + [6] * (n[before] == 1):
                counts[row, cls[w]] += 1
                counts[row, 6] += n[w] == 1
    chances = class_lm.transition_logs(counts, np.array([size[c] for c in range(6)]) / sum(size.values()))
    for i, x in rows:
        want, before = 0.0, end
        for w in tokens(x):
            want += chances[cls.get(before, 6), cls.get(w, 6)] + (math.log10(n[w] / size[cls[w]]) if w in n else 0)
            before = w
        assert got[i].score == pytest.approx(want, abs=1e-6), i


def test_frequent_words_are_merged_in_two_steps(spark, monkeypatch):
    """Many blocks of the same words: counts and scores do not depend on the number of blocks or of salts."""
    rows = [(i, " ".join(f"w{(i * k) % 23}" for k in range(1, 30))) for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    order = lambda df: sorted((r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 4)) for r in df.collect())
    few = order(score(table.coalesce(1)))
    monkeypatch.setattr(class_lm, "BLOCK_BYTES", 500)
    for salts in (1, 32):
        monkeypatch.setattr(class_lm, "SALTS", salts)
        assert order(score(table.repartition(4))) == few
