import hashlib
import re

import numpy as np
from notepairs.llm import exact


def brute(rows):
    """Keep id, size and digest of every (id, text)."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), (i is not None, i or 0)))
    out = []
    for i, t in rows:
        bare = re.sub(r"[\x20\x09-\x0d]", "", t or "")
        best = min(groups[bare])
        out.append((i, best[1][1] if best[1][0] else None, len(groups[bare]), hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in df.collect()), key=repr)


def test_groups_of_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    df = exact.exact_groups(odd_docs)
    assert found(df) == brute(rows)
    kept = [r for r in df.collect() if r.kept]
    assert len(kept) == len({x[3] for x in brute(rows)}) == len({bytes(r.digest) for r in kept})


def test_cut_does_not_matter(documents):
    want = brute([(r.doc_id, r.text) for r in documents.collect()])
    for cut in ("doc_id % 10 = 0", "true", "false"):
        assert found(exact.exact_groups(documents, in_snapshot=cut)) == want


def test_dropping_keeps_columns_and_one_row_a_group(odd_docs, no_docs):
    kept = exact.drop_exact(odd_docs)
    assert kept.columns == odd_docs.columns and exact.drop_exact(no_docs).count() == 0
    texts = [re.sub(r"\s", "", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == 5


def test_filters_hold_their_keys_and_few_others():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 100, 5_000, 65_536):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        made = exact.build_filter(keys)
        assert exact.may_contain(keys, *made).all()
        others = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
        assert exact.may_contain(others, *made).mean() < 0.01
        assert len(made[3]) < 1.5 * n + 60


def test_screening_rejects_new_digests(spark, documents):
    rows = exact.digest_rows(documents)
    snapshot = exact.build_snapshot(rows.where("doc_id % 2 = 0"))
    batch = exact.group_digests(rows.where("doc_id % 2 = 1"))
    passed = exact.positives(batch, batch.count(), snapshot).count()
    there = batch.join(snapshot.groups, "digest", "left_semi").count()
    assert there <= passed < batch.count() / 2


def test_bytes_decide_when_digests_collide(spark, monkeypatch):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(0, "one text"), (1, "another text")], "doc_id long, text string")
    digests = exact.digest_rows
    monkeypatch.setattr(exact, "digest_rows", lambda *a: digests(*a).withColumn("digest", F.unhex(F.lit("00"))))
    groups = exact.exact_groups(docs, in_snapshot="doc_id = 0").collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in groups) == [(0, 0, 1, True), (1, 1, 1, True)]
