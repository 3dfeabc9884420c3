import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from notepairs.llm import simhash


def plain(text):
    """The fingerprint bit by bit."""
    words = ("".join(c.lower() if "A" <= c <= "Z" else c for c in text)).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs):
    """Smallest id that links at two bits or fewer reach."""
    label = {i: i for i, _ in pairs}
    changed = True
    while changed:
        changed = False
        for a, x in pairs:
            for b, y in pairs:
                if (x ^ y).bit_count() <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_masks_cover_every_pair_of_bits():
    tables = simhash.masks()
    assert len(tables) == 7
    for a in range(64):
        for b in range(64):
            assert any(not m >> a & 1 and not m >> b & 1 for m in tables)
    assert min(m.bit_count() for m in tables) >= 32


def test_fingerprints(documents, odd_docs):
    for docs in (documents, odd_docs):
        texts = sorted((r.text or "") for r in docs.collect())
        got = sorted(r.fp % (1 << 64) for r in simhash.fingerprints(docs).collect())
        assert got == sorted(map(plain, texts))


def test_components_of_documents(documents):
    rows = [(r.doc_id, plain(r.text or "")) for r in documents.collect()]
    want = plain_components(rows)
    got = {r.doc_id: r.component_id for r in simhash.near_groups(documents).collect()}
    assert got == want and len(set(want.values())) < len(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_chains_and_clouds(spark, seed):
    rng = np.random.default_rng(seed)
    fps, at = set(), int(rng.integers(0, 1 << 62))
    for _ in range(60):  # a chain
        fps.add(at)
        at ^= 1 << int(rng.integers(0, 64))
    for _ in range(3):  # a cloud around one value, and single values
        base = int(rng.integers(0, 1 << 62))
        fps |= {base ^ 1 << int(a) ^ 1 << int(b) for a, b in rng.integers(0, 64, (40, 2))} | {int(rng.integers(0, 1 << 62))}
    rows = [(i, fp) for i, fp in enumerate(sorted(fps))]
    nodes = spark.createDataFrame([(simhash._signed(fp),) for _, fp in rows], "fp long")
    roots = {r.node % (1 << 64): r.root for r in simhash.components(simhash.links(nodes)).collect()}
    want = plain_components(rows)
    groups, seen = {}, {}
    for i, fp in rows:
        groups.setdefault(want[i], set()).add(fp)
        seen.setdefault(roots.get(fp, simhash._signed(fp)), set()).add(fp)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, seen.values()))


def test_odd_rows(odd_docs, no_docs):
    got = simhash.near_groups(odd_docs)
    assert got.count() == odd_docs.count() and simhash.near_groups(no_docs).count() == 0
    zero = got.where("fp = 0 AND doc_id IS NOT NULL").select("component_id").distinct().collect()
    assert [r[0] for r in zero] == [3]
    kept = simhash.drop_near(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == got.select("component_id").distinct().count()
    assert kept.where(F.col("doc_id") == 1).count() == 1
