import random
from itertools import combinations

import numpy as np
import pytest

from notepairs.llm import similar


def plain(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode("utf-8", "surrogatepass").split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    """Smallest id that links at 0.8 or more reach."""
    sets, label = [(i, plain(t)) for i, t in rows], {i: i for i, _ in rows}
    pairs = [(a, b) for (a, x), (b, y) in combinations(sets, 2) if 5 * len(x & y) >= 4 * len(x | y)]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def groups(docs):
    return {r.doc_id: r.component_id for r in similar.similar_groups(docs).collect()}


def test_groups_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert groups(docs) == want
    # Similar pairs that differ in more than two bits of their fingerprints.
    assert want[2] == want[56] and want[1] == want[255]
    assert sorted(r.doc_id for r in similar.drop_similar(docs).collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("frequent", [0, 50, similar.FREQUENT])
def test_groups_of_edited_copies(spark, monkeypatch, frequent):
    """Chains of edits, a passage in every text, and sets around the bound."""
    monkeypatch.setattr(similar, "FREQUENT", frequent)
    rng, rows = random.Random(frequent), []
    passage = [f"p{k}" for k in range(12)]
    for family in range(12):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(3, 90))]
        for _ in range(12):
            if rng.random() < 0.8:
                words = list(words)
                words[rng.randrange(len(words))] = f"w{rng.randrange(4000)}"
            rows.append((len(rows), " ".join(words + passage * (family % 2))))
    assert groups(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_fingerprints_offer_pairs_first(spark):
    """Sets whose fingerprints are equal or differ in two bits are paired, others are not."""
    sets = [similar.shingles(" ".join(f"w{i}" for i in range(k, k + 40))) for k in (0, 1000)]
    for s in sets:
        bits = [sum(int(h) >> i & 1 for h in s.view(np.uint64)) * 2 > len(s) for i in range(64)]
        assert similar.mark(s).to_bytes(8, "little", signed=True) == np.packbits(np.array(bits).reshape(8, 8)[:, ::-1]).tobytes()
    rows = [(10, 5), (7, 5), (3, 5 ^ 0b11 << 40), (4, 5 ^ 0b111 << 20), (1, -1)]
    got = similar.marked_pairs(spark.createDataFrame(rows, "fp long, mark long")).collect()
    assert sorted((r.a, r.b) for r in got) == [(7, 3), (10, 7)]


def test_odd_rows(odd_docs, no_docs):
    got = similar.similar_groups(odd_docs)
    assert got.count() == odd_docs.count() and similar.similar_groups(no_docs).count() == 0
    kept = similar.drop_similar(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == got.select("component_id").distinct().count()


def test_signatures_never_rule_out_similar_sets():
    """They differ in no more bits than the sets in shingles, whatever the sizes; sets that share little are told apart."""
    rng = np.random.default_rng(7)
    ruled_out = 0
    for _ in range(300):
        n = int(rng.integers(1, 3000))
        whole = rng.integers(-(1 << 62), 1 << 62, n + n // 4)
        x, y = np.unique(whole[: n]), np.unique(whole[int(rng.integers(0, n)) :])
        size = min(len(similar.signature(s)) for s in (x, y))
        a, b = similar.folded([similar.signature(x), similar.signature(y)], size)
        bits = int(np.bitwise_count(a ^ b).sum())
        apart = len(np.setxor1d(x, y))
        assert bits <= apart and (bits - apart) % 2 == 0
        most = int(similar.most_apart(np.array([len(x)]), np.array([len(y)]))[0])
        assert (apart <= most) == (5 * len(np.intersect1d(x, y)) >= 4 * len(np.union1d(x, y)))
        ruled_out += bits > most
    assert ruled_out > 150


def test_crowded_shingles_are_met_in_blocks(spark, monkeypatch):
    """A shingle in all texts, all-different otherwise, with families among them."""
    monkeypatch.setattr(similar, "BLOCK", 16)
    monkeypatch.setattr(similar, "FREQUENT", 0)
    rng, rows = random.Random(2), []
    for family in range(40):
        words = ["a", "b", "c", "d", "e"] * (family % 2) + [f"w{rng.randrange(9000)}" for _ in range(rng.randint(8, 40))]
        for _ in range(6):
            if rng.random() < 0.7:
                words = list(words)
                words[rng.randrange(len(words))] = f"w{rng.randrange(9000)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, "a b c d e" + f" x{i}" * (i % 4)) for i in range(60)]
    assert groups(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
