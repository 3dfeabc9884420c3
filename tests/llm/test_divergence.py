import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from notepairs.llm import divergence

COLUMNS = "doc_id long, text string, lang string, source string"


def terms_of(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def brute(rows, least=None):
    """Every share of every kept term of every source, zeros included."""
    least = least or divergence.MIN_DOCS
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source, found = lang or "", source or "", terms_of(text)
        groups[lang].add(source)
        counts[lang, source].update(found)
        held[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        total = Counter()
        for s in sources:
            total.update(counts[lang, s])

        def shares(count):
            size = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (size + 2 * len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(total)
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 10)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def found(docs):
    return sorted(tuple(r) for r in divergence.divergence(docs).select("lang", "source", "part", "item", "value", "rank").collect())


def words(rng, n):
    letters = "abcdefgh" + "äßñ語𝒳"
    return ["".join(rng.choice(letters) for _ in range(rng.choice((1, 2, 3, 7, 8, 9, 15, 16, 17, 18, 33, 70)))) for _ in range(n)]


@pytest.mark.parametrize("sources, tile_terms", [(9, 4096), (150, 5)])
def test_random_texts(spark, monkeypatch, sources, tile_terms):
    """Terms of all lengths, in one tile of sources and in several, over one share of terms and many."""
    monkeypatch.setattr(divergence, "TILE_TERMS", tile_terms)
    rng = random.Random(sources)
    pool = words(rng, 60)
    rows = []
    for i in range(600):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(sources)}"
        text = rng.choice(" \n,.7").join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(pool, k=rng.randrange(20)))
        rows.append((text, "en" if rng.random() < 0.8 else "de", source))
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], COLUMNS).repartition(5)
    assert found(docs) == brute(rows)


def test_chunks_add_up(monkeypatch):
    """A task counts the same in many chunks, over several batches, as in one."""
    rng = random.Random(3)
    pool = words(rng, 40)
    rows = [(rng.choice(("en", "de")), f"s{rng.randrange(3)}", " ".join(rng.choices(pool, k=rng.randrange(15)))) for _ in range(200)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[a : a + 70])], names=["lang", "source", "text"]) for a in range(0, 200, 70)]

    def counted(chunk):
        monkeypatch.setattr(divergence, "CHUNK", chunk)
        out = Counter()
        for batch in divergence._counted(iter(batches)):
            for r in batch.to_pylist():
                out[r["lang"], r["source"], r["term"], "n"] += r["n"]
                out[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return out

    want = Counter()
    for lang, source, text in rows:
        for term, n in Counter(terms_of(text)).items():
            want[lang, source, term, "n"] += n
            want[lang, source, term, "docs"] += 1
    assert counted(1 << 20) == counted(500) == want


def test_documents(spark, documents):
    assert found(documents) == brute([(r.text, r.lang, r.source) for r in documents.collect()])


def test_odd_rows(spark, odd_docs, no_docs):
    """Null text, language and source, repeated rows, long texts, clashing names; no kept term at all."""
    rows = [(r.text, r.lang, r.source) for r in odd_docs.collect()]
    assert found(odd_docs) == brute(rows)
    assert {r[4] for r in found(odd_docs)} == {0} and found(no_docs) == []
    many = odd_docs
    for _ in range(4):
        many = many.unionByName(many)
    assert found(many) == brute(rows * 16)


def test_a_group_without_terms_is_compared(spark):
    rows = [("common words here", "en", "a")] * 10 + [("12 34", "en", "b"), (None, "en", None)]
    got = found(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], COLUMNS))
    assert got == brute(rows) and {r[1] for r in got if r[2] == "pair"} == {"a", "b", ""}


@pytest.mark.parametrize("n_words", [1, 2])
def test_radix_order_is_stable(n_words):
    rng = np.random.default_rng(n_words)
    columns = [rng.integers(0, 1 << 63, 5000, dtype=np.uint64) >> np.uint64(rng.integers(0, 60)) for _ in range(n_words)]
    columns[0] %= np.uint64(300)
    want = sorted(range(5000), key=lambda i: tuple(int(c[i]) for c in columns))
    assert divergence.radix_order(columns).tolist() == want


def test_terms_of_any_length_are_counted():
    texts = [b"abcdefgh abcdefghi ABCDEFGH", "ä日本語日本語日本語日本語日本語 x".encode(), b"", b"y" * 100_000 + b" abcdefgh", b"x1x"]
    groups = np.array([0, 0, 1, 1, 1])
    got = Counter()
    for g, term, n, docs in divergence.count_terms(texts, groups):
        for row in zip(g.tolist(), term.to_pylist(), n.tolist(), docs.tolist()):
            got[row] += 1
    want = Counter()
    for g in (0, 1):
        per = [Counter(terms_of(t.decode())) for t, own in zip(texts, groups) if own == g]
        for term in set().union(*per):
            want[g, term, sum(c[term] for c in per), sum(term in c for c in per)] += 1
    assert got == want
