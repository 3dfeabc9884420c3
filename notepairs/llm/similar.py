"""Near-duplicates by an exact set-similarity join: five-word shingles, Jaccard similarity of at least 0.8.

Shingles stand in one order for all texts. Two sets that are similar enough share one of
their first shingles, at places that leave enough shingles behind, so pairs that fail this
are not looked at and no pair is missed. Shingles that many texts of a block hold stand
last; at most ``FREQUENT`` of them are held, and they only change the order.

What is stored of a text is its first shingles (a fifth), its size and a signature; whole
sets are made again for texts that are in a pair. First shingles that one set alone has are
dropped by a bitmap of fixed size that says which were seen twice, before they move.

Each node is first paired with one whose SimHash fingerprint, made of the five-word shingles,
differs in at most two bits, found by the covering masks of ``simhash``, and with the smallest
node of a shingle, which joins large groups by few pairs. What they link is decided by whole
sets; similar sets may differ in more bits, so this alone would miss some. Then pairs whose nodes are still in different components are looked at, those
of a crowded shingle in blocks of ``BLOCK`` nodes, so neither a task nor a row grows with it.
Pairs whose signatures differ in more bits than similar sets can are left out: one shingle
changes one bit, so the signatures differ in no more bits than the sets do in shingles. Every
pair that is left is decided by its whole sets.

Defined cases: a null or empty text has one shingle, the empty one; a text of fewer words
than a shingle is one shingle; texts of any length are read whole; rows with equal sets are
one node, so ties and repeated rows share their group, whose id is its smallest; a row
without an id belongs to its group and gives it no id; shingles and sets are told apart by
64-bit hashes; an empty table gives an empty result; other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notepairs.llm.common import by_bytes, record_batches, rows_of
from notepairs.llm.simhash import BITS, SEED, components, grouped, one_of_each, spans
from notepairs.llm.simhash import links as near_links
from notepairs.session import clear, stage

SHINGLE = 5
#: Least share of common shingles, as a fraction.
ALIKE = (4, 5)
FREQUENT = 16_384
#: Bits of the map of first shingles seen twice, 16 MB, and of texts that are in a pair, 8 MB; powers of two.
SEEN = 1 << 27
BITMAP = 1 << 26
#: Least bits of a signature; large sets have more.
SIGNATURE = 512
#: Nodes of a block of a crowded shingle.
BLOCK = 512
#: Texts of a block that must hold a shingle for it to count as frequent there.
_OFTEN = 4
_PIECE = 1 << 20
_BATCH = 1 << 15
_HEADS = pa.schema([
    ("doc_id", pa.int64()), ("row_key", pa.int64()), ("fp", pa.int64()), ("n", pa.int32()), ("first", pa.list_(pa.int64())), ("sig", pa.binary()), ("mark", pa.int64()),
])
_KEYS = pa.schema([("key", pa.int64()), ("fp", pa.int64()), ("n", pa.int32()), ("at", pa.int32())])
_HEAD_TYPES = "doc_id long, row_key long, fp long, n int, first array<long>, sig binary, mark long"


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different shingles of a text."""
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(s, SEED) for s in spans(text, size)] or [digest(b"", SEED)])
    return np.unique(np.frombuffer(hashes, ">i8").astype(np.int64))


def _name(shingle_set: np.ndarray) -> int:
    """Tells sets of shingles apart."""
    return int(np.array(xxhash.xxh64_intdigest(shingle_set.tobytes(), SEED), np.uint64).astype(np.int64))


def mark(shingle_set: np.ndarray) -> int:
    """SimHash fingerprint of a set of shingles, as a signed number: the bits set in over half of them."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(shingle_set), _BATCH):
        counts += np.unpackbits(shingle_set[at : at + _BATCH].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(shingle_set)).view(np.int64)[0])


def signature(shingle_set: np.ndarray) -> bytes:
    """Every shingle flips one of at least twice as many bits, a power of two."""
    bits = max(SIGNATURE, 1 << (2 * len(shingle_set) - 1).bit_length())
    flips = np.bincount((shingle_set.view(np.uint64) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(flips & 1).tobytes()


def folded(signatures: list[bytes], size: int) -> np.ndarray:
    """Signatures of ``size`` bytes, one a row: longer ones are what a shorter one would have been, by folding."""
    out = np.empty((len(signatures), size // 8), np.uint64)
    for i, s in enumerate(signatures):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, size // 8), axis=0)
    return out


def most_apart(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Most shingles that only one of two similar sets of these sizes has."""
    top, whole = ALIKE
    return n + m - 2 * ((top * (n + m) + top + whole - 1) // (top + whole))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in by_bytes(batch, "text", 8 << 20):
            yield part, [shingles(t) for t in part.column("text").to_pylist()]


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: shingles that several texts of a batch hold."""
    for _, sets in _sets(batches):
        key, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.int64),) * 2
        yield pa.RecordBatch.from_arrays([pa.array(key[n >= _OFTEN]), pa.array(n[n >= _OFTEN])], names=["key", "n"])


def _headed(batches: Iterator[pa.RecordBatch], last: np.ndarray, rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Task: the first shingles of every text, one of which any similar set shares, and what is known of its set."""
    top, whole = ALIKE
    for part, sets in _sets(batches):
        first = []
        for s in sets:
            place = np.minimum(np.searchsorted(last, s), max(len(last) - 1, 0))
            order = np.where(last[place] == s, rank[place] + 1, 0) if len(last) else np.zeros(len(s), np.int64)
            first.append(s[np.argsort(order, kind="stable")[: len(s) - (len(s) * top + whole - 1) // whole + 1]])
        ends = np.cumsum([0, *map(len, first)]).astype(np.int32)
        yield record_batches({
            "doc_id": part.column("doc_id"), "row_key": part.column("row_key"), "fp": [_name(s) for s in sets], "n": [len(s) for s in sets],
            "first": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first) if first else np.zeros(0, np.int64))), "sig": [signature(s) for s in sets],
            "mark": [mark(s) for s in sets],
        }, _HEADS)


def _places(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Task: places of its first shingles in the bitmap, packed by piece."""
    piece = min(_PIECE, bits)
    for batch in batches:
        at = np.sort(batch.column("first").flatten().to_numpy() & (bits - 1))
        names, starts = np.unique(at // piece, return_index=True)
        yield pa.RecordBatch.from_arrays([
            pa.array(names), pa.array([(x % piece).astype(np.uint32).tobytes() for x in np.split(at, starts[1:])] if len(at) else [], pa.binary()),
        ], names=["piece", "at"])


def _seen_twice(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Task: places of one piece that occur more than once, as bits."""
    counts = np.zeros(_PIECE, np.uint8)
    for at in table["at"].to_pylist():
        place, n = np.unique(np.frombuffer(at, np.uint32), return_counts=True)
        counts[place] = np.minimum(counts[place] + np.minimum(n, 2), 2)
    return pa.table({"piece": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(counts == 2, bitorder="little").tobytes()], pa.binary())})


def seen_twice(heads: DataFrame, bits: int | None = None) -> np.ndarray:
    """Bitmap of the first shingles that more than one text may have; the tasks make its pieces, the driver holds ``bits`` bits."""
    bits = bits or SEEN
    packed = heads.select("first").mapInArrow(lambda b: _places(b, bits), "piece long, at binary")
    out = np.zeros(max(bits // 8, _PIECE // 8), np.uint8)
    for row in packed.groupBy("piece").applyInArrow(_seen_twice, "piece long, bits binary").toLocalIterator():
        out[row["piece"] * (_PIECE // 8) : (row["piece"] + 1) * (_PIECE // 8)] = np.frombuffer(row["bits"], np.uint8)
    return out


def _keyed(batches: Iterator[pa.RecordBatch], twice) -> Iterator[pa.RecordBatch]:
    """Task: one row for each first shingle that may be in another text."""
    mask = min(SEEN, len(twice.value) * 8) - 1
    for batch in batches:
        first = batch.column("first")
        sizes = first.value_lengths().to_numpy().astype(np.int64)
        flat, row = first.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = flat & mask
        keep = np.flatnonzero(twice.value[place >> 3] >> (place & 7) & 1)
        yield pa.RecordBatch.from_arrays([
            pa.array(flat[keep]), pa.array(batch.column("fp").to_numpy()[row[keep]]), pa.array(batch.column("n").to_numpy()[row[keep]]), pa.array(at[keep].astype(np.int32)),
        ], schema=_KEYS)


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, sets in _sets(batches):
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array([_name(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))),
        ], names=["fp", "shingles"])


def _common(a: str, b: str) -> Column:
    """Least number of common shingles of similar sets, from the columns of their sizes."""
    top, whole = ALIKE
    return F.expr(f"(({a} + {b}) * {top} + {top + whole - 1}) div {top + whole}")


def _fits() -> Column:
    """Whether the shingles behind the places of a shared one can be enough."""
    return F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b")) >= _common("n", "n_b")


def _apart(a: Column, b: Column) -> Column:
    """Number of bits in which two signatures differ, in the width of the shorter one."""

    @F.pandas_udf("int")
    def run(xs: pd.Series, ys: pd.Series) -> pd.Series:
        x, y, out = xs.to_numpy(), ys.to_numpy(), np.zeros(len(xs), np.int32)
        width = np.minimum([len(s) for s in x], [len(s) for s in y]) if len(x) else out
        for size in np.unique(width).tolist():
            rows = np.flatnonzero(width == size)
            for at in range(0, len(rows), max(1, (1 << 22) // size)):
                some = rows[at : at + max(1, (1 << 22) // size)]
                out[some] = np.bitwise_count(folded(x[some].tolist(), size) ^ folded(y[some].tolist(), size)).sum(axis=1)
        return pd.Series(out)

    return run(a, b)


def _may_be_similar(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stored pairs ``a, b`` whose sizes and signatures allow them to be similar."""
    of = lambda c: nodes.select(F.col("fp").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"s_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    most = F.col("n_a") + F.col("n_b") - 2 * _common("n_a", "n_b")
    return stage(both.where(_apart(F.col("s_a"), F.col("s_b")) <= most).select("a", "b"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar."""
    of = lambda c, name: sets.select(F.col("fp").alias(c), F.col("shingles").alias(name))
    both = pairs.join(of("a", "s"), "a").join(of("b", "t"), "b")
    both = both.select("a", "b", F.size("s").alias("n"), F.size("t").alias("n_b"), F.size(F.array_intersect("s", "t")).alias("common"))
    return stage(both.where(F.col("common") >= _common("n", "n_b")).select("a", "b"))


def _whole_sets(rows: DataFrame, heads: DataFrame, pairs: DataFrame) -> DataFrame:
    """``fp, shingles`` of the nodes that are in a pair, made again from one text of each."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    chosen = stage(heads.select("fp", "doc_id", "row_key").join(wanted, "fp").groupBy("fp").agg(F.min(F.struct("doc_id", "row_key")).alias("row")).select("fp", "row.*"))
    # The texts to read again are found in the scan, by a bitmap of fixed size.
    place = F.xxhash64("doc_id", "row_key").bitwiseAND(F.lit(BITMAP - 1))
    words = chosen.select(place.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")).toArrow()
    bitmap = np.zeros(BITMAP >> 6, np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def probe(at: pd.Series) -> pd.Series:
        b = at.to_numpy()
        return pd.Series((shared.value[b >> 6] >> (b & 63)) & 1 == 1)

    again = rows.where(probe(place)).select("text").mapInArrow(_shingled, "fp long, shingles array<long>")
    sets = stage(again.join(chosen.select("fp"), "fp", "left_semi").dropDuplicates(["fp"]))
    shared.destroy()
    clear(chosen)
    return sets


def _crowded(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Two blocks of nodes of one shingle: pairs in different components that sizes, places and signatures allow."""
    top, whole = ALIKE
    low, high = key[1].as_py(), key[2].as_py()
    fp, n, at, root, block = (table[c].to_numpy() for c in ("fp", "n", "at", "root", "block"))
    sigs = table["sig"].to_pylist()
    width = np.array([len(s) for s in sigs])
    # For every width, the signatures that are at least as wide, folded to it.
    at_least = {w: np.flatnonzero(width >= w) for w in np.unique(width).tolist()}
    tables = {w: folded([sigs[i] for i in rows.tolist()], w) for w, rows in at_least.items()}
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    a, b = [], []
    for i in left.tolist():
        js = right[(fp[right] != fp[i]) & (root[right] != root[i]) & ((fp[right] < fp[i]) | (low != high))]
        least = (top * (n[i] + n[js]) + top + whole - 1) // (top + whole)
        js = js[np.minimum(n[i] - at[i], n[js] - at[js]) >= least]
        both = np.minimum(width[js], width[i])
        for w in np.unique(both).tolist():
            some = js[both == w]
            mine, others = (tables[w][np.searchsorted(at_least[w], x)] for x in (i, some))
            some = some[np.bitwise_count(others ^ mine).sum(axis=1) <= most_apart(n[i], n[some])]
            a.append(np.maximum(fp[some], fp[i]))
            b.append(np.minimum(fp[some], fp[i]))
    join = lambda xs: pa.array(np.concatenate(xs) if xs else np.zeros(0, np.int64), pa.int64())
    return pa.table({"a": join(a), "b": join(b)})


def _apart_pairs(met: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs ``a > b`` of nodes under one shingle that are in different components."""
    named = roots.select(F.col("node").alias("fp"), "root")
    labelled = stage(met.join(named, "fp", "left").select("key", "fp", "n", "at", F.coalesce("root", "fp").alias("root")))
    several = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).where("lo < hi").select("key", "size")
    apart = stage(labelled.join(several, "key"))
    clear(labelled)
    few = apart.where(F.col("size") <= BLOCK // 8)
    named = [F.col("fp").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), F.col("root").alias("root_b")]
    pairs = few.join(few.select("key", *named), "key").where((F.col("fp") > F.col("b")) & (F.col("root") != F.col("root_b")) & _fits())
    pairs = pairs.select(F.col("fp").alias("a"), "b")
    many = apart.where(F.col("size") > BLOCK // 8)
    if not many.isEmpty():
        blocks = F.expr(f"(size + {BLOCK - 1}) div {BLOCK}")
        dealt = many.join(nodes.select("fp", "sig"), "fp").withColumn("block", F.pmod(F.xxhash64("fp"), blocks)).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
        )
        cells = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).groupBy("key", "low", "high")
        pairs = pairs.unionByName(cells.applyInArrow(_crowded, "a long, b long"))
    return stage(pairs.distinct())


def marked_pairs(nodes: DataFrame) -> DataFrame:
    """For every node but the smallest of a mark one pair ``a, b`` with a node of a mark within two bits."""
    marks = stage(nodes.groupBy("mark").agg(F.min("fp").alias("one")))
    equal = nodes.join(marks, "mark").where("fp > one").select(F.col("fp").alias("a"), F.col("one").alias("b"))
    near = near_links(marks.select(F.col("mark").alias("fp"))).groupBy("a").agg(F.min("b").alias("b"))
    of = lambda c: marks.select(F.col("mark").alias(c), F.col("one").alias(f"one_{c}"))
    both = near.join(of("a"), "a").join(of("b"), "b")
    pairs = stage(equal.unionByName(both.select(F.greatest("one_a", "one_b").alias("a"), F.least("one_a", "one_b").alias("b"))))
    clear(marks)
    return pairs


def links(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Edges ``a > b`` that have the same components as all pairs of similar sets of ``heads``, made of ``rows``."""
    twice = heads.sparkSession.sparkContext.broadcast(seen_twice(heads))
    keyed = stage(heads.select("fp", "n", "first").mapInArrow(lambda b: _keyed(b, twice), "key long, fp long, n int, at int"))
    twice.destroy()
    nodes = stage(heads.groupBy("fp").agg(F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("mark").alias("mark")))
    least = keyed.groupBy("key").agg(F.min(F.struct("fp", "n", "at")).alias("one"), F.max("fp").alias("other")).where("one.fp < other")
    shared = least.select("key", F.col("one.fp").alias("b"), F.col("one.n").alias("n_b"), F.col("one.at").alias("at_b"))
    met = stage(keyed.join(shared, "key"))
    clear(keyed)
    star = met.where((F.col("fp") > F.col("b")) & _fits()).groupBy(F.col("fp").alias("a"), "b").agg(F.count("*").alias("both"))
    # A node is first compared with the one that it shares most first shingles with.
    best = star.groupBy("a").agg(F.max_by("b", F.struct("both", "b")).alias("b"))
    marked = marked_pairs(nodes)
    joined = _similar_pairs(best.unionByName(marked).distinct(), rows, heads, nodes)
    labels = stage(components(joined))
    for table in (joined, marked):
        clear(table)
    apart = _apart_pairs(met.drop("b", "n_b", "at_b"), labels, nodes)
    more = _similar_pairs(apart, rows, heads, nodes)
    for table in (met, nodes, apart):
        clear(table)
    return labels.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)


def _similar_pairs(pairs: DataFrame, rows: DataFrame, heads: DataFrame, nodes: DataFrame) -> DataFrame:
    """The stored pairs whose sets are similar."""
    likely = _may_be_similar(pairs, nodes)
    sets = _whole_sets(rows, heads, likely)
    found = _verified(likely, sets)
    for table in (likely, sets):
        clear(table)
    return found


def similar_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, row_key, fp, component_id`` of every row, ``fp`` telling sets of shingles apart."""
    rows = rows_of(docs, id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    often = rows.select("text").mapInArrow(_often, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    frequent = np.array([r["key"] for r in often.orderBy(F.desc("n"), "key").limit(FREQUENT).collect()], np.int64)
    last = np.sort(frequent)
    # The most frequent shingle stands at the very end.
    rank = len(frequent) - 1 - np.argsort(frequent, kind="stable")
    heads = stage(rows.mapInArrow(lambda b: _headed(b, last, rank), _HEAD_TYPES))
    return grouped(heads.select("doc_id", "row_key", "fp"), links(rows, heads))


def drop_similar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of every group of similar texts (its smallest id), columns unchanged."""
    return one_of_each(docs, similar_groups(docs, id_column, text_column), id_column, text_column)
