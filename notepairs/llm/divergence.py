"""Source divergence audit: how far the terms of the sources of a language lie from each other.

Terms are packed by length. A term of up to 8 bytes is one 64-bit word and one of up to 16
two, big end first and filled up with zeros; they are put in order by a radix sort of 16 bits
a pass and counted by runs. Longer terms go to buckets by length and are sorted as bytes.
A task counts about ``CHUNK`` bytes at a time, so terms move as counts.

Sources are compared in tiles: ``LANES`` sources of a language against ``LANES`` others over
a share of its terms, so a task holds neither all terms nor all sources. Terms that no source
of a tile has are the same for all of them and are added by their number.

All arithmetic is exact: shares by decimal division, the rest in 64-bit integers.

Defined cases: null text, language and source are the empty string; every row is a document,
a repeated one too; a text without a term leaves its group in the result; terms may be of any
length; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notepairs.llm.common import by_bytes, text_or_empty
from notepairs.session import clear, stage

#: Documents of a language that must hold a term.
MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
#: Bytes of text that a task counts at a time.
CHUNK = 12 << 20
#: Sources of a tile's side, and terms of a tile.
LANES = 64
TILE_TERMS = 4096
# Letters in lower case and bytes beyond ASCII; a space for all others.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows of 64-bit words, the first word counting most: 16 bits a pass, from the last."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                # numpy sorts 16-bit numbers by radix when asked for a stable order.
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(fresh: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rows, lengths and numbers of documents of the runs that start where ``fresh`` is set."""
    first = np.flatnonzero(fresh)
    other = fresh.copy()
    other[1:] |= doc[1:] != doc[:-1]
    return first, np.diff(np.append(first, len(fresh))), np.add.reduceat(other.astype(np.int64), first)


def _short(buffer: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray, group: np.ndarray, n_words: int):
    """Counts of terms of up to ``8 * n_words`` bytes: group, term, number, documents."""
    if not len(start):
        return
    at = np.ndarray((len(buffer) - 7,), ">u8", buffer, strides=(1,))
    words = []
    for i in range(n_words):
        spare = np.uint64(8) * (8 - np.clip(size - 8 * i, 1, 8)).astype(np.uint64)
        words.append((at[start + 8 * i].astype(np.uint64) >> spare) << spare)
    order = radix_order(words)
    words, d, g = [w[order] for w in words], doc[order], group[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = g[1:] != g[:-1]
    for w in words:
        fresh[1:] |= w[1:] != w[:-1]
    first, n, docs = _runs(fresh, d)
    sizes = size[order[first]]
    raw = np.stack([w[first] for w in words], axis=1).astype(">u8").view(np.uint8).reshape(len(first), 8 * n_words)
    flat = raw[np.arange(8 * n_words) < sizes[:, None]]
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    yield g[first], pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(flat.tobytes())), n, docs


def _long(text: bytes, start: np.ndarray, size: np.ndarray, doc: np.ndarray, group: np.ndarray):
    """Counts of longer terms, bucket by bucket of like lengths, each sorted by bytes."""
    for bucket in np.unique(np.frexp(size.astype(float))[1]).tolist() if len(size) else []:
        mine = np.flatnonzero(np.frexp(size.astype(float))[1] == bucket)
        terms = [text[a : a + n] for a, n in zip(start[mine].tolist(), size[mine].tolist())]
        order = np.array(sorted(range(len(terms)), key=terms.__getitem__), np.int64)
        d, g = doc[mine][order], group[mine][order]
        fresh = np.array([True, *(terms[a] != terms[b] for a, b in zip(order[1:].tolist(), order[:-1].tolist()))])
        fresh[1:] |= g[1:] != g[:-1]
        first, n, docs = _runs(fresh, d)
        yield g[first], pa.array([terms[i].decode("utf-8", "replace") for i in order[first].tolist()], pa.string()), n, docs


def count_terms(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """Group, term, occurrences and documents, for UTF-8 ``texts`` in the order of their ``groups``."""
    text = b" ".join([*texts, b"        "]).translate(_FOLD) + b" " * 8
    buffer = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], buffer != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, size = edges[::2], edges[1::2] - edges[::2]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    doc = np.searchsorted(begins, start, "right") - 1
    group = groups[doc] if len(texts) else doc
    for low, high in ((0, 8), (8, 16)):
        pick = np.flatnonzero((size > low) & (size <= high))
        yield from _short(buffer, start[pick], size[pick], doc[pick], group[pick], high // 8)
    pick = np.flatnonzero(size > 16)
    yield from _long(text, start[pick], size[pick], doc[pick], group[pick])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Parts of the task's rows of about ``CHUNK`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for part in by_bytes(batch, "text", CHUNK):
            n = part.column("text").nbytes
            if held and size + n > CHUNK:
                yield held
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield held


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: counts of its terms by language and source."""
    for held in _chunks(batches):
        table = pa.Table.from_batches(held)
        names = pa.StructArray.from_arrays([table["lang"].combine_chunks(), table["source"].combine_chunks()], ["lang", "source"]).to_pylist()
        keys = sorted({(n["lang"], n["source"]) for n in names})
        at = {k: i for i, k in enumerate(keys)}
        group = np.array([at[n["lang"], n["source"]] for n in names], np.int64)
        order = np.argsort(group, kind="stable")
        texts = table["text"].cast(pa.binary()).to_pylist()
        lang, source = pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string())
        for g, term, n, docs in count_terms([texts[i] for i in order.tolist()], group[order]):
            for a in range(0, len(g), 1 << 16):
                cut = slice(a, a + (1 << 16))
                own = pa.array(g[cut])
                yield pa.RecordBatch.from_arrays([lang.take(own), source.take(own), term[cut], pa.array(n[cut]), pa.array(docs[cut])], schema=_COUNTS)


def _share(count: str, total: str, terms: str) -> Column:
    """A term's share in billionths, rounded down, plus one; both counts smoothed by two."""
    return F.expr(
        f"CASE WHEN {terms} = 0 THEN 1L ELSE 1L + ((CAST({SCALE} AS DECIMAL(10, 0)) * (CAST({count} AS DECIMAL(19, 0)) + 2))"
        f" div (CAST({total} AS DECIMAL(19, 0)) + 2 * CAST({terms} AS DECIMAL(19, 0)))) END"
    )


def _apart(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _tile(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One tile: sums over its terms for every pair of a source of either side."""
    lang, low, high, _ = (k.as_py() for k in key)
    place, p = table["place"].to_numpy(), table["p"].to_numpy()
    term = table["term"].combine_chunks().dictionary_encode()
    term = term.chunk(0) if isinstance(term, pa.ChunkedArray) else term
    blank = term.is_null().to_numpy(zero_copy_only=False)
    lanes, lane = np.unique(place, return_inverse=True)
    floor = np.zeros(len(lanes), np.int64)
    floor[lane[blank]] = p[blank]
    seen = len(term.dictionary)
    shares = np.repeat(floor[:, None], seen, axis=1)
    shares[lane[~blank], term.indices.drop_null().to_numpy()] = p[~blank]
    side = lanes // LANES
    out: dict[str, list] = {"a": [], "b": [], "value": [], "base": []}
    for i in np.flatnonzero(side == low).tolist():
        others = np.flatnonzero((side == high) & (lanes > lanes[i]))
        gap, both = shares[others] - shares[i], shares[others] + shares[i]
        zero = (floor[others] - floor[i]) ** 2 // np.maximum(floor[others] + floor[i], 1)
        out["a"] += [int(lanes[i])] * len(others)
        out["b"] += lanes[others].tolist()
        out["value"] += (gap * gap // both).sum(axis=1).tolist()
        out["base"] += zero.tolist()
    n = len(out["a"])
    return pa.table({
        "lang": pa.array([lang] * n, pa.string()), "a": pa.array(out["a"], pa.int64()), "b": pa.array(out["b"], pa.int64()),
        "value": pa.array(out["value"], pa.int64()), "base": pa.array(out["base"], pa.int64()), "seen": pa.array([seen] * n, pa.int64()),
    })


def divergence(docs: DataFrame, *, text_column: str = "text", lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair`` has every other source of the language, part ``term`` the first ``TOP``
    terms that the source uses more than the language does.
    """
    name = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    read = docs.select(name(lang_column).alias("lang"), name(source_column).alias("source"), text_or_empty(docs, text_column).alias("text"))
    counted = stage(read.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    ))
    kept = stage(counted.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= MIN_DOCS).drop("docs"))
    own = stage(counted.drop("docs").join(kept, ["lang", "term"]))
    clear(counted)
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_size"))
    sizes = own.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = read.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["size", "terms", "lang_size"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    groups = groups.withColumn("place", place).withColumn("blocks", F.expr(f"(count(*) OVER (PARTITION BY lang) + {LANES - 1}) div {LANES}"))
    groups = stage(groups.withColumn("p", _share("0", "size", "terms")).withColumn("shards", F.expr(f"terms div {TILE_TERMS} + 1")))
    shared = own.join(groups.drop("p"), ["lang", "source"]).withColumn("p", _share("n", "size", "terms"))

    value = shared.withColumn("q", _share("total", "lang_size", "terms")).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart("p", "q").alias("value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = value.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= TOP)

    entries = shared.select("lang", "place", "blocks", "term", "p", F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"))
    blanks = groups.select("lang", "place", "blocks", F.lit(None).cast("string").alias("term"), "p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    mine = F.expr(f"place div {LANES}")
    tiled = entries.unionByName(blanks).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "lang", F.least(mine, F.col("other")).alias("low"), F.greatest(mine, F.col("other")).alias("high"), "shard", "place", "term", "p"
    )
    tiles = tiled.groupBy("lang", "low", "high", "shard").applyInArrow(_tile, "lang string, a long, b long, value long, base long, seen long")
    sums = tiles.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.max("base").alias("base"), F.sum("seen").alias("seen"))
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("e"), "value", "base", "seen")
    names = groups.select("lang", F.col("place").alias("x"), "source", "terms")
    others = groups.select("lang", F.col("place").alias("y"), F.col("source").alias("item"))
    pairs = both.select("lang", "e.*", "value", "base", "seen").join(names, ["lang", "x"]).join(others, ["lang", "y"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.expr("value + (terms - seen) * base").alias("value")
    )
    return terms.unionByName(pairs.withColumn("rank", F.row_number().over(by_value)))
