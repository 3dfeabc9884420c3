"""Dictionary concepts in texts: exact and near matches, sets, precision and recall."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from notepairs import constants as C
from notepairs.functions.text import settle
from notepairs.operators.tokens import PIECE_BYTES, GramOrder, Words, gram_numbers, gram_sets, jaccard, pieces, slice_hashes, strings, text_hashes, words_of
from notepairs.session import spread, stage

SIEVE_BITS = 1 << 28  # 32 MB, whatever the number of names
GRAM_SIEVE_BITS = 1 << 26  # 8 MB
KNOWN_GRAM_BITS = 1 << 20
# Thresholds from here on are served by whole parts of gram sets.
PART_THRESHOLD = 0.8
_GRAM_STEP, _SIZE_STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
SIEVE_CHUNKS = 256  # a bitmap is put together in as many pieces
# How many gram counts a task holds at most. They only order the grams: with more frequent
# grams than this the result is the same, but more windows pass the sieve.
FREQUENT_GRAMS = 1 << 14
# Windows that are compared or written out at a time, and pairs of windows and names, few enough to stay in a core's cache.
WINDOWS = 1 << 14
PAIRS = 1 << 16
# Names, and code points of names, that a task holds at a time below PART_THRESHOLD.
NAME_BLOCK, NAME_CHARS = 1 << 15, 1 << 20
# Bytes of text that meet a block of names at a time there, and into how many tasks for each core they are dealt.
MET_BYTES, MET_TASKS = 1 << 17, 4
# Bytes of text at most for which a block of names is put in order, where there are several.
HELD_BYTES = 1 << 22
# Words of 64 bits of a signature of a gram set.
SIGNATURE = 2
# Sizes of gram sets up to here are a class each; beyond, so many classes share an octave.
SIZES, OCTAVE = 16, 8


def concept_table(names: DataFrame, types: DataFrame) -> DataFrame:
    """Names with the sorted semantic types of their concept."""
    grouped = types.groupBy("cui").agg(F.array_sort(F.collect_set("type_id")).alias("type_ids"))
    return names.join(grouped, "cui").select("cui", "name", "type_ids")


def of_types(df: DataFrame, types: Sequence[str], column: str = "type_ids") -> DataFrame:
    """Rows with at least one of the types."""
    return df.filter(F.arrays_overlap(column, F.array(*[F.lit(t) for t in types])))


def code_map(codes: DataFrame) -> DataFrame:
    """One code per concept: that of its last line."""
    return codes.groupBy("cui").agg(F.max_by("code", F.struct("line_no", "code")).alias("code"))


def normal_name(name: Column) -> Column:
    """Lower-case words joined by one space, as windows are."""
    return F.array_join(F.regexp_extract_all(F.lower(name), F.lit(r"[\p{L}\p{N}]+"), 0), " ")


def bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """Bits set at the numbers in ``places.b``, as 64-bit words.

    Made in ``SIEVE_CHUNKS`` pieces by the tasks; the driver holds ``bits`` bits.
    """
    words = max(1, bits // 64 // SIEVE_CHUNKS)

    def piece(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        at = table["b"].to_numpy() % (words * 64)
        out = np.zeros(words, dtype="int64")
        np.bitwise_or.at(out, at >> 6, np.int64(1) << (at & 63))
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "words": pa.array([out.tobytes()], pa.binary())})

    chunks = places.select("b").distinct().withColumn("chunk", F.floor(F.col("b") / (words * 64)).cast("long"))
    whole = np.zeros(bits // 64, dtype="int64")
    for row in chunks.groupBy("chunk").applyInArrow(piece, "chunk long, words binary").collect():
        whole[row["chunk"] * words : (row["chunk"] + 1) * words] = np.frombuffer(row["words"], dtype="int64")
    return whole


def _bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes.astype(np.uint64) & np.uint64(bits - 1)).astype(np.int64)


def _set(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bits at these places are set."""
    return (words[at >> 6] >> (at & 63)) & 1 == 1


def _hash_places(texts: DataFrame, bits: int) -> DataFrame:
    """Places ``b`` of the texts ``norm`` in a bitmap of ``bits`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_bits(text_hashes(batch.column("norm").to_pylist()), bits))], names=["b"])

    return texts.select("norm").mapInArrow(run, "b long")


def name_sieve(names: DataFrame, *, bits: int = SIEVE_BITS) -> Callable[[np.ndarray], np.ndarray]:
    """Test of ``slice_hashes`` that holds for every ``names.norm`` and for few other texts.

    Its bitmap has a fixed size whatever the number of names, so every task can hold it.
    """
    shared = names.sparkSession.sparkContext.broadcast(bitmap(_hash_places(names, bits), bits))
    return lambda hashes: _set(shared.value, _bits(hashes, bits))


def _typed(df: DataFrame, columns: str, key: str) -> StructType:
    """The key as it is, then the given columns."""
    return StructType([df.schema[key], *StructType.fromDDL(columns).fields])


def _rows(batch: pa.RecordBatch, key: str, words: Words, first: np.ndarray, last: np.ndarray, *more: pa.Array) -> pa.RecordBatch:
    """Windows as rows: key of the text, offsets, words, and further columns."""
    return pa.RecordBatch.from_arrays([
        batch.column(key).take(pa.array(words.row[first])), pa.array(words.start[first].astype(np.int32)), pa.array(words.end[last].astype(np.int32)),
        pa.array(words.texts(first, last), pa.string()), *more,
    ], names=[key, "start_at", "end_at", "norm", *(f"x{i}" for i in range(len(more)))])


def _parts_of(batches: Iterator[pa.RecordBatch], limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that what is held of one does not grow with their rows."""
    for batch in batches:
        yield from pieces(batch, "_text", limit)


def windows(texts: DataFrame, passes: Callable[[np.ndarray], np.ndarray] | None = None, *, key: str = "pair_id", text: str = "text", longest: int = C.MAX_WINDOW) -> DataFrame:
    """Runs of up to ``longest`` words whose hash passes: (key, start_at, end_at, norm)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts_of(batches):
            words = words_of(part.column("_text").to_pylist())
            for size in range(1, longest + 1):
                first, last = words.windows(size)
                if passes is not None:
                    keep = passes(slice_hashes(words.chars, words.first[first], words.last[last]))
                    first, last = first[keep], last[keep]
                for at in range(0, len(first), WINDOWS):
                    yield _rows(part, key, words, first[at : at + WINDOWS], last[at : at + WINDOWS])

    return texts.select(key, F.col(text).alias("_text")).mapInArrow(run, _typed(texts, "start_at int, end_at int, norm string", key))


def match_exact(
    texts: DataFrame, concepts: DataFrame, *, key: str = "pair_id", text: str = "text",
    types: Sequence[str] | None = None, longest: int = C.MAX_WINDOW,
) -> DataFrame:
    """Mentions whose words equal a concept name.

    Windows that cannot be a name are dropped by their hashes, before they are written out
    and joined by name.
    """
    gated = of_types(concepts, types) if types else concepts
    entries = stage(gated.withColumn("norm", normal_name(F.col("name"))))
    found = windows(spread(texts), name_sieve(entries), key=key, text=text, longest=longest).join(entries, "norm")
    return found.select(key, "start_at", "end_at", "cui", F.col("name").alias("detected_name"), "type_ids")


def anchors(entries: DataFrame) -> DataFrame:
    """Entries with the rarest word of their name, ``anchor``, and its place ``at`` among the name's ``words``.

    Rare is the word that few names hold; ties go to the smaller word, then the first place.
    """
    worded = entries.withColumn("words", F.split("norm", " "))
    held = worded.select("norm", "words").distinct().select(F.explode(F.array_distinct("words")).alias("anchor")).groupBy("anchor").agg(F.count("*").alias("names"))
    placed = worded.select("norm", F.posexplode("words").alias("at", "anchor")).distinct()
    best = placed.join(held, "anchor").groupBy("norm").agg(F.min(F.struct("names", "anchor", "at")).alias("best"))
    return worded.join(best, "norm").select(*worded.columns, "best.anchor", "best.at")


def anchored_words(texts: DataFrame, anchor_words: DataFrame, *, key: str = "pair_id", text: str = "text", longest: int = C.MAX_WINDOW) -> DataFrame:
    """Places of ``anchor_words.norm`` in the texts: (key, anchor, before, after, starts, ends).

    ``before`` and ``after`` are up to ``longest - 1`` neighbours, nearest first, and
    ``starts`` and ``ends`` the offsets of the word and of these neighbours.
    """
    passes, reach = name_sieve(anchor_words), longest - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts_of(batches):
            words = words_of(batch.column("_text").to_pylist())
            hits = np.flatnonzero(passes(slice_hashes(words.chars, words.first, words.last)))
            columns = []
            for step in (-1, 1):
                near = hits[:, None] + step * np.arange(1, reach + 1)
                inside = (near >= 0) & (near < len(words.row))
                near = np.clip(near, 0, max(len(words.row) - 1, 0))
                inside &= words.row[near] == words.row[hits][:, None] if len(hits) else inside
                flat, ends = near[inside], pa.array(np.concatenate([[0], np.cumsum(inside.sum(axis=1))]).astype(np.int32))
                offsets = words.start if step < 0 else words.end
                columns += [pa.ListArray.from_arrays(ends, pa.array(words.texts(flat, flat), pa.string())), pa.ListArray.from_arrays(ends, pa.array(offsets[flat].astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([
                batch.column(key).take(pa.array(words.row[hits])), pa.array(words.start[hits].astype(np.int32)), pa.array(words.end[hits].astype(np.int32)),
                pa.array(words.texts(hits, hits), pa.string()), *columns,
            ], names=[key, "start_at", "end_at", "anchor", "before", "starts", "after", "ends"])

    columns = "start_at int, end_at int, anchor string, before array<string>, starts array<int>, after array<string>, ends array<int>"
    return texts.select(key, F.col(text).alias("_text")).mapInArrow(run, _typed(texts, columns, key))


def match_anchored(
    texts: DataFrame, concepts: DataFrame, *, key: str = "pair_id", text: str = "text", types: Sequence[str] | None = None, longest: int = C.MAX_WINDOW,
) -> DataFrame:
    """The mentions of ``match_exact``, found by an index of the names' rarest words.

    Only words that are some name's rarest word enter the join; the rest of the name is then
    compared with the neighbours. With names of many words, and rare ones among them, this
    moves far fewer rows than all windows that are names.
    """
    gated = of_types(concepts, types) if types else concepts
    entries = gated.withColumn("norm", normal_name(F.col("name"))).where(F.col("norm") != "")
    index = stage(anchors(entries).where(F.size("words") <= longest))
    places = anchored_words(spread(texts), index.select(F.col("anchor").alias("norm")), key=key, text=text, longest=longest)
    met = places.join(index, "anchor")
    rest = F.size("words") - F.col("at") - 1
    before = F.reverse(F.slice("words", F.lit(1), F.col("at")))
    after = F.slice("words", F.col("at") + 2, rest)
    same = (F.slice("before", F.lit(1), F.col("at")) == before) & (F.slice("after", F.lit(1), rest) == after)
    begin = F.when(F.col("at") == 0, F.col("start_at")).otherwise(F.get("starts", F.col("at") - 1))
    end = F.when(rest == 0, F.col("end_at")).otherwise(F.get("ends", rest - 1))
    return met.where(same).select(key, begin.alias("start_at"), end.alias("end_at"), "cui", F.col("name").alias("detected_name"), "type_ids")


def mention_texts(mentions: DataFrame, texts: DataFrame, *, key: str = "pair_id", text: str = "text") -> DataFrame:
    """Add the matched piece of the source text as ``source_value``."""
    joined = mentions.join(texts.select(key, F.col(text).alias("_text")), key)
    return joined.withColumn(
        "source_value", F.substring("_text", F.col("start_at") + 1, F.col("end_at") - F.col("start_at"))
    ).drop("_text")


def grams(norm: Column, n: int = 3) -> Column:
    """Distinct character runs of length ``n``; shorter texts are their only run."""
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(norm) - n + 1, F.lit(1))), lambda i: F.substring(norm, i, F.lit(n))
    )
    return F.array_distinct(runs)


def gram_order(names: DataFrame) -> GramOrder:
    """The order of grams that ``names.norm`` gives, from a bounded number of frequent ones."""
    counts = names.select(F.explode(grams(F.col("norm"))).alias("g")).groupBy("g").count()
    return GramOrder([r["g"] for r in counts.orderBy(F.desc("count"), "g").limit(FREQUENT_GRAMS).collect()])


_NONE = np.iinfo(np.int64).max


def _mixed(values: np.ndarray) -> np.ndarray:
    h = values.astype(np.uint64) * np.uint64(_GRAM_STEP)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(_SIZE_STEP)
    return h ^ (h >> np.uint64(29))


class _Parts:
    """Keys of the parts of a set: its grams dealt by a hash into one part more than sets may differ in grams.

    Each gram that only one of two sets has spoils one part, so two sets that reach the
    threshold agree in a whole part, which the sum of its grams' hashes stands for.
    """

    def __init__(self, threshold: float):
        self.threshold = threshold

    def parts(self, size: int) -> int:
        t = self.threshold
        fits = range(max(int(np.ceil(t * size - 1e-9)), 1), int(np.floor(size / t + 1e-9)) + 1)
        return 1 + max(n + size - 2 * int(np.ceil(t * (n + size) / (1 + t) - 1e-9)) for n in fits)

    def part(self, mixed: np.ndarray, parts: int) -> np.ndarray:
        """Which of ``parts`` parts grams belong to, by their hashes."""
        return (mixed >> np.uint64(40)) % np.uint64(parts)

    def key(self, sums: np.ndarray, size: int, i: int) -> np.ndarray:
        """Keys of part ``i`` of sets that meet sets of ``size`` grams."""
        return _mixed(sums + np.uint64(size << 8) + np.uint64(i << 40))

    def keys(self, table: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys of sets that meet sets of their own size."""
        for one in np.unique(n).tolist():
            rows = np.flatnonzero(n == one)
            grams = table[rows]
            mixed = np.where(grams == _NONE, np.uint64(0), _mixed(grams))
            p = self.parts(one)
            part = self.part(mixed, p)
            out = np.empty((len(n), p), np.uint64)
            for i in range(p):
                out[rows, i] = self.key((mixed * (part == i)).sum(axis=1, dtype=np.uint64), one, i)
            used = np.zeros((len(n), p), bool)
            used[rows] = True
            yield out, used


class _PartSums:
    """Hash sums over the parts of the gram sets of slices that may overlap, without a table of the sets.

    A slice's sum is the difference of two running sums over all grams, less what the slice
    holds again; ``n`` are the sizes of the sets.
    """

    def __init__(self, chars: np.ndarray, first: np.ndarray, last: np.ndarray):
        grams = gram_numbers(chars)
        # A slice of fewer than three code points is its own only gram, which stands behind the others.
        short = np.flatnonzero(last - first < 3)
        bits = 21 * (3 - (last - first)[short].astype(np.int64))
        self.begin, self.end = first.astype(np.int64), last.astype(np.int64) - 2
        self.begin[short] = len(grams) + np.arange(len(short))
        self.end[short] = self.begin[short] + 1
        grams = np.concatenate([grams, (grams[first[short]] >> bits) << bits])
        self.mixed = _mixed(grams)
        by = np.argsort(grams, kind="stable")
        again = np.flatnonzero(grams[by[1:]] == grams[by[:-1]])
        before = np.full(len(grams), -1, np.int64)
        before[by[again + 1]] = by[again]
        places = np.flatnonzero(before >= np.arange(len(grams)) - int((self.end - self.begin).max(initial=0)))
        start = np.searchsorted(places, self.begin)
        count = np.searchsorted(places, self.end) - start
        row = np.repeat(np.arange(len(first)), count)
        place = places[np.arange(len(row)) + np.repeat(start - (np.cumsum(count) - count), count)]
        inside = before[place] >= self.begin[row]
        self.place = place[inside]
        self.stop = np.cumsum(np.bincount(row[inside], minlength=len(first)))
        self.n = self.end - self.begin - np.diff(self.stop, prepend=0)

    def lacking(self, known: np.ndarray) -> np.ndarray:
        """How many grams of each slice's set are not in the bitmap ``known``."""
        new = ~_set(known, _bits(self.mixed, KNOWN_GRAM_BITS))
        once, twice = (np.concatenate([[0], np.cumsum(x)]) for x in (new, new[self.place]))
        return once[self.end] - once[self.begin] - np.diff(twice[self.stop], prepend=0)

    def of(self, scheme: _Parts, parts: int, rows: np.ndarray) -> np.ndarray:
        """Sums of every part of the sets of the slices ``rows``."""
        begin, end, stop = self.begin[rows], self.end[rows], self.stop[rows]
        start = np.where(rows > 0, self.stop[rows - 1], 0)
        # Only what these slices cover is summed.
        n = len(self.mixed)
        covered = np.cumsum(np.bincount(begin, minlength=n + 1) - np.bincount(end, minlength=n + 1))[:n] > 0
        number = np.concatenate([[0], np.cumsum(covered)])
        mixed, again = self.mixed[covered], self.mixed[self.place]
        part, part_again, out = scheme.part(mixed, parts), scheme.part(again, parts), np.empty((parts, len(rows)), np.uint64)
        running = lambda values: np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        for i in range(parts):
            sums, twice = running(mixed * (part == i)), running(again * (part_again == i))
            out[i] = sums[number[end]] - sums[number[begin]] - (twice[stop] - twice[start])
        return out


def name_keys(names: DataFrame, scheme: _Parts) -> DataFrame:
    """Names under each of their keys: (k, size, right_norm), ``size`` being that of their gram set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, first, last = strings(batch.column("norm").to_pylist())
            for which, n, table in gram_sets(chars, first, last):
                for keys, used in scheme.keys(table, n):
                    row, at = np.nonzero(used)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[row, at].view(np.int64)), pa.array(n[row].astype(np.int32)), batch.column("norm").take(pa.array(which[row])),
                    ], names=["k", "size", "right_norm"])

    return names.select("norm").mapInArrow(run, "k long, size int, right_norm string")


def _met(chars: np.ndarray, first: np.ndarray, last: np.ndarray, scheme: _Parts, sizes: np.ndarray, bits: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Slices that share a key with some name, as far as the bitmap tells: their numbers, and lists of these keys.

    ``sizes`` are those of the names' gram sets, in order, and ``known`` is a bitmap of the
    names' grams: a slice with too many others is like no name.
    """
    slices, shared, t = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], scheme.threshold
    sets = _PartSums(chars, first, last)
    by = np.flatnonzero(sets.lacking(known) <= (1 - t) * sets.n + 1e-9)
    by = by[np.argsort(sets.n[by], kind="stable")]
    n = sets.n[by]
    # Slices whose sets may reach the threshold with a set of each size stand next to each other.
    begin, end = np.searchsorted(np.floor(n / t + 1e-9), sizes), np.searchsorted(np.maximum(np.ceil(t * n - 1e-9), 1), sizes, "right")
    parts = np.array([scheme.parts(size) for size in sizes.tolist()], np.int64)
    for p in np.unique(parts[begin < end]).tolist():
        met = np.flatnonzero((parts == p) & (begin < end))
        at = int(begin[met].min())
        rows = np.sort(by[at : int(end[met].max())])
        sums, place = sets.of(scheme, p, rows), np.zeros(len(sets.n), np.int64)
        place[rows] = np.arange(len(rows))
        for j in met.tolist():
            fits = by[begin[j] : end[j]]
            for i in range(p):
                keys = scheme.key(sums[i, place[fits]], int(sizes[j]), i)
                hit = _set(bits, _bits(keys, GRAM_SIEVE_BITS))
                slices.append(fits[hit])
                shared.append(keys[hit].view(np.int64))
    slices = np.concatenate(slices)
    by = np.argsort(slices, kind="stable")
    names, starts = np.unique(slices[by], return_index=True)
    ends = pa.array(np.append(starts, len(by)).astype(np.int32))
    return names, pa.ListArray.from_arrays(ends, pa.array(np.concatenate(shared)[by]))


def _candidates(texts: DataFrame, key: str, names: DataFrame, threshold: float, longest: int | None) -> tuple[DataFrame, DataFrame]:
    """Windows of ``texts`` that share a key with a name, and the names by key.

    Windows are (key, start_at, end_at, norm, ks), with the list of keys they share, which is
    null where an equal window nearby has it; with ``longest`` null, each whole text is a
    window as it is.
    """
    scheme = _Parts(threshold)
    by_key = stage(name_keys(names, scheme))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_bits(batch.column("k").to_numpy(), GRAM_SIEVE_BITS))], names=["b"])

    def gram_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, table in gram_sets(*strings(batch.column("norm").to_pylist())):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(_bits(_mixed(table[table != _NONE]), KNOWN_GRAM_BITS)))], names=["b"])

    share = names.sparkSession.sparkContext.broadcast
    bits = share(bitmap(by_key.select("k").mapInArrow(places, "b long"), GRAM_SIEVE_BITS))
    known = share(bitmap(names.select("norm").mapInArrow(gram_places, "b long"), KNOWN_GRAM_BITS))
    # Few: sizes of names, in grams.
    sizes = np.array(sorted(r["size"] for r in by_key.select("size").distinct().collect()), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts_of(batches):
            for shown in _shown(part.column("_text").to_pylist(), longest):
                hit, keys = _met(shown.chars, shown.first, shown.last, scheme, sizes, bits.value, known.value)
                found = shown.rows(part, key, hit, keys)
                equal = found.column("norm").dictionary_encode().indices.to_numpy()
                again = np.ones(len(hit), bool)
                again[np.unique(equal, return_index=True)[1]] = False
                yield found.set_column(found.num_columns - 1, "ks", keys.take(pa.array(np.arange(len(hit)), mask=again)))

    columns = "start_at int, end_at int, norm string, ks array<long>"
    return texts.select(key, "_text").mapInArrow(run, _typed(texts, columns, key)), by_key


class _Shown:
    """Some windows of a few texts as slices of code points; without ``words``, whole texts."""

    def __init__(self, words: Words | None, texts: list[str], first: np.ndarray, last: np.ndarray, chars: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.words, self.texts, self.of = words, texts, (first, last)
        at, to = (int(begin.min()), int(end.max())) if len(begin) else (0, 0)
        self.chars, self.first, self.last = chars[at:to], begin - at, end - at

    def written(self, which: np.ndarray) -> list[str]:
        first, last = (x[which] for x in self.of)
        return [self.texts[i] for i in first.tolist()] if self.words is None else self.words.texts(first, last)

    def offsets(self, batch: pa.RecordBatch, key: str, which: np.ndarray) -> list[pa.Array]:
        """Keys and offsets of these windows."""
        first, last = (x[which] for x in self.of)
        if self.words is None:
            return [batch.column(key).take(pa.array(first)), *[pa.nulls(len(which), pa.int32())] * 2]
        ends = (self.words.start[first], self.words.end[last])
        return [batch.column(key).take(pa.array(self.words.row[first])), *(pa.array(x.astype(np.int32)) for x in ends)]

    def rows(self, batch: pa.RecordBatch, key: str, which: np.ndarray, *more: pa.Array) -> pa.RecordBatch:
        """These windows as rows with further columns."""
        first, last = (x[which] for x in self.of)
        if self.words is not None:
            return _rows(batch, key, self.words, first, last, *more)
        none = pa.nulls(len(which), pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column(key).take(pa.array(first)), none, none, pa.array(self.written(which), pa.string()), *more], names=[key, "start_at", "end_at", "norm", *(f"x{i}" for i in range(len(more)))]
        )


def _shown(texts: list[str | None], longest: int | None) -> Iterator[_Shown]:
    """All windows of the texts, ``WINDOWS`` at a time."""
    if longest is None:
        chars, begin, end = strings(texts)
        for at in range(0, len(texts), WINDOWS):
            which = np.arange(at, min(at + WINDOWS, len(texts)))
            yield _Shown(None, texts, which, which, chars, begin[which], end[which])
        return
    words = words_of(texts)
    # Windows of all lengths that begin in one stretch of words, so that they share its grams.
    for at in range(0, len(words.row), step := max(1, WINDOWS // longest)):
        a = np.arange(at, min(at + step, len(words.row)))
        first = np.concatenate([a[: max(len(words.row) - size + 1 - at, 0)] for size in range(1, longest + 1)])
        last = first + np.repeat(np.arange(longest), [max(min(len(a), len(words.row) - size - at), 0) for size in range(longest)])
        one = words.row[first] == words.row[last]
        yield _Shown(words, texts, first[one], last[one], words.chars, words.first[first[one]], words.last[last[one]])


def _similarity(left: Column, right: Column) -> Column:
    """Jaccard of the gram sets of two texts."""

    @F.pandas_udf("double")
    def run(lefts: pd.Series, rights: pd.Series) -> pd.Series:
        return pd.Series(jaccard(lefts.to_list(), rights.to_list()))

    return run(left, right)


def _similar(sieved: DataFrame, by_key: DataFrame, threshold: float) -> DataFrame:
    """Pairs of distinct ``norm`` and name with their similarity, from what ``_candidates`` gives."""
    one = sieved.where("ks IS NOT NULL").groupBy("norm").agg(F.first("ks").alias("ks")).select(F.col("norm").alias("left_norm"), F.explode("ks").alias("k"))
    met = one.join(by_key.select("k", "right_norm"), "k").select("left_norm", "right_norm").distinct()
    scored = met.withColumn("similarity", _similarity(F.col("left_norm"), F.col("right_norm")))
    return settle(scored, "similarity").filter(F.col("similarity") >= threshold - 1e-12)


def _signatures(table: np.ndarray) -> np.ndarray:
    """Every gram of a set flips one bit of each word, so words differ in no more bits than the sets do in grams."""
    out = np.empty((SIGNATURE, len(table)), np.uint64)
    step = max(1, PAIRS // table.shape[1])
    for at in range(0, len(table), step):
        part = table[at : at + step]
        mixed, blank = _mixed(part), part == _NONE
        for i in range(SIGNATURE):
            bit = np.uint64(1) << (mixed >> np.uint64(30 + 8 * i) & np.uint64(63))
            bit[blank] = 0
            out[i, at : at + step] = np.bitwise_xor.reduce(bit, axis=1)
    return out


def _size_class(n: np.ndarray) -> np.ndarray:
    """Classes of sizes of gram sets, in their order."""
    beyond = SIZES + np.floor(OCTAVE * np.log2(np.maximum(n, 1) / SIZES) + 1e-9).astype(np.int64)
    return np.where(n <= SIZES, n, beyond)


class _Ranks:
    """Numbers of the grams of some names in an order of all grams, from zero; other grams stand before them."""

    def __init__(self, grams: np.ndarray, order: GramOrder):
        self.grams = np.unique(grams)
        self.rank = np.empty(len(self.grams), np.int64)
        self.rank[np.lexsort((self.grams, order.packed(self.grams)))] = np.arange(len(self.grams))

    def packed(self, grams: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, self.rank[at], -1 - grams)


@dataclass
class _Sized:
    """What windows of one class of sizes may meet: for each gram the names that have it among their first ones, by size."""

    width: int  # first grams of a window
    most: np.ndarray  # size of a name at most that a window may meet by its gram at each place
    start: np.ndarray  # where the names of each gram begin
    places: np.ndarray  # gram and size of a name as one number
    name: np.ndarray
    apart: np.ndarray  # bits in which words of signatures may differ
    word: np.ndarray  # first words of the names' signatures


class _NameIndex:
    """A block of names by the sizes of the sets that they may resemble and the first grams of theirs, rare ones first.

    Sets of ``n`` and ``m`` grams reach the threshold with ``common`` grams, which follow from
    ``n + m``. From the first gram on that both have, both have as many left, so it is one of
    the first ``n - common + 1`` of the one and ``m - common + 1`` of the other. For each
    class of ``n`` a name stands under those of its grams that can be such a one.
    """

    def __init__(self, norms: list[str], threshold: float, order: GramOrder):
        self.norms, self.threshold = norms, threshold
        slices = strings(norms)
        self.ranks = _Ranks(np.concatenate([table[table != _NONE] for _, _, table in gram_sets(*slices)]), order)
        self.n, self.signatures, found = np.zeros(len(norms), np.int64), np.zeros((SIGNATURE, len(norms)), np.uint64), []
        for which, n, table in gram_sets(*slices, self.ranks):
            self.n[which], self.signatures[:, which] = n, _signatures(table)
            row, at = np.nonzero(table != _NONE)
            found.append((table[row, at], which[row], at))
        gram, name, at = (np.concatenate(x) for x in zip(*found))
        by = np.argsort(name, kind="stable")
        self.sets, self.first = gram[by], np.cumsum(self.n) - self.n
        self._by_size(gram, name, at)

    def _by_size(self, gram: np.ndarray, name: np.ndarray, at: np.ndarray) -> None:
        t, m = self.threshold, self.n[name]
        self.step, self.sized = int(self.n.max()) + 1, {}
        # Sizes of windows that may meet a name by its gram at some place.
        low, high = np.maximum(np.ceil(t * m - 1e-9), 1), np.floor((m - at * (1 + t)) / t + 1e-6)
        by = np.flatnonzero(low <= high)
        by = by[np.argsort(gram[by] * self.step + m[by], kind="stable")]
        gram, name, m, begin, end = gram[by], name[by], m[by], _size_class(low[by]), _size_class(high[by])
        sizes = np.arange(1, int(high.max()) + 1)
        classes = _size_class(sizes)
        for one in np.unique(classes).tolist():
            here = np.flatnonzero((begin <= one) & (one <= end))
            if not len(here):
                continue
            n = int(sizes[classes == one][-1])
            width = n - int(np.ceil(t * n - 1e-9)) + 1
            places = gram[here] * self.step + m[here]
            self.sized[one] = _Sized(
                width, np.clip(np.floor((n - np.arange(width) * (1 + t)) / t + 1e-6), 0, self.step - 1).astype(np.int64),
                np.searchsorted(places, np.arange(len(self.ranks.grams)) * self.step), places, name[here].astype(np.int32),
                np.minimum((n + m[here]) * (1 - t) / (1 + t) + 1e-6, 64).astype(np.uint8), self.signatures[0, name[here]],
            )

    def _likely(self, sized: _Sized, rows: np.ndarray, table: np.ndarray, signatures: np.ndarray) -> Iterator[np.ndarray]:
        """Pairs of windows of one class of sizes and names that share a gram and whose signatures are near."""
        head = table[rows, : sized.width]
        known = np.flatnonzero(head.view(np.uint64) < np.uint64(len(self.ranks.grams)))
        gram, (row, at) = head.ravel()[known], np.divmod(known, head.shape[1])
        begin = sized.start[gram]
        count = np.searchsorted(sized.places, gram * self.step + sized.most[at], "right") - begin
        some = np.flatnonzero(count > 0)
        row, begin, count = rows[row[some]], begin[some], count[some]
        ends, start, word = np.cumsum(count), 0, signatures[0, row]
        while start < len(count):
            before = int(ends[start - 1]) if start else 0
            end = max(int(np.searchsorted(ends, before + PAIRS, "right")), start + 1)
            k = count[start:end]
            place = np.repeat(begin[start:end] - (ends[start:end] - k - before), k)
            place += np.arange(len(place))
            apart = np.bitwise_count(sized.word.take(place) ^ np.repeat(word[start:end], k))
            near = np.flatnonzero(apart <= sized.apart.take(place))
            w, place = row[start + np.searchsorted(ends[start:end], before + near, "right")], place[near]
            name = sized.name[place].astype(np.int64)
            for a, b in zip(signatures[1:], self.signatures[1:]):
                near = np.bitwise_count(a[w] ^ b[name]) <= sized.apart[place]
                w, name, place = w[near], name[near], place[near]
            yield w * len(self.norms) + name
            start = end

    def _common(self, table: np.ndarray, name: np.ndarray) -> np.ndarray:
        """How many grams of each row's set the set of a name has."""
        at = np.arange(int(self.n[name].max()))
        of = self.sets.take(self.first[name][:, None] + at, mode="clip")
        of[at >= self.n[name][:, None]] = _NONE
        both = np.concatenate([table, of], axis=1)
        both.sort(axis=1)
        return ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] != _NONE)).sum(axis=1)

    def near(self, shown: _Shown) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows and names that reach the threshold, by their numbers, with their similarity."""
        for which, n, table in gram_sets(shown.chars, shown.first, shown.last, self.ranks):
            signatures, classes, met = _signatures(table), _size_class(n), [np.zeros(0, np.int64)]
            by = np.argsort(classes, kind="stable")
            for rows in np.split(by, np.flatnonzero(np.diff(classes[by])) + 1):
                if (sized := self.sized.get(int(classes[rows[0]]))) is not None:
                    met += self._likely(sized, rows, table, signatures)
            pairs = np.unique(np.concatenate(met))
            # Names have at most so many grams as windows have, over the threshold.
            step = max(1, 16 * PAIRS // int(table.shape[1] * (1 + 1 / self.threshold) + 1))
            for i in range(0, len(pairs), step):
                w, name = np.divmod(pairs[i : i + step], len(self.norms))
                common = self._common(table[w], name)
                similarity = common / (n[w] + self.n[name] - common)
                reached = np.flatnonzero(similarity >= self.threshold - 1e-12)
                yield which[w[reached]], name[reached], similarity[reached]


def _packed(texts: DataFrame, key: str, limit: int) -> DataFrame:
    """``texts`` in rows of many, of about ``limit`` bytes, dealt to tasks anew: lists of their keys and texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts_of(batches, limit):
            ends = pa.array([0, part.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, part.column(c)) for c in (key, "_text")], names=["keys", "texts"])

    fields = [StructField("keys", ArrayType(texts.schema[key].dataType)), StructField("texts", ArrayType(StringType()))]
    return texts.select(key, "_text").mapInArrow(run, StructType(fields)).repartition(MET_TASKS * texts.sparkSession.sparkContext.defaultParallelism)


class _Entries:
    """Rows of a block of names: the different names, and the rows of each."""

    def __init__(self, rows: pa.StructArray):
        self.norm, *self.columns = rows.flatten()
        coded = self.norm.dictionary_encode()
        self.norms, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.by = np.argsort(codes, kind="stable")
        self.count = np.bincount(codes)
        self.first = np.cumsum(self.count) - self.count

    def of(self, name: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
        """The rows of these names: for each row which of ``name`` it belongs to, and the rows' columns."""
        k = self.count[name]
        each = np.repeat(np.arange(len(name)), k)
        at = pa.array(self.by[np.arange(len(each)) + np.repeat(self.first[name] - (np.cumsum(k) - k), k)])
        return each, [c.take(at) for c in self.columns]


def _near_names(texts: DataFrame, key: str, entries: DataFrame, threshold: float, longest: int | None) -> DataFrame:
    """Windows (as of ``_candidates``) with the ``entries`` whose ``norm`` they nearly equal: (key, start_at, end_at, similarity, the entry's other columns).

    For low thresholds, where nearly every window shares a first gram with many names: names
    are cut into blocks, every piece of text meets every block, and pairs are made, sieved
    and compared where they meet, so no pair that fails is ever a row, and those that reach
    the threshold are not moved again to find their entries.
    """
    entries = entries.where("norm IS NOT NULL")
    size = entries.agg(F.count("*").alias("n"), F.sum(F.length("norm")).alias("chars")).first()
    blocks = 1 + max(size["n"] // NAME_BLOCK, (size["chars"] or 0) // NAME_CHARS)
    others = [c for c in entries.columns if c != "norm"]
    block = F.pmod(F.xxhash64("norm"), F.lit(blocks)).alias("block")
    dealt = stage(entries.groupBy(block).agg(F.collect_list(F.struct("norm", *others)).alias("entries")))
    order = gram_order(entries.select("norm").distinct())
    held_bytes = MET_BYTES
    if blocks > 1:
        # Each row of texts meets one block after the other: longer rows, as far as that leaves some for every task.
        total = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
        held_bytes = max(MET_BYTES, min(HELD_BYTES, total // (MET_TASKS * texts.sparkSession.sparkContext.defaultParallelism)))
    packed = _packed(texts, key, held_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, given, index = None, None, None
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                if block != held:
                    held, given = block, _Entries(batch.column("entries")[i].values)
                    index = _NameIndex(given.norms, threshold, order)
                rows = pa.RecordBatch.from_arrays([batch.column(c)[i].values for c in ("keys", "texts")], names=[key, "_text"])
                for part in pieces(rows, "_text", MET_BYTES):
                    for shown in _shown(part.column("_text").to_pylist(), longest):
                        for which, name, similarity in index.near(shown):
                            each, columns = given.of(name)
                            yield pa.RecordBatch.from_arrays(
                                [*shown.offsets(part, key, which[each]), pa.array(similarity[each]), *columns],
                                names=[key, "start_at", "end_at", "similarity", *(f"x{j}" for j in range(len(columns)))],
                            )

    # Texts that meet several blocks are read once.
    met = (stage(packed) if blocks > 1 else packed).crossJoin(dealt)
    columns = [*_typed(texts, "start_at int, end_at int, similarity double", key).fields, *(entries.schema[c] for c in others)]
    return met.mapInArrow(run, StructType(columns))


def similar_names(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Pairs of ``left.norm`` and ``right.norm`` whose gram sets have Jaccard >= threshold.

    Exact set-similarity join. Sets that reach the threshold have sizes within a factor of
    it. For high thresholds they share a whole part of their grams: a bitmap of fixed size
    tells which parts any name has, so texts without one are dropped where they are made;
    the different pairs that meet under a part are compared by their whole sets. For low
    ones they share one of their first grams, rare ones first, and are compared where they
    meet. Grams are numbers, and all of this is done for whole batches of texts.
    """
    texts = left.select("norm").distinct().select(F.col("norm").alias("name"), F.col("norm").alias("_text"))
    names = right.select("norm").distinct()
    if threshold < PART_THRESHOLD:
        found = _near_names(texts, "name", names.withColumn("right_norm", F.col("norm")), threshold, None)
        return found.select(F.col("name").alias("left_norm"), "right_norm", "similarity")
    sieved, by_key = _candidates(texts, "name", names, threshold, None)
    return _similar(sieved, by_key, threshold)


def match_similar(
    texts: DataFrame, concepts: DataFrame, *, key: str = "pair_id", text: str = "text",
    threshold: float = C.MATCH_THRESHOLD, types: Sequence[str] | None = None, longest: int = C.MAX_WINDOW,
) -> DataFrame:
    """Mentions whose words nearly equal a concept name, with their similarity.

    Windows are made once and stored when they have passed the sieve; distinct ones are
    compared, and occurrences join the few that match, which are stored so that the planner
    knows how few they are. Below ``PART_THRESHOLD`` they are
    compared where they are made.
    """
    gated = of_types(concepts, types) if types else concepts
    entries = stage(gated.withColumn("norm", normal_name(F.col("name"))))
    given = spread(texts.select(key, F.col(text).alias("_text")))
    columns = [key, "start_at", "end_at", "cui", F.col("name").alias("detected_name"), "type_ids", "similarity"]
    if threshold < PART_THRESHOLD:
        return _near_names(given, key, entries.select("norm", "cui", "name", "type_ids"), threshold, longest).select(*columns)
    names, by_name = entries.select("norm").distinct(), entries.withColumnRenamed("norm", "right_norm")
    sieved, by_key = _candidates(given, key, names, threshold, longest)
    found = stage(sieved)
    hits = stage(_similar(found, by_key, threshold).join(by_name, "right_norm").withColumnRenamed("left_norm", "norm").drop("right_norm"))
    return found.select(key, "start_at", "end_at", "norm").join(hits, "norm").select(*columns)


#: For each text its mentions: start, end, concept, name, semantic types.
Extractor = Callable[[list[str]], list[list[tuple[int, int, str, str, Sequence[str]]]]]
_EXTRACTORS: dict[str, Extractor] = {}
_MENTION = "start_at int, end_at int, cui string, detected_name string, type_ids array<string>, source_value string, intact boolean"


def extract_mentions(
    texts: DataFrame, factory: Callable[[], Extractor], *, key: str = "pair_id", text: str = "text", batch_size: int = C.INFERENCE_BATCH, tasks: int | None = None,
) -> DataFrame:
    """Mentions that a caller's extractor finds: one row per mention, with the text it stands for.

    The extractor is built once per worker and gets batches of texts. Its offsets are checked:
    a mention outside its text or without any text has no ``source_value`` and is not
    ``intact``, so it can be counted and set aside instead of stopping the job. A null text
    has no mentions; an extractor that does not answer every text is an error.
    """
    token = uuid.uuid4().hex
    rows = texts.select(key, F.col(text).alias("_text")).where("_text IS NOT NULL")
    rows = rows.repartition(tasks) if tasks else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if token not in _EXTRACTORS:
            _EXTRACTORS.clear()
            _EXTRACTORS[token] = factory()
        for batch in batches:
            for at in range(0, batch.num_rows, batch_size):
                part = batch.slice(at, batch_size)
                given = part.column("_text").to_pylist()
                found = _EXTRACTORS[token](given)
                if len(found) != len(given):
                    raise ValueError(f"{len(given)} texts, {len(found)} answers")
                row = [i for i, ms in enumerate(found) for _ in ms]
                flat = [m for ms in found for m in ms]
                inside = [0 <= a < b <= len(given[i]) for i, (a, b, *_) in zip(row, flat)]
                yield pa.RecordBatch.from_arrays([
                    part.column(key).take(pa.array(row, pa.int64())), *(pa.array([m[j] for m in flat], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.string()))),
                    pa.array([list(m[4]) for m in flat], pa.list_(pa.string())),
                    pa.array([given[i][m[0] : m[1]] if ok else None for i, m, ok in zip(row, flat, inside)], pa.string()), pa.array(inside, pa.bool_()),
                ], names=[key, "start_at", "end_at", "cui", "detected_name", "type_ids", "source_value", "intact"])

    return rows.mapInArrow(run, _typed(texts, _MENTION, key))


def concept_sets(mentions: DataFrame, *, key: str = "pair_id") -> DataFrame:
    """Distinct concepts per text."""
    return mentions.select(key, "cui").distinct()


def concept_scores(
    evals: DataFrame, concepts: DataFrame, *, types: Sequence[str] = C.SCORE_TYPES, matcher: Callable[..., DataFrame] = match_similar, **match
) -> DataFrame:
    """Precision and recall of concept sets; one where a side has no concepts.

    Concepts are found by ``matcher``: near matches, or ``match_exact``. Every pair also
    brings one row without a concept along, so the pairs are read once.
    """
    side = lambda name, r, c: F.struct(F.col(name).alias("text"), F.lit(r).alias("r"), F.lit(c).alias("c"))
    pairs = stage(evals.select("pair_id", "reference", "candidate"))
    both = pairs.select("pair_id", F.inline(F.array(side("reference", 1, 0), side("candidate", 0, 1))))
    keyed = both.select(F.struct("pair_id", "r", "c").alias("key"), "text")
    found = matcher(keyed, concepts, key="key", types=types, **match).select("key.*", "cui")
    every = found.unionByName(pairs.select("pair_id", F.lit(0).alias("r"), F.lit(0).alias("c"), F.lit(None).cast("string").alias("cui")))
    flags = every.groupBy("pair_id", "cui").agg(F.max("r").alias("r"), F.max("c").alias("c"))
    counts = flags.groupBy("pair_id").agg(
        F.sum("r").alias("n_ref"), F.sum("c").alias("n_cand"), F.sum(F.col("r") * F.col("c")).alias("n_both")
    )
    ratio = lambda total: F.when(F.col(total) == 0, 1.0).otherwise(F.col("n_both") / F.nullif(F.col(total), F.lit(0)))
    return counts.select("pair_id", ratio("n_cand").alias("precision"), ratio("n_ref").alias("recall"))
