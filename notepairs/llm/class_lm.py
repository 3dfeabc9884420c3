"""Brown class-based bigrams: exchange clustering, transitions, emissions, text scores.

Texts become blocks of token numbers with the block's own word list, so that later steps
move words once per block and never a token. Every training word gets its neighbour
counts over the most frequent words. Exchange sweeps move all words at once to the class
under which their neighbours are likeliest, then re-estimate the classes, which only
raises the likelihood; a sweep sends class sums of a fixed size to the driver. A text's
probability is that of its class transitions, times that of each word in its class.
Unknown words are one type; the chance of meeting it after a class is learned from the
training words that occur once.

Defined cases: a null or empty text is the end token alone; without training texts every
token is unknown and has probability one; texts of any length are scored whole; repeated
rows are learned from and scored each; ties between classes go to the first; an empty table
gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notepairs.llm.common import by_bytes, record_batches, row_key, text_or_empty
from notepairs.session import stage

CLASSES = 64
SWEEPS = 5
#: Most frequent words that serve as contexts in the exchange.
CONTEXTS = 256
BLOCK_BYTES = 8 << 20
#: Tasks that share the blocks of a frequent word.
SALTS = 32
#: Weights of the mean profile in a class, of the class shares in a transition, and of the mean chance of unknown words.
PROFILE_WEIGHT, TRANSITION_WEIGHT, UNKNOWN_WEIGHT = 5.0, 20.0, 20.0
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The end token; no word is empty.
END = b""
_ONCE, _UNKNOWN = 128, 255

_BLOCKS = pa.schema([
    ("block", pa.int64()), ("words", pa.list_(pa.binary())), ("top", pa.list_(pa.binary())), ("top_n", pa.list_(pa.int64())), ("ids", pa.binary()),
    ("doc_id", pa.list_(pa.int64())), ("row_key", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("ends", pa.list_(pa.int64())),
])
_BLOCK_DDL = (
    "block long, words array<binary>, top array<binary>, top_n array<long>, ids binary, doc_id array<long>, row_key array<long>,"
    " held_out array<boolean>, ends array<long>"
)
#: One neighbour count of a word, one place of a word in a block, and what a block learns of its word.
_NEAR = np.dtype([("at", "<u2"), ("k", "<u4")])
_REF = np.dtype([("block", "<u4"), ("local", "<u4")])
_KNOWN = np.dtype([("local", "<u4"), ("n", "<u8"), ("cls", "u1")])
_WORDS = pa.schema([("word", pa.binary()), ("near", pa.binary()), ("refs", pa.binary())])
_WORD_DDL = "word binary, near binary, refs binary"
_TOKENS_AT_ONCE = 1 << 19


def _packed(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Consecutive runs of records as one binary value each."""
    ends = (np.asarray(offsets) * data.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])


def _unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All records of a binary column, and the row of each."""
    parts = column.to_pylist()
    rows = np.repeat(np.arange(len(parts)), [len(p) // kind.itemsize for p in parts])
    return np.frombuffer(b"".join(parts), kind), rows


def _numbered(batches: Iterator[pa.RecordBatch], contexts: int) -> Iterator[pa.RecordBatch]:
    """Task: blocks of texts as token numbers, with the block's most frequent words."""
    task, number = TaskContext.get().partitionId(), 0
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for part in by_bytes(batch, "text", BLOCK_BYTES):
            words: dict[bytes, int] = {END: 0}
            ids = array("I")
            ends = []
            for text in part.column("text").to_pylist():
                ids.extend([words.setdefault(t, len(words)) for t in text.encode("utf-8", "surrogatepass").translate(_LOWER).split()])
                ids.append(0)
                ends.append(len(ids))
            held = np.array(part.column("held_out").to_pylist(), bool)
            tokens, stops = np.frombuffer(ids, np.uint32), np.array(ends)
            n = np.bincount(tokens[np.repeat(~held, np.diff(stops, prepend=0))], minlength=len(words))
            names = list(words)
            top = np.argsort(-n, kind="stable")[: 4 * contexts]
            top = top[n[top] > 0].tolist()
            yield record_batches({
                "block": [(task << 12) + number], "words": [names], "top": [[names[i] for i in top]], "top_n": [n[top]],
                "ids": [pack.compress(tokens.tobytes())], "doc_id": [part.column("doc_id").to_pylist()],
                "row_key": [part.column("row_key").to_pylist()], "held_out": [held.tolist()], "ends": [ends],
            }, _BLOCKS)
            number += 1


def _tokens(ids: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(ids), np.uint32).astype(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch], frequent: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Task: per block and word its place, and the neighbours in training texts among the contexts.

    Place ``f`` holds left neighbours, place ``width + f`` right ones; the last place of
    each side stands for all other words. Every training token has one left neighbour, so
    the left counts sum up to the count of the word.
    """
    where = {w: i for i, w in enumerate(frequent)}
    width = len(frequent) + 1
    for batch in batches:
        for i in range(batch.num_rows):
            words = batch.column("words")[i].values
            context = np.array([where.get(w, width - 1) for w in words.to_pylist()])
            tokens, ends = _tokens(batch.column("ids")[i].as_py()), batch.column("ends")[i].values.to_numpy()
            held = batch.column("held_out")[i].values.to_numpy(zero_copy_only=False)
            trained = np.repeat(~held, np.diff(ends, prepend=0))
            left = np.concatenate([[0], tokens[:-1]])
            inner = trained & (tokens != 0)
            keys = np.concatenate([
                tokens[trained] * (2 * width) + context[left[trained]], tokens[inner] * (2 * width) + width + context[np.roll(tokens, -1)[inner]]
            ])
            keys, k = np.unique(keys, return_counts=True)
            near = np.empty(len(keys), _NEAR)
            near["at"], near["k"] = keys % (2 * width), k
            refs = np.empty(len(words), _REF)
            refs["block"], refs["local"] = batch.column("block")[i].as_py(), np.arange(len(words))
            offsets = np.searchsorted(keys, np.arange(len(words) + 1) * (2 * width))
            yield pa.RecordBatch.from_arrays([words, _packed(near, offsets), _packed(refs, np.arange(len(words) + 1))], schema=_WORDS)


def _merged(batches: Iterator[pa.RecordBatch], places: int) -> Iterator[pa.RecordBatch]:
    """Task: rows in the order of their word, one per block, become one row per word."""
    rest: pa.RecordBatch | None = None

    def merge(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = batch.column("word").to_pylist()
        new = np.array([i == 0 or w != words[i - 1] for i, w in enumerate(words)])
        group = np.cumsum(new) - 1
        near, row = _unpacked(batch.column("near"), _NEAR)
        keys, inverse = np.unique(group[row] * places + near["at"], return_inverse=True)
        sums = np.empty(len(keys), _NEAR)
        sums["at"], sums["k"] = keys % places, np.bincount(inverse, weights=near["k"], minlength=len(keys))
        refs, row = _unpacked(batch.column("refs"), _REF)
        groups = np.arange(group[-1] + 2)
        return pa.RecordBatch.from_arrays([
            batch.column("word").take(pa.array(np.flatnonzero(new))), _packed(sums, np.searchsorted(keys, groups * places)),
            _packed(refs, np.searchsorted(group[row], groups)),
        ], schema=_WORDS)

    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, _WORDS)], schema=_WORDS)
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        done = merge(batch)
        # The last word may go on in the next batch.
        rest = done.slice(done.num_rows - 1)
        if done.num_rows > 1:
            yield from by_bytes(done.slice(0, done.num_rows - 1), "refs", 4 << 20)
    if rest is not None:
        yield rest


def _one_row_each(pieces: DataFrame, frequent: list[bytes], places: int) -> DataFrame:
    """One stored row per word, from one per block and word.

    The frequent words, which nearly every block has, are merged in ``SALTS`` tasks each and
    then once more, so no task reads a row of every block.
    """
    merged = lambda df, *by: df.repartition(*by).sortWithinPartitions("word").select("word", "near", "refs").mapInArrow(lambda b: _merged(b, places), _WORD_DDL)
    if not frequent:
        return stage(merged(pieces, "word"))
    often = F.col("word").isin(*map(bytearray, frequent))
    parts = stage(merged(pieces.withColumn("salt", F.when(often, F.pmod(F.xxhash64("refs"), F.lit(SALTS))).otherwise(0)), "word", "salt").withColumn("often", often))
    hot = stage(merged(parts.where("often"), "word"))
    return parts.where("NOT often").select("word", "near", "refs").unionByName(hot)


def _counts(near: np.ndarray, row: np.ndarray, rows: int, places: int) -> np.ndarray:
    """Training count of every word of a batch: the sum of its left neighbours."""
    left = near["at"] < places // 2
    return np.bincount(row[left], weights=near["k"][left], minlength=rows).astype(np.int64)


def _sizes(batches: Iterator[pa.RecordBatch], places: int) -> Iterator[pa.RecordBatch]:
    """Task: training counts of the words."""
    for batch in batches:
        near, row = _unpacked(batch.column("near"), _NEAR)
        yield pa.RecordBatch.from_arrays([pa.array(_counts(near, row, batch.num_rows, places))], names=["n"])


def _best(near: np.ndarray, row: np.ndarray, rows: int, logs: np.ndarray) -> np.ndarray:
    """Class of every word of a batch: the one under which its neighbours are likeliest."""
    out = np.zeros(rows, np.int64)
    for start in range(0, rows, 2_000):
        lo, hi = np.searchsorted(row, [start, start + 2_000])
        if lo < hi:
            first = np.flatnonzero(np.diff(row[lo:hi], prepend=-1))
            gains = np.add.reduceat(logs[near["at"][lo:hi]] * near["k"][lo:hi, None].astype(np.float32), first, axis=0)
            out[row[lo:hi][first]] = gains.argmax(axis=1)
    return out


def _sums(batches: Iterator[pa.RecordBatch], logs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Task: neighbour counts of the classes that a sweep makes of its words."""
    places, classes = logs.shape
    total = np.zeros(classes * places)
    for batch in batches:
        near, row = _unpacked(batch.column("near"), _NEAR)
        cls = _best(near, row, batch.num_rows, logs)
        total += np.bincount(cls[row] * places + near["at"], weights=near["k"], minlength=classes * places)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at].astype(np.int64))], names=["at", "k"])


def _assigned(batches: Iterator[pa.RecordBatch], logs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Task: per block, packed, the counts and classes of its words."""
    for batch in batches:
        near, row = _unpacked(batch.column("near"), _NEAR)
        n, cls = _counts(near, row, batch.num_rows, len(logs)), _best(near, row, batch.num_rows, logs)
        refs, word = _unpacked(batch.column("refs"), _REF)
        trained = n[word] > 0
        refs, word = refs[trained], word[trained]
        order = np.argsort(refs["block"], kind="stable")
        refs, word = refs[order], word[order]
        known = np.empty(len(refs), _KNOWN)
        known["local"], known["n"], known["cls"] = refs["local"], n[word], cls[word]
        blocks, first = np.unique(refs["block"], return_index=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks.astype(np.int64)), _packed(known, np.append(first, len(refs)))], names=["block", "known"]
        )


def profile_logs(sums: np.ndarray) -> np.ndarray:
    """Log chances of every place, given the class, from class sums (classes, places)."""
    width = sums.shape[1] // 2
    out = np.zeros_like(sums, np.float64)
    for side in (slice(0, width), slice(width, 2 * width)):
        part = sums[:, side]
        mean = part.sum(axis=0) + 1e-3
        mean = mean / mean.sum()
        out[:, side] = np.log((part + PROFILE_WEIGHT * mean) / (part.sum(axis=1, keepdims=True) + PROFILE_WEIGHT))
    return out.T.astype(np.float32).copy()


def exchange(words: DataFrame, seeds: list[np.ndarray], places: int, *, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class sums (classes, places) after parallel exchange sweeps over a stored table of words.

    The words of ``seeds``, by their neighbour counts, start as classes of their own. The
    driver holds one number per class and place, whatever the number of words.
    """
    sums = np.zeros((classes, places))
    for c, near in enumerate(seeds[:classes]):
        sums[c, near["at"]] = near["k"]
    for _ in range(sweeps):
        logs = profile_logs(sums)
        parts = words.select("near").mapInArrow(lambda b, logs=logs: _sums(b, logs), "at long, k long")
        sums = np.zeros(classes * places)
        for row in parts.groupBy("at").agg(F.sum("k").alias("k")).collect():
            sums[row["at"]] = row["k"]
        sums = sums.reshape(classes, places)
    return sums


_TEXTS = pa.schema([
    ("doc_id", pa.int64()), ("row_key", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base_score", pa.float64()), ("emitted", pa.float64()), ("seq", pa.binary()),
])
_TEXT_DDL = "doc_id long, row_key long, held_out boolean, n_tokens long, n_known long, base_score double, emitted double, seq binary"


def _classed(batches: Iterator[pa.RecordBatch], total: int, distinct: int, class_n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Task: blocks with the counts and classes of their words become scored texts with class sequences."""
    for batch in batches:
        for i in range(batch.num_rows):
            size = batch.column("size")[i].as_py()
            n, cls = np.zeros(size), np.zeros(size, np.int64)
            known = np.frombuffer(b"".join(batch.column("known")[i].as_py() or []), _KNOWN)
            n[known["local"]], cls[known["local"]] = known["n"], known["cls"]
            base = np.log10((n + 0.5) / (total + 0.5 * (distinct + 1)))
            emitted = np.where(n > 0, np.log10(np.maximum(n, 1) / np.maximum(class_n[cls], 1)), 0.0)
            mark = np.where(n > 0, cls + np.where(n == 1, _ONCE, 0), _UNKNOWN).astype(np.uint8)
            tokens, ends = _tokens(batch.column("ids")[i].as_py()), batch.column("ends")[i].values.to_numpy()
            starts = np.concatenate([[0], ends[:-1]])
            seq = mark[tokens].tobytes()
            yield record_batches({
                "doc_id": batch.column("doc_id")[i].values, "row_key": batch.column("row_key")[i].values,
                "held_out": batch.column("held_out")[i].values, "n_tokens": pa.array(ends - starts),
                "n_known": pa.array(np.add.reduceat((n > 0)[tokens].astype(np.int64), starts)),
                "base_score": pa.array(np.add.reduceat(base[tokens], starts)), "emitted": pa.array(np.add.reduceat(emitted[tokens], starts)),
                "seq": [seq[a:b] for a, b in zip(starts.tolist(), ends.tolist())],
            }, _TEXTS)


def _steps(seq: np.ndarray, classes: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks before and at every token; each text starts after an end token."""
    return np.concatenate([[end], seq[:-1]]).astype(np.int64), seq.astype(np.int64)


def _class(marks: np.ndarray, classes: int) -> np.ndarray:
    return np.where(marks == _UNKNOWN, classes, marks & (_ONCE - 1))


def _transitions(batches: Iterator[pa.RecordBatch], classes: int, end: int) -> Iterator[pa.RecordBatch]:
    """Task: counts of class pairs; the last row follows words that occur once, the last column leads to them."""
    size = classes + 1
    total = np.zeros(size * size, np.int64)
    for batch in (part for whole in batches for part in by_bytes(whole, "seq", _TOKENS_AT_ONCE)):
        seq = np.frombuffer(b"".join(batch.column("seq").to_pylist()), np.uint8)
        before, now = _steps(seq, classes, end)
        for rows, chosen in ((_class(before, classes), slice(None)), (np.full(len(seq), classes), before >= _ONCE)):
            a, b, once = rows[chosen], _class(now, classes)[chosen], (now >= _ONCE)[chosen]
            total += np.bincount(a * size + b, minlength=size * size)
            total += np.bincount(a[once] * size + classes, minlength=size * size)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "k"])


def transition_logs(counts: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Log10 chances (classes + 1, classes + 1) of the next class; the last column is the unknown word."""
    known, once = counts[:, :-1], counts[:, -1]
    seen = known.sum(axis=1)
    if not seen.sum():
        return np.where(np.arange(counts.shape[1]) == counts.shape[1] - 1, 0.0, -300.0) * np.ones((len(counts), 1))
    mean = (once[:-1].sum() + 0.5) / (seen[:-1].sum() + 1)
    unknown = (once + UNKNOWN_WEIGHT * mean) / (seen + UNKNOWN_WEIGHT)
    unknown = np.minimum(unknown, 0.999)
    nexts = (known + TRANSITION_WEIGHT * shares) / (seen[:, None] + TRANSITION_WEIGHT)
    with np.errstate(divide="ignore"):
        logs = np.log10(np.concatenate([(1 - unknown)[:, None] * nexts, unknown[:, None]], axis=1))
    return np.maximum(logs, -300.0)


def _scored(batches: Iterator[pa.RecordBatch], logs: np.ndarray, end: int) -> Iterator[pa.RecordBatch]:
    classes = len(logs) - 1
    for batch in (part for whole in batches for part in by_bytes(whole, "seq", _TOKENS_AT_ONCE)):
        parts = batch.column("seq").to_pylist()
        seq = np.frombuffer(b"".join(parts), np.uint8)
        before, now = _steps(seq, classes, end)
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
        moved = np.add.reduceat(logs[_class(before, classes), _class(now, classes)], starts)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(moved + batch.column("emitted").to_numpy())], names=[*batch.schema.names[:-1], "score"]
        )


def score_texts(
    docs: DataFrame, *, held_out: Column, id_column: str = "doc_id", text_column: str = "text",
    classes: int = CLASSES, sweeps: int = SWEEPS, contexts: int = CONTEXTS,
) -> DataFrame:
    """``doc_id, row_key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The rows where ``held_out``, a condition on ``docs``, is not true are learned from.
    ``base_score`` is that of smoothed single tokens, ``score`` that of the class bigrams.
    """
    if not 0 < classes < _ONCE - 1:
        raise ValueError("classes must fit in seven bits")
    marked = docs.select(
        docs[id_column].cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_or_empty(docs, text_column).alias("text")
    )
    blocks = stage(marked.select("doc_id", row_key(F.col("text")).alias("row_key"), "held_out", "text").mapInArrow(lambda b: _numbered(b, contexts), _BLOCK_DDL))
    # Contexts are a model choice: sums over each block's most frequent words, a bounded number per block.
    tops = blocks.select(F.inline(F.arrays_zip("top", "top_n"))).groupBy("top").agg(F.sum("top_n").alias("n"))
    frequent = [bytes(r["top"]) for r in tops.orderBy(F.desc("n"), "top").limit(contexts).collect()]
    # Texts start after the end token, so its class must be at hand.
    frequent = [END] * bool(frequent) + [w for w in frequent if w != END][: contexts - 1]
    places = 2 * (len(frequent) + 1)
    pieces = blocks.select("block", "words", "ids", "held_out", "ends").mapInArrow(lambda b: _contexts(b, frequent), _WORD_DDL)
    words = _one_row_each(pieces, frequent, places)
    sizes = words.select("near").mapInArrow(lambda b: _sizes(b, places), "n long").where("n > 0").agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).first()
    total, distinct = sizes["total"] or 0, sizes["distinct"]
    first = {bytes(r["word"]): np.frombuffer(r["near"], _NEAR) for r in words.where(F.col("word").isin(*map(bytearray, frequent))).select("word", "near").collect()}
    sums = exchange(words, [first[w] for w in frequent], places, classes=classes, sweeps=sweeps)
    logs = profile_logs(sums)
    # The classes of a further sweep are the ones that count; their sizes follow from the same pass.
    known = stage(words.select("near", "refs").mapInArrow(lambda b: _assigned(b, logs), "block long, known binary"))
    final = words.select("near").mapInArrow(lambda b: _sums(b, logs), "at long, k long").where(F.pmod("at", F.lit(places)) < places // 2)
    class_n = np.zeros(classes)
    for row in final.groupBy(F.floor(F.col("at") / places).alias("cls")).agg(F.sum("k").alias("n")).collect():
        class_n[row["cls"]] = row["n"]
    end = int(_best(first[END], np.zeros(len(first[END]), np.int64), 1, logs)[0]) if END in first else _UNKNOWN
    per_block = known.groupBy("block").agg(F.collect_list("known").alias("known"))
    met = blocks.select("block", F.size("words").alias("size"), "ids", "doc_id", "row_key", "held_out", "ends").join(per_block, "block", "left").drop("block")
    texts = stage(met.mapInArrow(lambda b: _classed(b, total, distinct, class_n), _TEXT_DDL))
    pairs = texts.where("NOT held_out").select("seq").mapInArrow(lambda b: _transitions(b, classes, end), "at long, k long")
    counts = np.zeros((classes + 1) ** 2)
    for row in pairs.groupBy("at").agg(F.sum("k").alias("k")).collect():
        counts[row["at"]] = row["k"]
    logs = transition_logs(counts.reshape(classes + 1, classes + 1), class_n / max(class_n.sum(), 1))
    scored = texts.mapInArrow(lambda b: _scored(b, logs, end), _TEXT_DDL.replace("seq binary", "score double"))
    return scored.select(
        "doc_id", "row_key", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
