"""Topics by content: spherical k-means over hashed words of all documents, the nearest centre for every document.

A text's features are its words (runs of four letters or more, lower-case), hashed to ``DIMS`` numbers, by the logarithm
of their counts. All documents give each number its weight, by the share of them that have it; numbers of more than
``COMMON`` of the documents tell nothing and weigh nothing. Features are made once and kept in the shared folder, and so are their vectors
of unit length, in whole parts, which all rounds read. Centres
are drawn one by one, by the distance to the nearest one so far, among all documents, and every round moves them by all
documents. The driver holds ``DIMS`` numbers a centre. Sums are of whole numbers, so a run repeats exactly, whatever its partitions.

Defined cases: null and empty texts, and those without a telling word, have the topic ``none``, as have all if there is
nothing to learn from; equal texts have equal topics, and each of them counts. Words of different languages differ, so
that a topic mostly lies in one language.
"""

from __future__ import annotations

import math
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from sheafwork.llm.common import bounded_batches, durable, held, map_arrow

DIMS, TOPICS, COMMON, ROUNDS = 1024, 8, 0.2, 15
#: Parts of a unit that sums count in.
PARTS = 1 << 20
WORD = re.compile(r"[^\W\d_]{4,}")
NONE = "none"
#: Words whose number a worker remembers; beyond that, it starts afresh.
REMEMBERED = 200_000


#: ASCII letters in lower case; every other ASCII byte parts words, bytes of other characters are left for ``Numbers``.
_LETTERS = bytes(k if k >= 128 else ord(chr(k).lower()) if chr(k).isalpha() else 32 for k in range(256))
#: What stands for the number of a piece without a word, and of one with several.
_NO, _SEVERAL = DIMS, DIMS + 1


class Numbers(dict):
    """The number of the word in each piece of text between ASCII characters that are no letters, remembered."""

    def __missing__(self, piece: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        words = _words(piece)
        found = self[piece] = _NO if not words else _SEVERAL if len(words) > 1 else zlib.crc32(words[0].encode()) % DIMS
        return found


def _words(text: bytes) -> list[str]:
    return WORD.findall(text.decode(errors="replace").lower())


def _counted(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of each text, number, count) of the words of UTF-8 texts, texts and numbers in order."""
    known = held("words", None, Numbers).__getitem__
    sizes, numbers, counts = np.zeros(len(texts), np.int64), [], []
    for start in range(0, len(texts), 500):
        part, codes = texts[start : start + 500], []
        for text in part:
            own = list(map(known, text.translate(_LETTERS).split())) if text else []
            if _SEVERAL in own:
                pieces = zip(text.translate(_LETTERS).split(), own, strict=True)
                own = [m for piece, n in pieces for m in ([zlib.crc32(w.encode()) % DIMS for w in _words(piece)] if n == _SEVERAL else [n])]
            codes.append(own)
        flat = np.fromiter(chain.from_iterable(codes), np.int64, sum(map(len, codes)))
        flat += np.repeat(np.arange(len(part)) * (DIMS + 1), [len(x) for x in codes])
        table = np.bincount(flat, minlength=len(part) * (DIMS + 1)).reshape(len(part), DIMS + 1)[:, :DIMS]
        row, number = np.nonzero(table)
        sizes[start : start + len(part)] = np.bincount(row, minlength=len(part))
        numbers.append(number.astype(np.uint16))
        counts.append(table[row, number].astype(np.uint32))
    return sizes, *(np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((numbers, np.uint16), (counts, np.uint32)))


def counts(text: str | None) -> np.ndarray:
    """Logarithms of the counts of a text's hashed words."""
    _, number, count = _counted([None if text is None else text.encode()])
    out = np.zeros(DIMS, np.float32)
    out[number] = np.log1p(count)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=-1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def fit(sample: np.ndarray, topics: int = TOPICS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the numbers, and centres of unit length, at most ``topics``, of rows that one machine holds; for tables see ``learnt``."""
    share = (sample > 0).mean(axis=0) if len(sample) else np.zeros(DIMS)
    weight = np.where((share > 0) & (share <= COMMON), np.log(1 / np.maximum(share, 1e-9)), 0).astype(np.float32)
    x = _unit(sample * weight)
    x = np.unique(x[np.abs(x).sum(axis=1) > 0], axis=0)
    if not len(x):
        return weight, np.zeros((0, DIMS), np.float32)
    g = np.random.default_rng(seed)
    centres = x[[int(g.integers(len(x)))]]
    while len(centres) < min(topics, len(x)):  # the next centre: drawn by the distance to the nearest one so far
        far = np.maximum(0, 1 - (x @ centres.T).max(axis=1)).astype(np.float64)
        if far.sum() < 1e-6:
            break
        centres = np.vstack([centres, x[int(g.choice(len(x), p=far / far.sum()))]])
    for _ in range(ROUNDS):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(np.bincount(own, minlength=len(centres))[:, None] > 0, _unit(sums), centres)
    return weight, centres


def _binary(parts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary value for each text of what lies one after another."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * parts.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(parts))])


def features(docs: DataFrame, kept: list[str], more: tuple = ()) -> DataFrame:
    """The columns ``kept``, what ``more`` makes of the texts (name, type, function of a list of UTF-8 texts), and every
    text's draw (a hash from 0 to 1, the same for equal texts), numbers and counts."""
    text = F.col("text").cast("string")
    rows = docs.select(*kept, (F.xxhash64(text, F.lit("topics")) / float(1 << 64) + 0.5).alias("topic_draw"), text.cast("binary").alias("topic_text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        sizes, number, count = _counted(texts)
        columns = [*batch.columns[:-1], *[pa.array(f(texts), pa.int64()) for _, _, f in more], _binary(number, sizes), _binary(count, sizes)]
        return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *[name for name, _, _ in more], "topic_numbers", "topic_counts"])

    made = [*rows.schema.fields[:-1], *[StructField(name, kind) for name, kind, _ in more], StructField("topic_numbers", BinaryType()), StructField("topic_counts", BinaryType())]
    return map_arrow(rows, run, StructType(made))


def _told(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number, count) of the last two columns."""
    parts = batch.column(batch.num_columns - 2).to_pylist()
    number = np.frombuffer(b"".join(parts), np.uint16).astype(np.int64)
    return np.repeat(np.arange(len(parts)), [len(x) // 2 for x in parts]), number, np.frombuffer(b"".join(batch.column(batch.num_columns - 1).to_pylist()), np.uint32)


def _vectors(told: DataFrame, weight: np.ndarray) -> DataFrame:
    """A row for each batch of texts: draws, sizes, numbers and values of their vectors of unit length, in whole parts; texts without a telling number are left out."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, number, count = _told(batch)
        value = np.log1p(count) * weight[number]
        row, number, value = row[value > 0], number[value > 0], value[value > 0]
        parts = np.round(value / np.sqrt(np.bincount(row, value * value, batch.num_rows))[row] * PARTS).astype(np.int32)
        sizes = np.bincount(row, minlength=batch.num_rows)
        draws = batch.column(0).to_numpy()[sizes > 0]
        columns = [draws, sizes[sizes > 0].astype(np.int32), number.astype(np.uint16), parts]
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in columns], ["draws", "sizes", "numbers", "parts"])

    return map_arrow(told.select("topic_draw", "topic_numbers", "topic_counts"), run, "draws binary, sizes binary, numbers binary, parts binary")


def _blocks(batch: pa.RecordBatch):
    """(draws, ends, numbers, parts, vectors) of some hundred texts each; vectors: a text a row, all numbers, as doubles that hold whole numbers."""
    for k in range(batch.num_rows):
        draws, sizes, number, parts = (np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in enumerate((np.float64, np.int32, np.uint16, np.int32)))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for start in range(0, len(draws), 500):
            own = ends[start : start + 501]
            x = np.zeros((len(own) - 1, DIMS))
            x[np.repeat(np.arange(len(own) - 1), np.diff(own)), number[own[0] : own[-1]]] = parts[own[0] : own[-1]]
            yield draws[start : start + 500], own, number, parts, x


def _nearness(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """By whole numbers, whose products and sums doubles hold exactly, so that it doesn't depend on their order."""
    return x @ np.round(centres * PARTS).T / PARTS / PARTS


def _sums(rows: DataFrame, function, size: int) -> np.ndarray:
    """Adds up an array of ``size`` whole numbers a batch: in each task, then in some tasks, as many as the root of those, then here."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += function(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def gathered(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in batch.column(0):
                total += np.frombuffer(part.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts, tasks = rows.mapInArrow(run, "part binary"), rows.rdd.getNumPartitions()
    if tasks > 64:
        parts = parts.repartition(math.isqrt(tasks)).mapInArrow(gathered, "part binary")
    return sum((np.frombuffer(r[0], np.int64) for r in parts.collect()), np.zeros(size, np.int64))


def _drawn(vectors: DataFrame, centres: np.ndarray) -> np.ndarray | None:
    """The vector of one document of all, drawn by its distance to the nearest centre; None if no distance is left."""
    turn = len(centres)

    def run(batches):
        best = None
        for batch in batches:
            for draws, ends, number, parts, x in _blocks(batch):
                far = np.maximum(0, 1 - _nearness(x, centres).max(axis=1)) if turn else np.ones(len(x))
                chance = np.clip((draws + turn * 0.6180339887498949) % 1, 1e-12, 1 - 1e-12)
                able = np.flatnonzero(far > 1e-6)
                if len(able):  # the least of exponential waits falls on each document in proportion to its distance
                    wait = -np.log(chance[able]) / far[able]
                    k = int(able[np.argmin(wait)])
                    one = float(wait.min()), number[ends[k] : ends[k + 1]].tobytes(), parts[ends[k] : ends[k + 1]].tobytes()
                    best = one if best is None else min(best, one)
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in best], ["wait", "numbers", "parts"])

    first = vectors.mapInArrow(run, "wait double, numbers binary, parts binary").orderBy("wait", "numbers", "parts").limit(1).collect()
    if not first:
        return None
    out = np.zeros(DIMS)
    out[np.frombuffer(first[0]["numbers"], np.uint16)] = np.frombuffer(first[0]["parts"], np.int32)
    return _unit(out)


def learnt(docs: DataFrame, topics: int = TOPICS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the numbers, and centres of unit length, at most ``topics``, by all texts of a table."""
    return learnt_of(durable(features(docs, [])), topics, rounds)


def learnt_of(told: DataFrame, topics: int = TOPICS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The same of ``features``, which have to be cut before: they are read twice."""
    bounded_batches(told.sparkSession)
    seen = _sums(told.select("topic_numbers"), lambda batch: np.append(np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint16), minlength=DIMS), batch.num_rows), DIMS + 1)
    share = seen[:DIMS] / max(seen[DIMS], 1)
    weight = np.where((share > 0) & (share <= COMMON), np.log(1 / np.maximum(share, 1e-12)), 0)
    vectors, centres = durable(_vectors(told, weight)), np.zeros((0, DIMS))
    while len(centres) < topics and (one := _drawn(vectors, centres)) is not None:
        centres = np.vstack([centres, one])
    for _ in range(rounds if len(centres) > 1 else 0):

        def moved(batch: pa.RecordBatch, centres: np.ndarray = centres) -> np.ndarray:
            sums = np.zeros(centres.shape)
            for *_, x in _blocks(batch):
                own = _nearness(x, centres).argmax(axis=1)
                sums += (own == np.arange(len(centres))[:, None]).astype(np.float64) @ x
            return sums.ravel().astype(np.int64)

        sums = _sums(vectors, moved, centres.size).reshape(centres.shape).astype(np.float64)
        before, centres = centres, np.where(sums.any(axis=1)[:, None], _unit(sums), centres)
        if np.abs(centres - before).max() < 1e-6:
            break
    return weight.astype(np.float32), centres.astype(np.float32)


def assign(texts: list[str | None], weight: np.ndarray, centres: np.ndarray) -> list[str]:
    sizes, number, count = _counted([None if t is None else t.encode() for t in texts])
    return _nearest(len(texts), np.repeat(np.arange(len(texts)), sizes), number, count, weight, centres)


def _nearest(rows: int, row: np.ndarray, number: np.ndarray, count: np.ndarray, weight: np.ndarray, centres: np.ndarray) -> list[str]:
    if not len(centres):
        return [NONE] * rows
    value = np.log1p(count) * weight[number].astype(np.float64)  # the length of a vector doesn't change which centre is nearest
    near = np.stack([np.bincount(row, value * centre[number], rows) for centre in centres])
    told = np.bincount(row, value > 0, rows) > 0
    names = [f"t{k:02d}" for k in range(len(centres))]
    return [names[k] if is_told else NONE for k, is_told in zip(near.argmax(axis=0).tolist(), told.tolist(), strict=True)]


def with_topic_of(told: DataFrame, name: str, topics: int = TOPICS) -> DataFrame:
    """The columns of cut ``features`` other than its own, and each row's topic in a column ``name``."""
    shared = told.sparkSession.sparkContext.broadcast(learnt_of(told, topics))
    kept = [f for f in told.schema.fields if not f.name.startswith("topic_")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = _nearest(batch.num_rows, *_told(batch), *shared.value)
        return pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(own, pa.string())], [*batch.schema.names[:-2], name])

    return map_arrow(told.select(*[f.name for f in kept], "topic_numbers", "topic_counts"), run, StructType([*kept, StructField(name, StringType())]))


def with_topic(docs: DataFrame, name: str, topics: int = TOPICS) -> DataFrame:
    """The table with each row's topic in a column ``name``; texts are not moved."""
    shared = docs.sparkSession.sparkContext.broadcast(learnt(docs, topics))  # centres: some thousand numbers
    place = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = assign(batch.column(place).cast(pa.string()).to_pylist(), *shared.value)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.string())], [*batch.schema.names, name])

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField(name, StringType())]))
