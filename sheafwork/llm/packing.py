"""Best-fit packing of token sequences by minimum bin slack.

Lengths are at most the capacity (2048 by default), so the packing problem is a histogram of at most
``capacity`` counts whatever the corpus: only that histogram reaches the driver. There every bin is filled by
a bitset subset-sum dynamic program over the available lengths: seeded with the largest one left, the fullest
feasible combination is found and removed, as many times as the counts allow. The plan is a short list of
patterns; ranks of the pieces within their length, from per-partition counts, then name each piece's sequence
and place without any row meeting another.

Defined cases: null text counts as empty (one piece holding just the closing id); equal rows are packed
each on its own; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.common import bounded_batches, durable, held, map_arrow

CAPACITY = 2048


class Coder:
    """Byte-level BPE by a vocabulary file of `tokenizers`: the same ids, from a faster encoder of the same ranks.

    added: strings of the file's added tokens in a text are these tokens, as `tokenizers` has it; such texts go through it.
    Else they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        vocabulary = held["model"]["vocab"]
        strings = [t["content"] for t in held.get("added_tokens") or []]
        back = {c: b for b, c in enumerate(_byte_letters())}
        ranks = {bytes(back[c] for c in piece): i for piece, i in vocabulary.items() if piece not in strings}
        self.coding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = re.compile("|".join(map(re.escape, strings))) if added and strings else None
        self.path, self.whole = path, None

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit bytes."""
        if self.added and self.added.search(text):
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.coding.encode_ordinary(text)).tobytes()


def _byte_letters() -> list[str]:
    """The letter that byte-level BPE files write for each byte: itself if visible, else the next from U+0100."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def coder(path: str, added: bool = False) -> Coder:
    return held(f"tokens of {path} {added}", None, lambda: Coder(path, added))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False, added: bool = False) -> DataFrame:
    """Tokenizes whole texts and cuts them into pieces of at most ``capacity`` ids; only a first piece may be shorter.

    ``part`` and ``rank`` number the pieces of each length within a task.
    """
    fields = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint" + ", ids array<int>" * keep_ids

    def run(batches):
        from pyspark import TaskContext

        part, seen, code = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64), coder(path, added)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = code.encode(text.as_py() or "") + b"\0\0\0\0"
                total = len(ids) // 4
                count = -(-total // capacity)
                start = 0
                for piece in range(count):
                    length = total - capacity * (count - 1) if piece == 0 else capacity
                    own = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, piece, start, length, zlib.crc32(own), part, int(seen[length]))
                    out.append((*row, np.frombuffer(own, "<u4")) if keep_ids else row)
                    seen[length] += 1
                    start += length
            if out:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank", "ids"]
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names[: len(columns)])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, fields)


@dataclass
class Segment:
    """Ranks from ``low`` on of one length: ``times`` sequences from ``first`` on hold ``copies`` of it each, from ``offset`` on."""

    low: int
    copies: int
    first: int
    offset: int


def fullest(counts: dict[int, int], seed: int, capacity: int) -> dict[int, int]:
    """The fullest feasible combination with ``seed`` in it: {length: copies}, by a bitset of the reachable sums."""
    room = capacity - seed
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length] - (length == seed), room // length), 1
        while left > 0 and not reach >> room & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (take * length) & mask
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    filled, chosen = reach.bit_length() - 1, {seed: 1}
    for length, take, before in reversed(steps):
        if not before >> filled & 1:
            filled -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, list[Segment]], int]:
    """Segments by length, and the number of sequences. Each pattern is repeated until one of its lengths runs short."""
    counts = {k: v for k, v in histogram.items() if v}
    used, segments, sequences = dict.fromkeys(counts, 0), {k: [] for k in counts}, 0
    while counts:
        chosen = fullest(counts, max(counts), capacity)
        times, offset = min(counts[k] // n for k, n in chosen.items()), 0
        for length, copies in chosen.items():
            segments[length].append(Segment(used[length], copies, sequences, offset))
            used[length] += copies * times
            offset += copies * length
            counts[length] -= copies * times
            if not counts[length]:
                del counts[length]
        sequences += times
    return segments, sequences


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False, added: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if kept)."""
    cut = durable(pieces(docs, path, capacity, keep_ids, added))
    cells = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = durable(cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = {r[0]: r[1] for r in cells.groupBy("length").agg(F.sum("n")).collect()}  # at most ``capacity`` rows
    segments, _ = plan(histogram, capacity)
    lengths = sorted(segments)
    tables = {k: np.array([(s.low, s.copies, s.first, s.offset) for s in segments[k]], dtype=np.int64) for k in lengths}

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        order = np.argsort(length, kind="stable")
        found, starts = np.unique(length[order], return_index=True)
        for value, own in zip(found, np.split(order, starts[1:]), strict=True):
            table = tables[int(value)]
            low, copies, first, at = table[np.searchsorted(table[:, 0], rank[own], "right") - 1].T
            instance, copy = np.divmod(rank[own] - low, copies)
            sequence[own], offset[own] = first + instance, at + copy * value
        kept = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != "rank"]
        names = [c for c in batch.schema.names if c != "rank"]
        return pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    ranked = cut.join(cells.select("part", "length", "before"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids, (F.col("rank") + F.col("before")).alias("rank")
    )
    fields = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids + ", sequence_id bigint, offset bigint"
    return map_arrow(ranked, place, fields)
