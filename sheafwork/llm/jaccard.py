"""Exact links of texts by the Jaccard similarity of their shingle sets.

Rows with equal sets are one class. Candidates come from MinHash: ``BANDS`` keys of ``ROWS`` least hashes each, so a
pair at the floor of 0.8 shares no key with a chance of (1 - 0.8^5)^40 = 1.2e-7, whatever its length. The classes of
a key are tied to the least of them, never in pairs; a caller may add ties of its own (``near``), as the links of
fingerprints. The components of all ties are groups of candidates. Inside
a group, shingle sets made anew from the texts are compared exactly, and only pairs at the floor or above are links.

A task holds a group, or two chunks of a large one, so that all its pairs meet (``CHUNK``, ``CHUNKS``, ``LOAD``). Texts are found over their
shared shingles, and those that have a component leave the index, so a dense group costs about one pass.

Shingles are compared by their XXH64 (two of a pair agree by chance in some 1e-13 of pairs of long texts).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.common import bounded_batches, durable, free_prefix, map_arrow
from sheafwork.llm.components import components

BANDS, ROWS = 40, 5
#: Classes of a chunk of a group, chunks of a group whose shingles do not ask for more, shingles of a chunk.
CHUNK, CHUNKS, LOAD = 100, 28, 1 << 20


def shingle_set(text: str, size: int) -> np.ndarray:
    """The sorted, distinct hashes of a text's shingles; a text of fewer words is one shingle, one without words has none."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    return np.unique(np.fromiter(map(partial(xxh64_intdigest, seed=42), shingles), dtype=np.uint64))


@cache
def _factors() -> np.ndarray:
    return np.random.default_rng(17).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(own: np.ndarray) -> np.ndarray:
    """A key for each band; an empty set has none."""
    if not len(own):
        return np.zeros(0, np.int64)
    first, second = _factors()
    own = own ^ (own >> np.uint64(32))
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(own), 256):
        np.minimum(least, np.multiply.outer(first, own[at : at + 256]).min(axis=1), out=least)
    mixed = ((least ^ (least >> np.uint64(29))) * second).reshape(BANDS, ROWS)
    keys = np.bitwise_xor.reduce(mixed, axis=1)
    return (keys ^ (keys >> np.uint64(32)) ^ (np.arange(BANDS, dtype=np.uint64) << np.uint64(58))).view(np.int64)


def similar(sets: list[np.ndarray], floor: tuple[int, int]) -> np.ndarray:
    """For each set the first one of its component, over links of a similarity of at least ``floor``, a fraction."""
    n, (top, bottom) = len(sets), floor
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    ends = np.cumsum(sizes)
    token = np.unique(np.concatenate(sets), return_inverse=True)[1] if n else np.zeros(0, np.int64)
    kinds = int(token.max(initial=-1)) + 1
    order = np.argsort(token, kind="stable")
    posted_token, posted = token[order], np.repeat(np.arange(n), sizes)[order]
    root = np.full(n, -1, dtype=np.int64)

    def index() -> np.ndarray:
        return np.concatenate([[0], np.cumsum(np.bincount(posted_token, minlength=kinds))])

    begins, left = index(), len(posted)
    for s in range(n):
        if root[s] >= 0:
            continue
        root[s], todo = s, [s]
        left -= sizes[s]
        while todo:
            v = todo.pop()
            if left * 2 < len(posted):  # those that have a component leave the index
                keep = root[posted] < 0
                posted_token, posted = posted_token[keep], posted[keep]
                begins, left = index(), len(posted)
            own = token[ends[v] - sizes[v] : ends[v]]
            low, many = begins[own], begins[own + 1] - begins[own]
            shared = np.bincount(posted[np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())], minlength=n)
            near = np.flatnonzero((root < 0) & (shared > 0) & (shared * bottom >= (sizes[v] + sizes - shared) * top))
            root[near] = s
            left -= sizes[near].sum()
            todo += near.tolist()
    return root


def prints(docs: DataFrame, size: int, fingerprint: Callable[[str], bytes] | None = None) -> DataFrame:
    """doc_id, key (a hash of the text), node (of the set), size (its shingles), bands and fp (if asked for) of every row."""
    key = F.xxhash64(F.col("text").cast("string"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t.as_py() or "", size) for t in batch.column(1)]
        node = [int.from_bytes(blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets]
        bands = pa.array([band_keys(s).tobytes() for s in sets], pa.binary())
        fp = pa.array([fingerprint(t.as_py() or "") if fingerprint else None for t in batch.column(1)], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(node, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), bands, fp], ["doc_id", "key", "node", "size", "bands", "fp"])

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), key.alias("key")]
    return map_arrow(docs.select(*columns), run, "doc_id bigint, key bigint, node bigint, size bigint, bands binary, fp binary")


def _ties(classes: DataFrame) -> DataFrame:
    """(a, b): every class with the least one that shares a key of a band with it."""

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.frombuffer(b, np.int64) for b in batch.column(1).to_pylist()]
        node = np.repeat(batch.column(0).to_numpy(), [len(f) for f in found])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(node)], ["band", "node"])

    rows = map_arrow(classes.select("node", "bands"), spread, "band bigint, node bigint")
    shared = rows.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("band", "least")
    return rows.join(shared, "band").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))


def _group_links(docs: DataFrame, classes: DataFrame, ties: DataFrame, size: int, floor: tuple[int, int]) -> DataFrame:
    """(a, b) links that connect what is similar: groups of candidates, the components of ties, compared by their shingle sets."""
    groups = durable(components(ties).join(classes.select("node", "size", F.col("place.doc_id").alias("id"), F.col("place.key").alias("key")), "node"))
    crowds = groups.groupBy("component").agg(F.greatest(F.least(F.ceil(F.count(F.lit(1)) / CHUNK), F.lit(CHUNKS)), F.ceil(F.sum("size") / LOAD)).cast("int").alias("chunks")).where("chunks > 1")
    own = free_prefix(docs)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)).alias(f"{own}id"), F.col("text").cast("string").alias("text")).withColumn(f"{own}key", F.xxhash64("text"))
    found = texts.join(groups, (F.col(f"{own}id") == F.coalesce("id", F.lit(-1))) & (F.col(f"{own}key") == F.col("key"))).select("component", "node", "text")
    found = found.join(crowds, "component", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    found = found.withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = found.select(F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")).alias("deal"), "node", "text")

    def run(batches):
        def links(node: list, sets: list) -> pa.RecordBatch | None:
            once = dict(zip(node, sets, strict=True))  # rows that repeat id and text
            names, root = np.array(list(once), dtype=np.int64), similar(list(once.values()), floor)
            moved = root != np.arange(len(root))
            return pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[root[moved]])], ["a", "b"]) if moved.any() else None

        last, node, sets = None, [], []
        for batch in batches:
            for deal, n, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if deal != last and node:
                    if (out := links(node, sets)) is not None:
                        yield out
                    node, sets = [], []
                last = deal
                node.append(n)
                sets.append(shingle_set(text.as_py() or "", size))
        if node and (out := links(node, sets)) is not None:
            yield out

    bounded_batches(docs.sparkSession)
    return dealt.repartition("deal").sortWithinPartitions("deal").mapInArrow(run, "a bigint, b bigint")


def grouped(docs: DataFrame, size: int, floor: tuple[int, int], fingerprint: Callable[[str], bytes] | None = None, near: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(prints of all rows, classes with their component): node, place (no_id, doc_id, key of its first row), component.

    near: (fp, node) of all rows -> ties (a, b) of nodes, more candidates than those of MinHash.
    """
    rows = durable(prints(docs, size, fingerprint))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    classes = durable(rows.groupBy("node").agg(F.min(place).alias("place"), F.min("size").alias("size"), F.min("bands").alias("bands")))
    ties = _ties(classes) if near is None else near(rows.select("fp", "node").distinct()).unionByName(_ties(classes))
    found = components(_group_links(docs, classes, ties, size, floor))
    return rows, classes.join(found, "node", "left").select("node", "place", F.coalesce("component", "node").alias("component"))
