"""SimHash near-duplicates by vantage-point trees over fingerprints.

A scheme says how wide fingerprints are, how close linked ones lie, and how they are dealt to shards. Equal fingerprints
are one class first, so copies never multiply. The first step is a plain index by blocks of bits, no tree: a
fingerprint is at home in one shard a block, by the block's value, and where a block has the radius 1 it also visits the
shards one bit away. Vantage points alone would not do for this step: distances of unlike fingerprints to any point
lie so close together that nearly every fingerprint would have to visit nearly every shard within 4 bits of a boundary.

``EXACT`` (64 bits, 4 bits apart, shingles of four words) has four blocks of 16 bits with the radii 1, 0, 0, 0. A pair
within 4 bits is within 1 bit in the first block or equal in one of the others (1+1+1+1+1 > 4), so no link is lost.

``WIDE`` (384 bits, shingles of five words) is for copies that share 0.8 of their shingles. A fingerprint only estimates
that similarity, so its links are exact: candidates are the links of ``EXACT`` fingerprints by the trees below, and what four
bits miss by MinHash, and shingle sets decide (``sheafwork.llm.jaccard``).

Inside a shard, a vantage-point join on all bits finds the pairs: a fingerprint is the vantage point, the median
distance splits the others, and only the strips within the radius of the boundary meet across it. What lies within
the radius of the vantage point links to it and is not compared with itself again, so a dense group of near copies
costs about one pass. Shards over ``CROWD`` rows are cut into chunks that meet pairwise in tasks of their own.
Every shard returns a spanning star of its links; distributed components finish the job.

Defined cases: null text counts as empty; texts without words have fingerprint zero and link like any other;
a null doc_id gets a fingerprint and its component, whose id is the least id there is in it, null if none;
repeated rows share a class; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.common import bounded_batches, durable, free_prefix, map_arrow
from sheafwork.llm.components import components
from sheafwork.llm.jaccard import grouped


@dataclass(frozen=True)
class Scheme:
    """Words of 64 bits, bits within which fingerprints link, words of a shingle, bits of a block, radius of each block.

    similarity: the least Jaccard similarity of linked shingle sets, a fraction; links are by it alone if it is given.
    """

    words: int
    radius: int
    shingle: int
    block: int
    radii: tuple[int, ...]
    similarity: tuple[int, int] | None = None


EXACT = Scheme(1, 4, 4, 16, (1, 0, 0, 0))
WIDE = Scheme(6, 0, 5, 0, (), (4, 5))
#: Rows of a shard beyond which it is cut into chunks that meet pairwise.
CROWD = 20_000
#: Pairs that are compared at once; below that, a split does not pay.
BRUTE = 1 << 14
#: Stand-ins for null ids, above every id.
ABOVE = 1 << 62
#: Odd factors that spread a shingle's hash to the words of a wide fingerprint after the first.
_FACTOR = 0x9E3779B97F4A7C15


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set, the lowest bit first."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    whole = len(bits) // 255 * 255  # bytes can't overflow in a sum of 255 bits
    out = bits[whole:].sum(axis=0, dtype=np.int64)
    return out + np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) if whole else out


def fingerprint(text: str, scheme: Scheme = EXACT) -> bytes:
    """The fingerprint, highest byte of each word first.

    Bytes are split and lower-cased exactly as the definition says: ASCII white space and A-Z alone.
    """
    from xxhash import xxh64_intdigest

    words, size = text.encode().lower().split(), scheme.shingle
    if not words:
        return bytes(8 * scheme.words)
    hashed = partial(xxh64_intdigest, seed=42)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    hashes = np.fromiter(map(hashed, shingles), dtype=np.uint64)
    out = np.zeros(scheme.words, dtype=np.uint64)
    for k in range(scheme.words):
        counts = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)]
            if k:
                part = part * np.uint64((_FACTOR * (2 * k + 1) | 1) & (1 << 64) - 1)
                part ^= part >> np.uint64(32)
                part = part * np.uint64(_FACTOR)
                part ^= part >> np.uint64(29)
            counts += _ones(part)
        out[k] = np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out.astype(">u8").tobytes()


def fingerprints(docs: DataFrame, scheme: Scheme = EXACT, key: Column | None = None) -> DataFrame:
    """doc_id, fp (binary), and a bigint key of the row, if one is given."""
    names = ["doc_id", "fp", *["key"] * (key is not None)]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([fingerprint(t.as_py() or "", scheme) for t in batch.column(1)], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), found, *batch.columns[2:]], names)

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *([] if key is None else [key.alias("key")])]
    return map_arrow(docs.select(*columns), run, "doc_id bigint, fp binary" + ", key bigint" * (key is not None))


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, whose words are the last axis."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int16)


class Links:
    """Links found among numbered fingerprints, kept as a forest so that a dense group stays small."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = k = self.parent[self.parent[k]]
        return k

    def add(self, a, b) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)


def _star(links: Links, centre: int, others: np.ndarray) -> None:
    links.add(np.full(len(others), centre), others)


def join_self(fp: np.ndarray, own: np.ndarray, links: Links, radius: int = EXACT.radius) -> None:
    """Links all pairs within ``radius`` among the fingerprints numbered ``own``."""
    todo = [own]
    while todo:
        x = todo.pop()
        if len(x) < 2:
            continue
        if len(x) ** 2 <= BRUTE:
            values = fp[x]
            i, j = np.nonzero(apart(values[:, None], values[None, :]) <= radius)
            links.add(x[i[i < j]], x[j[i < j]])
            continue
        d = apart(fp[x], fp[x[0]])
        inside = d <= radius
        _star(links, int(x[0]), x[inside])
        middle = int(np.median(d))
        low = d <= middle
        if inside.mean() > 1 / 8 or low.all():
            join_cross(fp, x[inside][1:], x[~inside & (d <= 2 * radius)], links, radius)  # all links of the vantage point are known
            todo.append(x[~inside])
        else:
            todo += [x[low], x[~low]]
            join_cross(fp, x[low & (d > middle - radius)], x[~low & (d <= middle + radius)], links, radius)


def join_cross(fp: np.ndarray, left: np.ndarray, right: np.ndarray, links: Links, radius: int = EXACT.radius) -> None:
    """Links all pairs within ``radius`` between the two sets."""
    todo = [(left, right)]
    while todo:
        a, b = todo.pop()
        if not len(a) or not len(b):
            continue
        if len(a) > len(b):
            a, b = b, a
        if len(a) * len(b) <= BRUTE or len(a) < 8:
            for k in range(0, len(b), BRUTE):
                c = b[k : k + BRUTE]
                i, j = np.nonzero(apart(fp[a][:, None], fp[c][None, :]) <= radius)
                links.add(a[i], c[j])
            continue
        da, db = (apart(fp[x], fp[a[0]]) for x in (a, b))
        near_a, near_b = da <= radius, db <= radius
        _star(links, int(a[0]), a[near_a])
        _star(links, int(a[0]), b[near_b])
        middle = int(np.median(db))
        low_a, low_b = da <= middle, db <= middle
        if near_a.mean() > 1 / 8 or near_b.mean() > 1 / 8 or low_b.all() or not low_b.any():
            todo += [
                (a[near_a][1:], b[~near_b & (db <= 2 * radius)]),  # all links of the vantage point, a's first, are known
                (a[~near_a & (da <= 2 * radius)], b[near_b]),
                (a[~near_a], b[~near_b]),
            ]
        else:
            todo += [
                (a[low_a], b[low_b]),
                (a[~low_a], b[~low_b]),
                (a[low_a & (da > middle - radius)], b[~low_b & (db <= middle + radius)]),
                (a[~low_a & (da <= middle + radius)], b[low_b & (db > middle - radius)]),
            ]


def shard_links(fp: np.ndarray, node: np.ndarray, side: np.ndarray, radius: int = EXACT.radius) -> tuple[np.ndarray, np.ndarray]:
    """Links of one shard or pair of chunks. side: 0 and 1, at home in the first or second chunk; 2 and 3, visitors of them."""
    links = Links(len(fp))
    home, second, visitor, visitor2 = (np.flatnonzero(side == k) for k in range(4))
    if len(second) or len(visitor2):
        join_cross(fp, home, np.concatenate([second, visitor2]), links, radius)
        join_cross(fp, visitor, second, links, radius)
    else:
        join_self(fp, home, links, radius)
        join_cross(fp, home, visitor, links, radius)
    roots = np.fromiter((links.root(k) for k in range(len(fp))), dtype=np.int64, count=len(fp))
    moved = roots != np.arange(len(fp))
    return node[moved], node[roots[moved]]


def shards_of(fp: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, visits): every fingerprint at home in one shard a block, and its visits to shards one bit away.

    Of two shards one bit apart, the fingerprints of the one with the bit set visit the other, so that a pair meets once.
    """
    rows, shards, visits = [], [], []
    every = np.arange(len(fp))
    bits = np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(len(fp), -1), axis=1, bitorder="little")
    for block, radius in enumerate(scheme.radii):
        own = bits[:, block * scheme.block : (block + 1) * scheme.block].astype(np.int64)
        value = (own << np.arange(scheme.block)).sum(axis=1)
        rows.append(every)
        shards.append(value + (block << scheme.block))
        visits.append(np.zeros(len(fp), bool))
        if radius:
            row, bit = np.nonzero(own)
            rows.append(row)
            shards.append(value[row] - (1 << bit) + (block << scheme.block))
            visits.append(np.ones(len(row), bool))
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(visits)


def _words(column: pa.Array, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u8").astype(np.uint64).reshape(-1, words)


def link(classes: DataFrame, scheme: Scheme = EXACT) -> DataFrame:
    """(fp, node) classes -> (a, b) links that connect all that is within the scheme's radius and meets in a shard."""

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, shard, visits = shards_of(_words(batch.column(0), scheme.words), scheme)
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(shard), pa.array(visits)], ["fp", "node", "shard", "visits"])

    rows = map_arrow(classes.select("fp", "node"), spread, "fp binary, node bigint, shard bigint, visits boolean")
    # At most one row a shard (blocks times 2^16, some hundred thousand), so this table may be broadcast.
    crowds = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).select("shard", F.ceil(F.col("n") / CROWD).cast("int").alias("chunks"))
    rows = rows.join(F.broadcast(crowds), "shard", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    rows = rows.withColumn("own", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("own", "other").cast("bigint"), F.greatest("own", "other").cast("bigint")
    keyed = rows.select(
        (F.shiftleft(F.shiftleft(F.col("shard"), 22) + low, 22) + high).alias("key"), "fp",  # shards take 18 bits
        "node", (F.when(F.col("own") > F.col("other"), 1).otherwise(0) + F.when(F.col("visits"), 2).otherwise(0)).cast("tinyint").alias("side")
    )

    def run(batches):
        def flush(parts):
            key, fp, node, side = (np.concatenate(c) for c in zip(*parts, strict=True))
            cuts = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
            found = [shard_links(fp[s:e], node[s:e], side[s:e], scheme.radius) for s, e in zip(starts.tolist(), ends.tolist(), strict=True) if e - s > 1]
            found = [x for x in found if len(x[0])]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["a", "b"])

        held: list = []  # the rows of the last key so far
        for batch in batches:
            if not batch.num_rows:
                continue
            part = [batch.column(0).to_numpy(), _words(batch.column(1), scheme.words), batch.column(2).to_numpy(), batch.column(3).to_numpy()]
            last = int(np.searchsorted(part[0], part[0][-1]))  # where the last key begins
            if last or (held and held[-1][0][-1] != part[0][0]):
                if last:
                    held.append([c[:last] for c in part])
                yield from flush(held)
                held = []
            held.append([c[last:] for c in part])
        if held:
            yield from flush(held)

    bounded_batches(classes.sparkSession)
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint")


def _components(prints: DataFrame, scheme: Scheme) -> DataFrame:
    """fp, component of every class of equal fingerprints."""
    stand_in = F.lit(ABOVE) + F.xxhash64("fp").bitwiseAND(F.lit(ABOVE - 1))
    classes = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("node")).withColumn("node", F.coalesce("node", stand_in)))
    found = components(link(classes, scheme))
    return classes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame, scheme: Scheme = EXACT) -> DataFrame:
    """doc_id, fingerprint (hex digits), component_id: the least doc_id reachable over links."""
    if scheme.similarity:
        return _similar_duplicates(docs, scheme)
    prints = durable(fingerprints(docs, scheme))
    return prints.join(_components(prints, scheme), "fp").select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), F.when(F.col("component") < ABOVE, F.col("component")).alias("component_id"))


def _near(rows: DataFrame) -> DataFrame:
    """(fp, node) of all rows -> (a, b) ties of nodes: rows of one fingerprint, and fingerprints that ``EXACT`` links."""
    classes = durable(rows.groupBy("fp").agg(F.min("node").alias("node")))
    own = rows.join(classes.withColumnRenamed("node", "least"), "fp").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    return link(classes, EXACT).unionByName(own)


def _grouped(docs: DataFrame, scheme: Scheme) -> tuple[DataFrame, DataFrame]:
    return grouped(docs, scheme.shingle, scheme.similarity, fingerprint, _near)


def _similar_duplicates(docs: DataFrame, scheme: Scheme) -> DataFrame:
    rows, classes = _grouped(docs, scheme)
    least = classes.groupBy("component").agg(F.min("place.doc_id").alias("component_id"))
    own = rows.join(classes, "node").join(least, "component").select(F.col("doc_id").alias("id"), F.col("key").alias("text_key"), "component_id").distinct()
    prints = fingerprints(docs, scheme, F.xxhash64(F.col("text").cast("string")))
    return prints.join(own, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("text_key"))).select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def _kept(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """p (no_id, doc_id, key): the first row of each component."""
    if scheme.similarity:
        return _grouped(docs, scheme)[1].groupBy("component").agg(F.min("place").alias("p"))
    prints = durable(fingerprints(docs, scheme, F.xxhash64(F.col("text").cast("string"))))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    return prints.join(_components(prints, scheme), "fp").groupBy("component").agg(F.min(place).alias("p"))


def representatives(docs: DataFrame, scheme: Scheme = WIDE) -> DataFrame:
    """One row of each component, all columns as they are: of the least doc_id (nulls last), then the least text hash.

    Of rows that repeat both, the one with the least hash of all its columns stays. Fingerprints and links are made on narrow rows; the texts are joined once,
    with one key for each row to keep.
    """
    key = F.xxhash64(F.col("text").cast("string"))
    o = free_prefix(docs)
    keep = _kept(docs, scheme).select(F.coalesce("p.doc_id", F.lit(-1)).alias(f"{o}keep_id"), F.col("p.key").alias(f"{o}keep_key"))
    whole = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])  # maps and variants have no hash
    once = Window.partitionBy(f"{o}keep_id", f"{o}keep_key").orderBy(whole)
    own = docs.withColumn(f"{o}row_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1))).withColumn(f"{o}row_key", key)
    joined = own.join(keep, (F.col(f"{o}row_id") == F.col(f"{o}keep_id")) & (F.col(f"{o}row_key") == F.col(f"{o}keep_key")))
    return joined.withColumn(f"{o}row", F.row_number().over(once)).where(F.col(f"{o}row") == 1).select(*docs.columns)
