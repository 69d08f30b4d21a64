"""Exact top-k by inner product over integer vectors: norm-bucketed retrieval.

Vectors are grouped into buckets by length (norm), cut at quantiles, longest first; a bucket is dealt into chunks
of some ``CHUNK`` vectors. First every query meets the first chunk of the longest bucket, whose k-th product is a
threshold; divided by the query's norm, it is the least length of a vector that may still count. The queries are then
dealt into blocks of some ``BLOCK`` with like least lengths. Which blocks meet which buckets is decided before any
vector moves: a bucket whose longest vector is too short for all queries of a block is never sent there.

In a meeting, the threshold, the query's norm and the chunk's longest vector give the cosine that a vector there must
reach: above 1 the chunk is skipped; at ``STEEP`` or more, coordinate pruning keeps the vectors whose value at the
query's strongest coordinates lies in the interval which that cosine allows; otherwise length pruning keeps those long
enough. All that is kept is verified by exact products, and each meeting returns at most k rows a query.

Neither vectors nor pairs are collected: blocks and chunks meet in a cogroup, and at most k rows a query and chunk
go on to the final ranking. A row a block and a row a bucket come to the driver. Where all vectors have one length, all
blocks meet all chunks, and a vector is sent once for every ``BLOCK`` queries.

Defined cases: vectors that are null or hold a null or a non-finite component, and rows without an id, take no part;
vectors of another dimension than the query's aren't its candidates; rows with the query's own id are left out, other repeated rows
all count; a query id that repeats is asked once, with its least vector; ties go to the smaller id; an empty table
gives no rows; other columns are ignored. Components are scaled by 64 and rounded down; beyond 2**53 in a product's
bound, exact whole numbers of any size are used and the score is wrong only if it leaves the range of bigint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.common import bounded_batches, durable

BUCKETS, CHUNK, BLOCK = 8, 20_000, 8_000
#: Local cosine threshold from which coordinates prune better than lengths.
STEEP = 0.6
#: Coordinates that are looked at.
FOCUS = 2


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 64) -> DataFrame:
    """vec_id, v (whole numbers as doubles), norm, of the vectors that take part."""
    v = F.col(vector_col)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    own = vectors.where(F.col(id_col).isNotNull() & v.isNotNull()).where(F.coalesce(sound, F.lit(False)))
    own = own.select(F.col(id_col).cast("bigint").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))
    return own.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """Positions of the k best of each row, ties to the smaller id; the row's own id is left out."""
    out = []
    scores = scores.astype(np.float64) if scores.dtype == object else scores
    for row, me in zip(scores, own, strict=True):
        at = np.flatnonzero(ids != me)
        if len(at) > k:
            cut = np.partition(row[at], len(at) - k)[len(at) - k]
            at = at[row[at] >= cut]
        out.append(at[np.lexsort((ids[at], -row[at]))][:k])
    return out


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in doubles while every partial sum is exact, else in Python's integers."""
    if not queries.size or not vectors.size or np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1] < 2.0**53:
        return queries @ vectors.T
    exact = lambda a: np.vectorize(int, otypes=[object])(a)
    return exact(queries) @ exact(vectors).T


def allowed(q: float, cosine: float) -> tuple[float, float]:
    """Interval of a unit vector's coordinate, given the query's unit coordinate and the least cosine between them."""
    rest = np.sqrt(max(0.0, (1 - q * q) * (1 - cosine * cosine)))
    low = -1.0 if q < -cosine else q * cosine - rest
    high = 1.0 if q > cosine else q * cosine + rest
    return low - 1e-9, high + 1e-9


def meet(q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, ids: np.ndarray, v: np.ndarray, norms: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, vector, score) of the k best of each query in one chunk, among those that may reach its threshold."""
    order = np.argsort(-norms, kind="stable")
    ids, v, norms = ids[order], v[order], norms[order]
    q_norm = np.sqrt((q * q).sum(axis=1))
    bound = q_norm * norms[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(bound > 0, least / bound, np.where(least > 0, 2.0, -1.0))
        shortest = np.where(q_norm > 0, least / q_norm, 0)
    out: list = []

    def add(rows: np.ndarray, kept: np.ndarray | slice) -> None:
        for k0 in range(0, len(rows), 256):
            part = rows[k0 : k0 + 256]
            scores = products(q[part], v[kept])
            for row, r, found in zip(part, scores, best(scores, ids[kept], q_ids[part], k), strict=True):
                own = ids[kept][found]
                out.extend((int(q_ids[row]), int(i), int(s)) for i, s in zip(own, r[found], strict=True) if s >= least[row])

    active = np.flatnonzero(cosine <= 1 + 1e-9)
    steep = active[cosine[active] >= STEEP]
    for row in steep:
        unit, keep = q[row] / q_norm[row], norms >= shortest[row] * (1 - 1e-9)
        for c in np.argsort(-np.abs(unit))[:FOCUS]:
            low, high = allowed(unit[c], min(1.0, cosine[row]))
            with np.errstate(divide="ignore", invalid="ignore"):
                at = np.where(norms > 0, v[:, c] / norms, 0)
            keep &= (at >= low) & (at <= high)
        add(np.array([row]), np.flatnonzero(keep))
    flat = active[cosine[active] < STEEP]
    flat = flat[np.argsort(-shortest[flat], kind="stable")]
    for k0 in range(0, len(flat), 256):  # queries of like thresholds share the longest prefix that one of them needs
        part = flat[k0 : k0 + 256]
        prefix = int(np.searchsorted(-norms, -shortest[part].min() * (1 - 1e-9), side="right"))
        if prefix:
            add(part, slice(0, prefix))
    return out


def meetings(longest: dict[int, list[tuple[float, int, int]]], needs: list[tuple[int, int, float]]) -> dict[tuple[int, int], tuple[int, int]]:
    """By (dimension, bucket), the first and last block that a bucket is sent to, if any.

    longest: (a bucket's longest norm, its number, its chunks) by dimension; needs: (dimension, block, the least norm that
    one of its queries needs), blocks in ascending order of need.
    """
    out: dict[tuple[int, int], tuple[int, int]] = {}
    for size, block, need in needs:
        for most, bucket, _ in longest[size]:
            if most >= need:
                out[size, bucket] = (out.get((size, bucket), (block,))[0], block)
    return out


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose id is divisible by ``every``, the k best other rows."""
    bounded_batches(vectors.sparkSession)
    rows = durable(whole_vectors(vectors, id_col, vector_col))
    # One list of at most BUCKETS norms and one row a bucket and dimension come to the driver.
    cuts = sorted(set(rows.approxQuantile("norm", [b / BUCKETS for b in range(1, BUCKETS)], 0.01)), reverse=True)
    bucket = F.lit(0)
    for c in cuts:
        bucket = bucket + F.when(F.col("norm") < c, 1).otherwise(0)
    rows = rows.withColumn("bucket", bucket).withColumn("size", F.size("v"))
    counts = {(r["size"], r["bucket"]): r["n"] for r in rows.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("size", F.size("v"))
    n_queries = dict(queries.groupBy("size").count().collect())
    chunks = {key: -(-n // CHUNK) for key, n in counts.items()}
    blocks = {size: -(-n // BLOCK) for size, n in n_queries.items()}
    # Chunks of a dimension are numbered from the longest bucket on.
    first: dict[tuple[int, int], int] = {}
    total: dict[int, int] = {}
    for size, b in sorted(chunks):
        first[size, b] = total.get(size, 0)
        total[size] = first[size, b] + chunks[size, b]
    if not blocks:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")

    def table(values: dict, of):
        return F.create_map(*[x for key, n in values.items() for x in (F.lit(of(key)), F.lit(n))])

    name = F.concat_ws(":", F.col("size").cast("string"), F.col("bucket").cast("string"))
    of_bucket = lambda p: f"{p[0]}:{p[1]}"
    # The row's number spreads rows that repeat; the cut of the lineage keeps it the same in every job.
    spread = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), table(chunks, of_bucket)[name]).cast("int")
    rows = rows.where(F.col("size").isin(list(blocks))).withColumn("chunk", table(first, of_bucket)[name] + spread)

    def joined(asked: DataFrame, held: DataFrame) -> DataFrame:
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            found: list = []
            if left.num_rows and right.num_rows:
                dim = left["size"][0].as_py()
                q, v = (np.asarray(t["v"].combine_chunks().flatten(), dtype=np.float64).reshape(t.num_rows, dim) for t in (left, right))
                found = meet(left["vec_id"].to_numpy(), q, left["least"].to_numpy(), right["vec_id"].to_numpy(), v, right["norm"].to_numpy(), k)
            columns = list(zip(*found, strict=True)) or [[], [], []]
            return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_id", "vec_id", "score"), columns, strict=True)})

        keys = ["size", "block", "chunk"]
        asked = asked.toDF(*[f"q_{c}" for c in asked.columns]).toDF(*asked.columns)  # both sides stem from one table
        return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")

    columns = ["size", "block", "chunk", "vec_id", "v"]
    own_blocks = table(blocks, int)[F.col("size")]
    begun = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), own_blocks).cast("int")).withColumn("chunk", F.lit(0)).withColumn("least", F.lit(float("-inf")))
    held = rows.select("size", "bucket", "chunk", "vec_id", "v", "norm")
    start = durable(joined(begun.select(*columns, "least"), held.where("chunk = 0").withColumn("block", F.explode(F.sequence(F.lit(0), own_blocks - 1))).select(*columns, "norm")))
    least = start.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).otherwise(float("-inf")).alias("least"))
    asked = queries.join(least.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    need = F.when((F.col("least") > 0) & (norm > 0), F.col("least") / norm * (1 - 1e-9)).otherwise(F.when(F.col("least") > 0, float("inf")).otherwise(0.0))
    # Queries of like needs share a block, so that a bucket is sent to the blocks before the first that can do without it.
    dealt = asked.withColumn("need", need).repartitionByRange(sum(blocks.values()), "size", "need", F.xxhash64("vec_id"))
    asked = durable(dealt.withColumn("block", F.spark_partition_id()))
    longest: dict[int, list[tuple[float, int, int]]] = {}  # of each dimension: a bucket's longest norm, its number, its chunks
    for r in rows.groupBy("size", "bucket").agg(F.max("norm").alias("norm")).orderBy("size", "bucket").collect():
        longest.setdefault(r["size"], []).append((r["norm"], r["bucket"], chunks[r["size"], r["bucket"]]))
    needs = [tuple(r) for r in asked.groupBy("size", "block").agg(F.min("need")).orderBy("size", "block").collect()]
    wanted = meetings(longest, needs)
    if not wanted:
        found = start
    else:
        to_blocks = F.explode(F.sequence(table({key: x[0] for key, x in wanted.items()}, of_bucket)[name], table({key: x[1] for key, x in wanted.items()}, of_bucket)[name]))  # no row for a bucket that none needs
        reach = F.lit(0)  # chunks of the buckets that the block needs, which are the first ones
        by_block = F.min("need").over(Window.partitionBy("size", "block"))
        for size, own in longest.items():
            for most, _, n in own:
                reach = reach + F.when((F.col("size") == size) & (F.col("block_need") <= most), n).otherwise(0)
        asked = asked.withColumn("block_need", by_block).withColumn("reach", reach).where("reach > 1")
        asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(1), F.col("reach") - 1)))
        found = start.unionByName(joined(asked.select(*columns, "least"), held.where("chunk > 0").withColumn("block", to_blocks).select(*columns, "norm")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
