"""Contiguous, byte-balanced shards from global prefix sums; DataFrame functions only.

Rows are laid out in one global order (a digest of the text, then the id), so equal texts stand together. Each
partition of that order sums its bytes, the sums of the partitions before it give every row its global start
byte, and the bytes are cut at equal targets. Part of the law is what happens where a cut meets a group of equal
texts: a group of at most ``whole`` of a shard (1 % by default) stays whole in the shard where it begins, a larger one
is split at a row. So a shard is off its target by at most that part and one row at either end, whatever the groups.

Only narrow rows move (id, size, checksum, digest), never texts. Defined cases: null text has no bytes, size 1
and checksum 0; an empty table gives no rows; equal rows get slots of their own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.common import durable

SHARDS = 16
#: Largest part of a shard's bytes that a group of equal texts may have and still stay whole at a cut.
WHOLE = 0.01


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, whole: float = WHOLE) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot (gapless from 0 in each shard), grown_shard (null)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = durable(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint").alias("digest"),
        )
    )
    # The ids break ties, so a group of copies that holds a third of all rows spreads over many partitions.
    laid = durable(narrow.repartitionByRange("digest", "doc_id").withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition, not per document
    parts = laid.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    prefix = durable(
        parts.select("part", "bytes", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    )
    total = prefix.agg(F.sum("bytes")).first()[0] or 1
    inside = Window.partitionBy("part").orderBy("digest", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = durable(
        laid.join(prefix, "part")
        .withColumn("start", F.col("bytes_before") + F.sum("size").over(inside) - F.col("size"))
        .withColumn("place", F.col("rows_before") + F.count(F.lit(1)).over(inside) - 1)
        .withColumn("shard", F.expr(f"cast(start div (({total} + {shards - 1}) div {shards}) as int)"))
        .select("doc_id", "size", "text_crc32", "digest", "place", "shard")
    )
    # At most one row a shard comes to the driver: the digests at its ends.
    ends = {r["shard"]: r for r in placed.groupBy("shard").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).collect()}
    split = {ends[s]["high"]: s for s in sorted(ends, reverse=True) if s + 1 in ends and ends[s]["high"] == ends[s + 1]["low"]}
    if split:
        small = laid.where(F.col("digest").isin(list(split))).groupBy("digest").agg(F.sum("size").alias("bytes")).collect()
        held = {r["digest"]: split[r["digest"]] for r in small if r["bytes"] <= whole * total / shards}
        shard = F.col("shard")
        for digest, first in held.items():
            shard = F.when(F.col("digest") == digest, F.lit(first)).otherwise(shard)
        placed = placed.withColumn("shard", shard)
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(  # at most ``shards`` rows
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
