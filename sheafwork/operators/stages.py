"""Stages of processing an asset: which have to run again, and loops that end when nothing is left to do."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The stages of an asset, in order.
STAGES = ("source", "audio", "asr", "visual", "knowledge", "publish_media")


def due_stages(states: DataFrame, wanted: DataFrame, depends: dict[str, tuple[str, ...]], stages: tuple[str, ...] = STAGES) -> DataFrame:
    """asset, stage, reason of every stage that has to run: pending, failed, changed (its own fingerprint), upstream.

    states: asset, stage, status, fingerprint; wanted: asset, stage, fingerprint as it should be now (null where a stage has
    none). depends: the stages whose change sends a stage back. A stage that is missing in the states is pending.
    """
    order = F.create_map(*[F.lit(x) for n, s in enumerate(stages) for x in (s, n)])
    row = wanted.select("asset", "stage", F.col("fingerprint").alias("want")).join(states, ["asset", "stage"], "left")
    done = F.col("status").isin("completed", "skipped")
    own = F.when(~F.coalesce(done, F.lit(False)), F.when(F.col("status") == "failed", "failed").otherwise("pending")).when(F.col("want").isNotNull() & ~F.col("want").eqNullSafe(F.col("fingerprint")), "changed")
    row = row.withColumn("own", own)
    upstream = F.lit(None).cast("string")
    for stage, before in depends.items():
        moved = F.max(F.when(F.col("stage").isin(list(before)) & (F.col("own") == "changed"), 1)).over(Window.partitionBy("asset"))  # a row a stage
        upstream = F.when((F.col("stage") == stage) & (moved == 1), "upstream").otherwise(upstream)
    return row.withColumn("reason", F.coalesce("own", upstream)).where("reason is not null").select("asset", "stage", order[F.col("stage")].alias("place"), "reason")


def overall(states: DataFrame) -> DataFrame:
    """Per asset: FAILED with a failed stage, COMPLETED if all are done, else PROCESSING."""
    done = F.col("status").isin("completed", "skipped")
    return states.groupBy("asset").agg(F.when(F.max(F.col("status") == "failed"), "FAILED").when(F.min(done), "COMPLETED").otherwise("PROCESSING").alias("status"))


def until_idle(step: Callable[[int], int], most: int = 1000) -> int:
    """Repeats a step (a micro-batch that returns how much it did) until it does nothing; the number of steps that did something."""
    for n in range(most):
        if not step(n):
            return n
    return most


def extraction_totals(candidates: DataFrame, rejections: DataFrame) -> DataFrame:
    """Per asset and chunk: accepted, rejected and raw candidates. Both: asset, chunk_id."""
    both = candidates.select("asset", "chunk_id", F.lit(1).alias("good")).unionByName(rejections.select("asset", "chunk_id", F.lit(0).alias("good")))
    return both.groupBy("asset", "chunk_id").agg(F.count_if(F.col("good") == 1).alias("accepted"), F.count_if(F.col("good") == 0).alias("rejected"), F.count(F.lit(1)).alias("raw"))


def evidence_order(items: DataFrame) -> DataFrame:
    """Items with their place in the asset: speech by start, order and id; images by sequence, recognised text before descriptions."""
    visual = F.when(F.col("modality") == "visual_text", 0).otherwise(1)
    spoken = F.col("modality") == "speech"
    keys = [F.when(spoken, 0).otherwise(1), F.when(spoken, F.col("start")).otherwise(F.col("sequence_index").cast("double")), F.when(spoken, F.col("segment_order")).otherwise(visual), F.col("evidence_id")]
    return items.withColumn("place", F.row_number().over(Window.partitionBy("asset").orderBy(*keys)))


def collection_state(seen: DataFrame) -> DataFrame:
    """State of items after one sighting each: seen (content_id, observed_at, position, reappears) beside what was known
    (p_first, p_count, p_active, p_reappeared; all null for a new item) -> first_seen, last_seen, reappeared_at, observed_count, is_first, is_reappearance."""
    known = F.col("p_active").isNotNull()
    back = known & (~F.col("p_active") | F.coalesce("reappears", F.lit(False)))
    return seen.select(
        "content_id", F.coalesce("p_first", "observed_at").alias("first_seen"), F.col("observed_at").alias("last_seen"), F.when(back, F.col("observed_at")).when(known, F.col("p_reappeared")).alias("reappeared_at"),
        F.greatest(F.lit(1), F.coalesce("p_count", F.lit(0)) + 1).cast("bigint").alias("observed_count"), F.col("position").alias("last_position"), (~known).alias("is_first"), F.coalesce(back, F.lit(False)).alias("is_reappearance"),
    )
