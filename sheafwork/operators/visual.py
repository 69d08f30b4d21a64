"""Visual evidence: keyframes, what recognition and description yielded, and which knowledge uses it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most keyframes of a request, and what makes a sampled frame differ from the one before it.
FRAMES, HASH_BITS, SCENE = 5, 7, 0.18


def keyframes(frames: DataFrame, key: str, most: int = FRAMES, bits: int = HASH_BITS, scene: float = SCENE) -> DataFrame:
    """Kept frames of each request, in time: the first, and those whose hash or histogram differs from the frame sampled
    before (not from the last kept one). frames: key, time, dhash (bigint of 64 bits), scene_delta (to the one before)."""
    w = Window.partitionBy(key).orderBy("time")
    distance = F.bit_count(F.col("dhash").bitwiseXOR(F.lag("dhash").over(w)))
    told = frames.withColumn("distance", F.coalesce(distance, F.lit(999))).withColumn("first", F.row_number().over(w) == 1)
    kept = told.where(F.col("first") | (F.col("distance") > bits) | (F.col("scene_delta") > scene))
    numbered = kept.withColumn("n", F.row_number().over(w)).where(F.col("n") <= most)
    return numbered.select(key, F.format_string("frame_%09d", F.bround(F.col("time") * 1000, 0).cast("bigint")).alias("frame_id"), "time", "distance")


def album_status(images: DataFrame, key: str, status: str) -> DataFrame:
    """Per album: images, completed, insufficient and failed ones, and the whole's state."""
    c = F.col(status)
    counts = images.groupBy(key).agg(F.count(F.lit(1)).alias("images"), F.count_if(c == "completed").alias("completed"), F.count_if(c.startswith("insufficient")).alias("insufficient"), F.count_if(c == "failed").alias("failed"))
    overall = F.when(F.col("failed") == 0, "completed").when((F.col("completed") == 0) & (F.col("insufficient") == 0), "failed").otherwise("partial")
    return counts.withColumn("overall", overall)


def hydrated(points: DataFrame, evidence: DataFrame) -> DataFrame:
    """A row a cited piece of visual evidence that was completed: point_id, at (its place among the point's ids), and the evidence.

    points: point_id, visual_ids (an array); evidence: evidence_id, status, source_type, start, end. Ids that are unknown or
    weren't completed drop out.
    """
    cited = points.select("point_id", F.posexplode("visual_ids").alias("at", "evidence_id"))
    return cited.join(evidence.where("status = 'completed'").drop("status"), "evidence_id").select("point_id", "at", "evidence_id", "source_type", "start", "end")


def envelope(points: DataFrame, segments: DataFrame) -> DataFrame:
    """Of each point with spoken evidence (segment_ids, an array): the earliest start and the latest end of its segments."""
    cited = points.select("point_id", F.explode("segment_ids").alias("segment_id")).distinct()
    return cited.join(segments, "segment_id").groupBy("point_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("segments"))


def usage(points: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per kind of source: pieces of evidence, completed ones, and how many points cite it at least once, whatever its state."""
    totals = evidence.groupBy("source_type").agg(F.count(F.lit(1)).alias("evidence"), F.count_if(F.col("status") == "completed").alias("completed"))
    cited = points.select("point_id", F.explode("visual_ids").alias("evidence_id")).join(evidence.select("evidence_id", "source_type"), "evidence_id")
    used = cited.groupBy("source_type").agg(F.countDistinct("point_id").alias("used_by"))
    return totals.join(used, "source_type", "left").withColumn("used_by", F.coalesce("used_by", F.lit(0)))


def chunk_items(chunks: DataFrame, requests: DataFrame, items: DataFrame) -> DataFrame:
    """(chunk_id, item_id): visual items whose request was triggered by a segment of the chunk.

    chunks: chunk_id, segment_ids; requests: request_id, trigger_ids; items: item_id, request_id. An equality join on
    segments, then one row a pair.
    """
    of_chunk = chunks.select("chunk_id", F.explode("segment_ids").alias("segment_id"))
    of_request = requests.select("request_id", F.explode("trigger_ids").alias("segment_id"))
    return of_chunk.join(of_request, "segment_id").select("chunk_id", "request_id").distinct().join(items, "request_id").select("chunk_id", "item_id").distinct()


def answer(raw: Column) -> Column:
    """A describing model's reply (JSON text): resolved with a trimmed answer and confidence, or unresolved with a reason.

    Null where it isn't JSON.
    """
    told = F.from_json(raw, "status string, answer string, confidence double, reason string")
    good = (told.status == "resolved") & (F.trim(F.coalesce(told.answer, F.lit(""))) != "")
    reply = F.struct(
        F.when(good, "resolved").otherwise("unresolved_visual_reference").alias("status"), F.when(good, F.trim(told.answer)).alias("answer"), F.when(good, F.bround(F.coalesce(told.confidence, F.lit(0.0)), 3)).alias("confidence"),
        F.when(~good, F.coalesce(told.reason, F.lit("visual information is insufficient"))).alias("reason"),
    )
    return F.when(F.try_parse_json(raw).isNotNull(), reply)


def json_object(text: Column) -> Column:
    """A model's reply as a JSON object's text, without the fence around it; null where it is none."""
    plain = F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))
    inner = F.regexp_replace(F.regexp_replace(plain, r"^```[^\n]*(?:\n|$)", ""), r"(?:^|\n)[ \t]*```$", "")
    body = F.regexp_replace(F.when(plain.startswith("```"), inner).otherwise(plain), r"^\s+|\s+$", "")
    return F.when(F.try_parse_json(body).isNotNull() & body.startswith("{"), body)
