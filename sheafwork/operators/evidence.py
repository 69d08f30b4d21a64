"""Evidence: gap merging, speech windows, transcript chunks, visual cues, image batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.functions.scalars import estimated_tokens

# Phrases by which a speaker points at the screen.
CUES = {
    "screen_reference": ("如图", "图中", "这张图", "大家看", "直接看", "参考我这个页面", "可参考", "屏幕上", "右边", "左边", "上面", "下面", "这边"),
    "configuration": ("配置", "参数", "这个选项", "这个按钮", "这里填", "这里选择", "改成这个", "按照这个", "按照这里", "如下所示"),
    "path_or_ui": ("目录", "路径", "页面", "工作流", "节点", "选择", "性能界面", "填在"),
}
#: Of the last kind, phrases that suffice alone.
PLACES = ("目录", "路径", "页面", "工作流", "节点", "性能界面")
SECONDS, TOKENS, SEGMENTS, OVERLAP = 120.0, 1000, 50, 2


def gap_merge(rows: DataFrame, key: str, start: str, end: str, gap: float, order: list[str]) -> DataFrame:
    """Runs of intervals whose start lies at most ``gap`` behind the furthest end so far: key, number, start, end, members."""
    w = Window.partitionBy(key).orderBy(start, end, *order)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col(start) - reach > gap), 1).otherwise(0)
    numbered = rows.withColumn("_fresh", fresh).withColumn("run", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(key, "run").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count(F.lit(1)).alias("members"))


def _sized(segments: DataFrame, key: str) -> DataFrame:
    return segments.select(F.col(key).alias("asset"), "segment_id", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), F.coalesce(estimated_tokens(F.col("text")), F.lit(1)).cast("int").alias("tokens"))


def speech_chunks(segments: DataFrame, key: str, seconds: float = SECONDS, tokens: int = TOKENS, most: int = SEGMENTS, overlap: int = OVERLAP) -> DataFrame:
    """Greedy windows under three budgets with bounded overlap; where a window begins depends on where the last one
    ended, so an asset's segments, narrow rows without their text, are walked in one pandas group."""

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["start", "segment_id"])
        begin, stop, size, ids = (rows[c].tolist() for c in ("start", "end", "tokens", "segment_id"))
        out, first, carried = [], 0, 0
        while first < len(ids):
            after, used = first, 0
            while after < len(ids) and (after == first or (stop[after] - begin[first] <= seconds and used + size[after] <= tokens and after - first < most)):
                used += size[after]
                after += 1
            out.append((rows["asset"].iloc[0], len(out) + 1, ids[first], ids[after - 1], after - first, carried, used))
            if after == len(ids):
                break
            carried = min(overlap, after - first - 1) if overlap > 0 else 0
            first = max(after - carried, first + 1)
        return pd.DataFrame(out, columns=["asset", "chunk", "first_segment", "last_segment", "n_segments", "n_overlap", "tokens"])

    sized = _sized(segments, key)
    kind = sized.schema["asset"].dataType.simpleString()
    return sized.groupBy("asset").applyInPandas(walk, f"asset {kind}, chunk int, first_segment string, last_segment string, n_segments int, n_overlap int, tokens int")


def transcript_chunks(segments: DataFrame, key: str, tokens: int, overlap: int) -> DataFrame:
    """Chunks under a token budget; the last segments are carried over until they hold ``overlap`` tokens."""
    if tokens <= 0 or not 0 <= overlap < tokens:
        raise ValueError("the overlap must be smaller than the chunk")

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["start", "segment_id"])
        size, ids = [t + 12 for t in rows["tokens"]], rows["segment_id"].tolist()
        out, first, before = [], 0, 0
        while True:
            after, used = first, 0
            while after < len(ids) and (after == first or used + size[after] <= tokens):
                used += size[after]
                after += 1
            out.append((rows["asset"].iloc[0], len(out) + 1, ids[first], ids[after - 1], max(0, before - first), used))
            if after >= len(ids):
                break
            before, back, held = after, after - 1, size[after - 1]
            while back > first and held < overlap:
                back -= 1
                held += size[back]
            if back == first:  # the whole chunk would be carried over: go on by one segment
                back = min(first + 1, after)
            first = back
        return pd.DataFrame(out, columns=["asset", "chunk", "first_segment", "last_segment", "n_overlap", "tokens"])

    sized = _sized(segments, key)
    kind = sized.schema["asset"].dataType.simpleString()
    return sized.groupBy("asset").applyInPandas(walk, f"asset {kind}, chunk int, first_segment string, last_segment string, n_overlap int, tokens int")


def cues(text):
    """Kinds of pointing phrases in a text, in order."""
    found = [F.when(text.rlike("|".join(phrases)), kind) for kind, phrases in CUES.items()]
    kinds = F.filter(F.array(*found), lambda k: k.isNotNull())
    lone = (F.size(kinds) == 1) & (F.get(kinds, F.lit(0)) == "path_or_ui") & ~text.rlike("|".join(PLACES))
    return F.when(lone, F.array().cast("array<string>")).otherwise(kinds)


def cue_requests(segments: DataFrame, key: str, before: float = 3.0, behind: float = 4.0, gap: float = 12.0, longest: float = 24.0, most: int = 12) -> DataFrame:
    """Requests to look at the picture: cued segments with the next one if it follows within a second, merged while the
    kind's score is the same, the gap small and the span short; the most telling ones in order of time."""
    w = Window.partitionBy(key).orderBy("start", "segment_id")
    found = segments.select(F.col(key).alias("asset"), "segment_id", "start", "end", cues(F.col("text")).alias("kinds"), F.lead("segment_id").over(w.orderBy("start", "segment_id")).alias("next_id"), F.lead("start").over(w).alias("next_start"), F.lead("end").over(w).alias("next_end")).where(F.size("kinds") > 0)

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        merged: list[dict] = []
        for r in rows.sort_values(["start", "segment_id"]).itertuples():
            near = r.next_id is not None and r.next_start - r.end <= 1.0
            kinds = list(r.kinds)
            new = {"ids": [r.segment_id] + [r.next_id] * near, "start": round(max(0.0, r.start - before), 3), "end": round((r.next_end if near else r.end) + behind, 3), "kinds": kinds}
            new["score"] = 3 if "screen_reference" in kinds else 2 if "configuration" in kinds else 1
            last = merged[-1] if merged else None
            if last and new["score"] == last["score"] and new["start"] - last["end"] <= gap and max(last["end"], new["end"]) - last["start"] <= longest:
                last["end"] = max(last["end"], new["end"])
                last["ids"] = list(dict.fromkeys(last["ids"] + new["ids"]))
                last["kinds"] = list(dict.fromkeys(last["kinds"] + new["kinds"]))
                last["score"] = 3 if "screen_reference" in last["kinds"] else 2 if "configuration" in last["kinds"] else 1
            else:
                merged.append(new)
        top = sorted(sorted(merged, key=lambda m: (-m["score"], m["start"]))[:most], key=lambda m: m["start"])
        out = [(rows["asset"].iloc[0], f"vr_{k:03d}", ",".join(m["ids"]), m["start"], m["end"], ", ".join(m["kinds"])) for k, m in enumerate(top, 1)]
        return pd.DataFrame(out, columns=["asset", "request_id", "segments", "start", "end", "reason"])

    kind = found.schema["asset"].dataType.simpleString()
    return found.groupBy("asset").applyInPandas(walk, f"asset {kind}, request_id string, segments string, start double, end double, reason string")


def image_batches(items: DataFrame, key: str, sequence: str, size: int = 5) -> DataFrame:
    """Batches of ``size`` distinct images; an image's items stay together."""
    return items.withColumn("batch", (F.floor((F.dense_rank().over(Window.partitionBy(key).orderBy(sequence)) - 1) / size)).cast("int"))


def semantic_excerpt(modality, text, description, status):
    """The text that may be cited of a piece of evidence; null where there is none. Nothing is inferred from anything else."""
    some = lambda c: F.when(F.trim(F.coalesce(c, F.lit(""))) != "", c)
    described = F.when(~status.eqNullSafe("unresolved_visual_reference"), F.coalesce(some(description), some(text)))
    return F.when(modality.isin("speech", "visual_text"), some(text)).when(modality == "visual_description", described).otherwise(F.coalesce(some(text), some(description)))


def numbered_chunks(chunks: DataFrame, key: str, order: str) -> DataFrame:
    """Chunks with their ids chk_000001, chk_000002, ... in order within an asset."""
    return chunks.withColumn("chunk_id", F.format_string("chk_%06d", F.row_number().over(Window.partitionBy(key).orderBy(order))))


def spans_text(rows: DataFrame, key: str, gap: float = 6.0) -> DataFrame:
    """Per key, runs of segments (start, end, segment_id) at most ``gap`` apart, as text: 00:00:01–00:00:09 (seg_1, seg_2); ..."""
    from sheafwork.functions.scalars import clock

    w = Window.partitionBy(key).orderBy("start", "end", "segment_id")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = rows.withColumn("fresh", F.when(reach.isNull() | (F.col("start") - reach > gap), 1).otherwise(0)).withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "segment_id"))), lambda x: x.segment_id), ", ")
    each = runs.groupBy(key, "run").agg(F.min("start").alias("b"), F.max("end").alias("e"), ids.alias("ids")).withColumn("t", F.concat(clock(F.col("b")), F.lit("–"), clock(F.col("e")), F.lit(" ("), "ids", F.lit(")")))
    return each.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "t"))), lambda x: x.t), "; ").alias("text"))


def visual_line(source_type, start, end, evidence_id, text):
    """A line of a list of visual evidence; null where it has no text."""
    from sheafwork.functions.scalars import clock

    label = F.when(source_type == "visual_ocr", "OCR").when(source_type == "visual_vlm", "VLM").otherwise("Visual")
    return F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.lit("- ["), label, F.lit("] "), clock(start), F.lit("–"), clock(end), F.lit(" ["), evidence_id, F.lit("]: "), text))
