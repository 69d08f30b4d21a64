"""Older forms of knowledge, source metadata, formal artifacts, and the account's preflight."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.functions.scalars import normalised_statement, unit_id
from sheafwork.plans.views import STATUSES, UNIT_TYPES

# What older types are called now, modalities that a machine saw, platforms by their label.
TYPES = {"author_claim": "claim", "author_opinion": "opinion", "verification_question": "verification_question"}
PERCEPTUAL = ("visual_text", "visual_description", "perceptual_metric")
LABELS = {"douyin": "Douyin", "bilibili": "Bilibili", "youtube": "YouTube", "other": "Other"}


def _some(c: Column) -> Column:
    return F.when(c != "", c)


def adapted(points: DataFrame) -> DataFrame:
    """Older points (canonical_id, id, type, title, content, confidence, verification_status, evidence_ids) as units.

    A type that is neither old nor new, and an unknown status, give a fault instead of a unit. A question is derived by the
    system, all else comes from a speaker who isn't verified.
    """
    kind = F.coalesce(F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])[F.col("type")], F.coalesce("type", F.lit("claim")))
    status = F.coalesce("verification_status", F.lit("not_checked"))
    statement = normalised_statement(F.coalesce(_some(F.col("content")), _some(F.col("title")), F.lit("")))
    fault = F.when(~kind.isin(list(UNIT_TYPES)), "unit_type").when(~status.isin(list(STATUSES)), "verification_status")
    rows = points.select(
        "canonical_id", kind.alias("unit_type"), statement.alias("statement"), F.coalesce("confidence", F.lit(0.9)).alias("confidence"), status.alias("verification_status"), F.col("id").alias("candidate_id"), "evidence_ids", fault.alias("fault")
    )
    rows = rows.withColumn("knowledge_unit_id", F.when(F.col("fault").isNull(), unit_id(F.col("canonical_id"), F.col("unit_type"), F.col("evidence_ids"), F.col("statement"))))
    return rows.withColumns({"candidate_id": F.coalesce("candidate_id", "knowledge_unit_id"), "attribution": F.when(F.col("unit_type") == "verification_question", "system_derived").otherwise("unverified_speaker")})


class Checked(NamedTuple):
    faults: DataFrame
    points: DataFrame


def checked_answer(points: DataFrame, segments: DataFrame, visual: DataFrame) -> Checked:
    """A model's answer about one chunk of each asset against what it may cite.

    points: asset, position, type, title, content, segment_ids, visual_ids (null: none); segments: asset, segment_id, start, end;
    visual: asset, evidence_id, status. Faults: type, no_text, no_segments, unknown_segment, unfinished_visual; one rejects the
    asset's answer. Sound points get their ids, different citations in order, and the span of their segments.
    """
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    cited = points.select("asset", "position", F.posexplode(F.array_distinct("segment_ids")).alias("at", "segment_id")).join(segments, ["asset", "segment_id"], "left")
    spoken = cited.groupBy("asset", "position").agg(F.count_if(F.col("start").isNull()).alias("unknown"), F.min("start").alias("start"), F.max("end").alias("end"))
    seen = points.select("asset", "position", F.explode("visual_ids").alias("evidence_id")).join(visual.where("status = 'completed'").select("asset", "evidence_id", F.lit(True).alias("good")), ["asset", "evidence_id"], "left")
    shown = seen.groupBy("asset", "position").agg(F.count_if(F.col("good").isNull()).alias("unfinished"))
    row = points.join(spoken, ["asset", "position"], "left").join(shown, ["asset", "position"], "left")
    fault = (
        F.when(~F.coalesce(F.col("type").isin(list(TYPES)), F.lit(False)), "type")
        .when(~(text("title") & text("content")), "no_text")
        .when(F.coalesce(F.size("segment_ids"), F.lit(0)) < 1, "no_segments")
        .when(F.col("unknown") > 0, "unknown_segment")
        .when(F.col("unfinished") > 0, "unfinished_visual")
    )
    row = row.withColumn("fault", fault)
    faults = row.where("fault is not null").select("asset", "position", "fault")
    sound = row.join(faults.select("asset").distinct(), "asset", "left_anti")
    number = F.row_number().over(Window.partitionBy("asset").orderBy("position"))
    distinct = lambda c: F.array_distinct(F.coalesce(c, F.array().cast("array<string>")))
    return Checked(faults, sound.select("asset", F.format_string("k_%03d", number).alias("id"), "type", F.trim("title").alias("title"), F.trim("content").alias("content"), distinct("segment_ids").alias("segment_ids"), distinct("visual_ids").alias("visual_ids"), "start", "end"))


class Merged(NamedTuple):
    faults: DataFrame
    points: DataFrame


def merged(local: DataFrame, proposals: DataFrame) -> Merged:
    """Local points merged by a model's proposals, across one asset's chunks.

    local: asset, local_id, position, type, title, content, segment_ids; proposals: asset, position, type, title, content,
    source_ids. A proposal may only cite known points of its own asset and type (faults: no_text, no_sources, unknown_source,
    other_type); one fault rejects the asset's merge. Points that no proposal cites stay, after the merged ones, in order.
    """
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    cited = proposals.select("asset", "position", F.col("type").alias("want"), F.explode(F.array_distinct("source_ids")).alias("local_id"))
    known = cited.join(local.select("asset", "local_id", F.col("type").alias("has")), ["asset", "local_id"], "left")
    checks = known.groupBy("asset", "position").agg(F.count_if(F.col("has").isNull()).alias("unknown"), F.count_if(F.col("has") != F.col("want")).alias("other"))
    told = proposals.join(checks, ["asset", "position"], "left")
    fault = F.when(~(text("title") & text("content")), "no_text").when(F.coalesce(F.size("source_ids"), F.lit(0)) < 1, "no_sources").when(F.col("unknown") > 0, "unknown_source").when(F.col("other") > 0, "other_type")
    faults = told.withColumn("fault", fault).where("fault is not null").select("asset", "position", "fault")
    sound = told.join(faults.select("asset").distinct(), "asset", "left_anti")
    used = cited.select("asset", "local_id").distinct()
    left = local.join(used, ["asset", "local_id"], "left_anti").join(faults.select("asset").distinct(), "asset", "left_anti")
    spans = cited.join(local.select("asset", "local_id", "segment_ids"), ["asset", "local_id"]).groupBy("asset", "position").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("segment_ids")))).alias("segment_ids"))
    merged_rows = sound.join(spans, ["asset", "position"]).select(
        "asset", F.lit(0).alias("late"), "position", "type", F.trim("title").alias("title"), F.trim("content").alias("content"), F.array_distinct("source_ids").alias("source_ids"), "segment_ids"
    )
    kept = left.select("asset", F.lit(1).alias("late"), "position", "type", "title", "content", F.array("local_id").alias("source_ids"), "segment_ids")
    order = Window.partitionBy("asset").orderBy("late", "position")
    points = merged_rows.unionByName(kept).withColumn("id", F.format_string("k_%03d", F.row_number().over(order)))
    return Merged(faults, points.select("asset", "id", "type", "title", "content", "source_ids", "segment_ids", (F.col("late") == 1).alias("preserved")))


def ungrounded(units: DataFrame, evidence: DataFrame) -> DataFrame:
    """Observations that cite nothing a machine saw. units: unit_id, unit_type, evidence_ids; evidence: evidence_id, modality."""
    own = units.where("unit_type = 'observation'")
    seen = own.select("unit_id", F.explode("evidence_ids").alias("evidence_id")).join(evidence.where(F.col("modality").isin(list(PERCEPTUAL))), "evidence_id", "left_semi")
    return own.select("unit_id").join(seen.select("unit_id").distinct(), "unit_id", "left_anti")


def source_snapshot(meta: Column, title: Column, content_id: Column, video_base: str) -> Column:
    """What is known of a source, from its metadata (JSON text), an asset's title and its number, in a fixed shape."""
    get = lambda path: _some(F.get_json_object(meta, path))
    author = get("$.author")
    is_object = author.startswith("{")
    name = F.coalesce(F.when(is_object, F.coalesce(get("$.author.display_name"), get("$.author.username"))).otherwise(author), get("$.author_name"))
    author_id = F.coalesce(F.when(is_object, F.coalesce(get("$.author.platform_author_id"), get("$.author.sec_uid"))), get("$.author_id"))
    shown = F.coalesce(get("$.title"), F.when(~title.eqNullSafe(content_id), title))
    published, seen = get("$.published_at"), F.coalesce(get("$.first_seen_at"), get("$.collection.first_seen_at"))
    tags = F.coalesce(F.from_json(F.get_json_object(meta, "$.tags"), "array<string>"), F.array().cast("array<string>"))
    known = _some(shown).isNotNull() | name.isNotNull() | (F.size(tags) > 0) | published.isNotNull() | seen.isNotNull()
    return F.struct(
        F.when(known, "enriched").otherwise("unenriched").alias("enrichment_status"), shown.alias("title"), name.alias("author_name"), author_id.alias("author_id"), published.alias("published_at"), seen.alias("first_seen_at"),
        F.coalesce(get("$.source_url"), F.concat(F.lit(video_base), content_id)).alias("source_url"), tags.alias("tags"),
    )


def bound_artifacts(content_type: Column, video: Column, images: Column, audio: Column) -> Column:
    """An asset's artifacts in order: its video, or its images by sequence, then its audio.

    video and audio: struct(file_name, sha256, byte_size) or null; images: array of struct(file_name, sha256, byte_size, sequence_index).
    """
    one = lambda x, role: F.struct(x.file_name.alias("file_name"), F.lit(role).alias("role"), x.sha256.alias("sha256"), x.byte_size.alias("byte_size"), F.lit(None).cast("int").alias("sequence_index"))
    ordered = F.array_sort(F.transform(images, lambda x: F.struct(x.sequence_index.alias("n"), x.alias("x"))))
    album = F.transform(ordered, lambda o: F.struct(o.x.file_name.alias("file_name"), F.lit("ALBUM_IMAGE").alias("role"), o.x.sha256.alias("sha256"), o.x.byte_size.alias("byte_size"), o.n.cast("int").alias("sequence_index")))
    none = F.array().cast("array<struct<file_name: string, role: string, sha256: string, byte_size: bigint, sequence_index: int>>")
    first = F.when((content_type == "video") & video.isNotNull(), F.array(one(video, "PRIMARY_VIDEO"))).when(content_type == "image_album", F.coalesce(album, none)).otherwise(none)
    return F.concat(first, F.when(audio.isNotNull(), F.array(one(audio, "AUDIO_TRACK"))).otherwise(none))


def source_label(platform: Column, author: Column) -> Column:
    named = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])[platform]
    return F.concat(F.coalesce(named, F.lit("Other")), F.lit(" · "), F.coalesce(_some(author), F.lit("未提供")))


# Outcomes of the preflight by rule: auth state, source health, access, may sync, needs the user, retryable, reason, recovery.
PREFLIGHT = {
    "challenge": ("AUTH_CHALLENGE", "HEALTHY", "UNAVAILABLE", False, True, False, "INTERACTIVE_CHALLENGE", "MANUAL_CHALLENGE"),
    "login": ("AUTH_REQUIRED", "HEALTHY", "UNAVAILABLE", False, True, False, "LOGIN_REQUIRED", "MANUAL_LOGIN"),
    "rate": ("AUTH_UNCERTAIN", "RATE_LIMITED", "UNAVAILABLE", False, False, True, "SOURCE_RATE_LIMITED", "RETRY_LATER"),
    "server": ("AUTH_UNCERTAIN", "SERVER_ERROR", "UNAVAILABLE", False, False, True, "SOURCE_SERVER_ERROR", "RETRY_LATER"),
    "network": ("AUTH_UNCERTAIN", "NETWORK_ERROR", "UNAVAILABLE", False, False, True, "SOURCE_NETWORK_ERROR", "RETRY_LATER"),
    "login_403": ("AUTH_REQUIRED", "SOURCE_ERROR", "UNAVAILABLE", False, True, False, "LOGIN_REQUIRED", "MANUAL_LOGIN"),
    "nobody": ("AUTH_UNCERTAIN", "SOURCE_ERROR", "UNKNOWN", False, False, True, "IDENTITY_MISSING", "INVESTIGATE"),
    "ambiguous_403": ("AUTH_UNCERTAIN", "SOURCE_ERROR", "UNAVAILABLE", False, False, True, "SOURCE_HTTP_403_AMBIGUOUS", "RETRY_LATER"),
    "shape": ("AUTH_UNCERTAIN", "SOURCE_ERROR", "UNAVAILABLE", False, False, True, "SOURCE_RESPONSE_INVALID", "INVESTIGATE"),
    "no_scope_empty": ("AUTH_VALID", "HEALTHY", "EMPTY", False, False, True, "ACCOUNT_SCOPE_UNRESOLVED", "INVESTIGATE"),
    "no_scope": ("AUTH_VALID", "HEALTHY", "READABLE", False, False, True, "ACCOUNT_SCOPE_UNRESOLVED", "INVESTIGATE"),
    "empty": ("AUTH_VALID", "HEALTHY", "EMPTY", True, False, False, "COLLECTION_EMPTY", "NONE"),
    "good": ("AUTH_VALID", "HEALTHY", "READABLE", True, False, False, "AUTH_OK", "NONE"),
    "conflict": ("AUTH_UNCERTAIN", "SOURCE_ERROR", "UNKNOWN", False, False, True, "EVIDENCE_CONFLICT", "INVESTIGATE"),
}


def preflight(signals: DataFrame) -> DataFrame:
    """What page and source tell of an account; rules in order, the first one decides.

    signals: challenge_visible, login_modal, identity_present, url, title, scope_id, challenge_hint, http_status,
    platform_status, error_code, error_message, shape_valid, items_readable, collection_empty.
    """
    c = F.col
    yes = lambda name: F.coalesce(c(name), F.lit(False))
    http, platform, url = c("http_status"), c("platform_status"), F.coalesce("url", F.lit(""))
    at_login = url.contains("login") | url.contains("passport")
    message = F.coalesce("error_message", F.lit("")) != ""
    is_ = lambda column, value: F.coalesce(column == value, F.lit(False))
    valid = yes("identity_present") & is_(http, 200) & is_(platform, 0) & yes("items_readable")
    unscoped = F.coalesce("scope_id", F.lit("")) == ""
    rule = (
        F.when(yes("challenge_visible") | (yes("challenge_hint") & (url.contains("verify") | F.coalesce("title", F.lit("")).contains("验证"))), "challenge")
        .when(yes("login_modal") | is_(platform, 8), "login")
        .when(is_(http, 429) | is_(platform, 2154), "rate")
        .when(F.coalesce(http.between(500, 599), F.lit(False)), "server")
        .when(F.coalesce(c("error_code").isin("SOURCE_TIMEOUT", "SOURCE_NETWORK_ERROR"), F.lit(False)) | (http.isNull() & message), "network")
        .when(is_(http, 403), F.when(at_login, "login_403").when(~yes("identity_present"), "nobody").otherwise("ambiguous_403"))
        .when(is_(http, 200) & ~yes("shape_valid"), "shape")
        .when(~yes("identity_present") & ~yes("items_readable"), F.when(at_login, "login").otherwise("nobody"))
        .when(valid & unscoped, F.when(yes("collection_empty"), "no_scope_empty").otherwise("no_scope"))
        .when(valid, F.when(yes("collection_empty"), "empty").otherwise("good"))
        .otherwise("conflict")
    )
    names = ("auth_state", "source_health", "access", "can_sync", "requires_user", "retryable", "reason", "recovery")
    table = F.create_map(*[x for k, row in PREFLIGHT.items() for x in (F.lit(k), F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]))])
    told = signals.withColumn("rule", rule).withColumn("told", table[F.col("rule")])
    return told.select(*signals.columns, "rule", *[F.col(f"told.{n}").alias(n) for n in names])
