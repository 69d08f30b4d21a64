"""Raw collection pages into canonical items: one select over parsed JSON, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.functions.scalars import hashtags, published_at

# The fields of a raw item that are read.
_URLS = "struct<url_list: array<string>, uri: string>"
RAW = (
    "aweme_id string, desc string, create_time bigint, aweme_type int, media_type int, author_user_id string, text_extra array<struct<hashtag_name: string>>, "
    f"author struct<uid: string, sec_uid: string, unique_id: string, short_id: string, nickname: string, signature: string, avatar_thumb: {_URLS}>, "
    f"video struct<duration: bigint, width: int, height: int, ratio: string, cover: {_URLS}, play_addr: {_URLS}, bit_rate: array<struct<gear_name: string, quality_type: int, bit_rate: bigint, format: string, play_addr: {_URLS}>>>, "
    "music struct<id: string, title: string, author: string>, images array<struct<uri: string, url_list: array<string>, download_url_list: array<string>, width: int, height: int>>, "
    "chapter_list array<struct<timestamp: bigint, desc: string, detail: string>>, statistics struct<digg_count: bigint, comment_count: bigint, share_count: bigint, collect_count: bigint>"
)
ALBUM_TYPE, ALBUM_MEDIA = 68, 2


def _some(c: Column) -> Column:
    """Null where a text is empty."""
    return F.when(c != "", c)


def _first(urls: Column) -> Column:
    return _some(F.get(urls, F.lit(0)))


def parsed(pages: DataFrame, column: str = "raw") -> DataFrame:
    """Raw item texts parsed by the fixed schema into a struct ``item``; broken ones keep a null id."""
    return pages.withColumn("item", F.from_json(F.col(column), RAW, {"mode": "PERMISSIVE"}))


def content_type(item: str = "item") -> Column:
    c = lambda name: F.col(f"{item}.{name}")
    album = (c("aweme_type") == ALBUM_TYPE) | (c("media_type") == ALBUM_MEDIA) | (F.size(F.coalesce(c("images"), F.array())) > 0)
    return F.when(F.coalesce(album, F.lit(False)), "image_album").otherwise("video")


def tags(item: str = "item") -> Column:
    """Given hashtags, cleaned and distinct in order, else those in the description."""
    named = F.transform(F.coalesce(F.col(f"{item}.text_extra"), F.array()), lambda t: F.trim(F.regexp_replace(F.coalesce(t.hashtag_name, F.lit("")), "^#+", "")))
    named = F.array_distinct(F.filter(named, lambda t: t != ""))
    return F.when(F.size(named) > 0, named).otherwise(F.coalesce(hashtags(F.col(f"{item}.desc")), F.array().cast("array<string>")))


def canonical_items(pages: DataFrame, profile_base: str = "") -> DataFrame:
    """content_id, content_type, title, description, tags, author, published_at, media, chapters, statistics of each item."""
    c = lambda name: F.col(f"item.{name}")
    author = F.struct(
        F.coalesce(_some(c("author.uid")), _some(c("author_user_id")), F.lit("0")).alias("platform_author_id"), _some(c("author.sec_uid")).alias("sec_uid"),
        F.coalesce(_some(c("author.unique_id")), _some(c("author.short_id"))).alias("username"), F.coalesce(_some(c("author.nickname")), F.lit("Unknown Author")).alias("display_name"),
        _first(c("author.avatar_thumb.url_list")).alias("avatar_url"), F.concat(F.lit(profile_base), _some(c("author.sec_uid"))).alias("profile_url"), _some(c("author.signature")).alias("signature"),
    )
    images = F.transform(
        c("images"), lambda x, i: F.struct(i.alias("index"), _some(x.uri).alias("asset_id"), F.coalesce(_first(x.url_list), _first(x.download_url_list), F.lit("")).alias("url"), F.when(x.width > 0, x.width).alias("width"), F.when(x.height > 0, x.height).alias("height"))
    )
    variants = F.filter(
        F.transform(F.coalesce(c("video.bit_rate"), F.array()), lambda b: F.struct(b.gear_name.alias("gear_name"), F.coalesce(b.quality_type, F.lit(0)).alias("quality_type"), F.coalesce(b.bit_rate, F.lit(0)).alias("bit_rate"), b.format.alias("format"), _first(b.play_addr.url_list).alias("url"))),
        lambda v: v.url.isNotNull(),
    )
    media = F.struct(
        (F.coalesce(_some(c("music.id")).isNotNull(), F.lit(False)) | c("video.play_addr").isNotNull()).alias("has_audio"), F.round(c("video.duration") / 1000, 3).alias("duration_seconds"), c("video.duration").alias("duration_ms"),
        F.when(c("video.width") > 0, c("video.width")).alias("width"), F.when(c("video.height") > 0, c("video.height")).alias("height"), _some(c("video.ratio")).alias("aspect_ratio"), _first(c("video.cover.url_list")).alias("cover_url"),
        _some(c("video.cover.uri")).alias("cover_asset_id"), _some(c("video.play_addr.uri")).alias("video_asset_id"), F.when(content_type() == "image_album", images).alias("images"), _some(c("music.title")).alias("audio_title"), _some(c("music.author")).alias("audio_author"),
        F.filter(F.coalesce(c("video.play_addr.url_list"), F.array().cast("array<string>")), lambda u: u != "").alias("play_urls"), variants.alias("bitrate_variants"),
    )
    chapters = F.transform(c("chapter_list"), lambda x: F.struct(F.coalesce(x.timestamp, F.lit(0)).alias("timestamp_ms"), F.coalesce(x["desc"], F.lit("")).alias("title"), _some(x.detail).alias("description")))
    title = F.coalesce(_some(F.substring(c("desc"), 1, 30)), c("aweme_id"))
    return pages.where(F.coalesce(c("aweme_id"), F.lit("")) != "").select(
        *[x for x in pages.columns if x not in ("raw", "item")], c("aweme_id").alias("content_id"), content_type().alias("content_type"), title.alias("title"), c("desc").alias("description"), tags().alias("tags"), author.alias("author"),
        published_at(c("create_time")).alias("published_at"), media.alias("media"), F.when(F.size(chapters) > 0, chapters).alias("chapters"), c("statistics").alias("statistics"),
    )


def media_type(duration: Column, has_video: Column, has_audio: Column) -> Column:
    """What a probed file is; without a length or streams it's invalid."""
    return F.when(~F.coalesce(duration > 0, F.lit(False)), "invalid").when(has_video & has_audio, "audio_video").when(has_video, "video_only").when(has_audio, "audio_only").otherwise("invalid")


def platform(name: Column, known: tuple[str, ...]) -> Column:
    return F.when(name.isin(list(known)), name).otherwise("other")


def kept_lines(texts: Column, scores: Column, least: float = 0.65) -> Column:
    """Recognised lines that aren't blank and score at least ``least``: (text, score), in order."""
    both = F.arrays_zip(texts.alias("t"), scores.alias("s"))
    return F.transform(F.filter(both, lambda x: (F.trim(x["t"]) != "") & (x["s"] >= least)), lambda x: F.struct(F.trim(x["t"]).alias("text"), x["s"].alias("score")))


def line_confidence(lines: Column) -> Column:
    """Mean score of kept lines, four places; null without any."""
    return F.when(F.size(lines) > 0, F.bround(F.aggregate(lines, F.lit(0.0), lambda a, x: a + x.score) / F.size(lines), 4))


def text_suffices(status: Column, confidence: Column, text: Column, reasons: Column, least: float = 0.65) -> Column:
    """Whether recognised text alone answers a request about configuration or paths."""
    return (status == "completed") & (confidence >= least) & (F.trim(text) != "") & F.arrays_overlap(reasons, F.array(F.lit("configuration"), F.lit("path_or_ui")))


def album_confidence(texts: Column, scores: Column, least: float = 0.65) -> Column:
    """An image's mean score, four places: of its kept lines, or of all scores where none is kept; 0 without any."""
    kept = F.transform(kept_lines(texts, scores, least), lambda x: x.score)
    told = F.when(F.size(kept) > 0, kept).otherwise(F.filter(scores, lambda x: x.isNotNull()))
    return F.when(F.size(told) > 0, F.bround(F.aggregate(told, F.lit(0.0), lambda a, x: a + x) / F.size(told), 4)).otherwise(0.0)


# What stands for a page that wasn't archived.
INLINE_TYPE, INLINE_FILE = "douyin.listcollection.aweme_struct", "unarchived/inline.json"


def raw_reference(archived: Column, position: Column) -> Column:
    """Where an item's raw form lies: struct(platform_raw_type, archive_file, sha256, item_index), or a stand-in of zeros."""
    inline = F.struct(F.lit(INLINE_TYPE).alias("platform_raw_type"), F.lit(INLINE_FILE).alias("archive_file"), F.lit("0" * 64).alias("sha256"), position.cast("int").alias("item_index"))
    return F.coalesce(archived, inline)


def older_projection(content_id: Column, title: Column, description: Column, first_seen: Column, author: Column) -> Column:
    """An item as older readers know it. author: struct(display_name, sec_uid, platform_author_id, ...)."""
    return F.struct(
        first_seen.alias("collected_at"), author.display_name.alias("author_name"), F.coalesce(_some(author.sec_uid), author.platform_author_id).alias("author_id"), F.coalesce(_some(title), _some(F.substring(description, 1, 30))).alias("title"),
        F.concat(content_id, F.lit(".mp4")).alias("original_filename"),
    )
