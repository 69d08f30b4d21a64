"""Formal assets: manifests, their files and media, sidecars, the content index, and what may come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Explicit schemas; nothing is inferred.
ARTIFACT = "struct<file_name string, role string, content_type string, sha256 string, byte_size bigint, sequence_index int>"
MANIFEST = f"schema_version string, platform string, platform_content_id string, content_type string, archived_at string, assets array<{ARTIFACT}>, broken string"
# Platforms with a name of their own, and extensions of files that may come in.
PLATFORMS = ("douyin", "bilibili", "youtube")
INCOMING = ("mp4", "mov", "mkv", "webm", "flv", "avi", "m4a", "mp3", "wav", "aac")


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """Every asset's manifest below root/platform/content; files that can't be read keep their text in ``broken``."""
    read = spark.read.schema(MANIFEST).options(multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="broken").json(f"{root}/*/*/asset_manifest.json")
    return read.withColumn("folder", F.regexp_replace(F.col("_metadata.file_path"), "/asset_manifest.json$", ""))


def artifact_role(role: Column, content_type: Column) -> Column:
    """VIDEO, AUDIO or IMAGE by an artifact's role or, failing that, its type; null for anything else."""
    clean, kind = F.regexp_replace(F.upper(F.coalesce(role, F.lit(""))), "ARTIFACTROLE\\.", ""), F.lower(F.coalesce(content_type, F.lit("")))
    return F.when((clean == "PRIMARY_VIDEO") | (kind == "video"), "VIDEO").when(clean.isin("AUDIO_TRACK", "BGM") | (kind == "audio"), "AUDIO").when((clean == "ALBUM_IMAGE") | (kind == "image"), "IMAGE")


def formal_type(explicit: Column, artifacts: Column) -> Column:
    """An asset's type: the manifest's own if it is one, else video if any artifact is one, else an album, else null."""
    role = lambda a: artifact_role(a.role, a.content_type)
    has = lambda kind: F.coalesce(F.exists(artifacts, lambda a: role(a) == kind), F.lit(False))
    return F.when(explicit.isin("video", "image_album"), explicit).when(has("VIDEO"), "video").when(has("IMAGE"), "image_album")


def formal_assets(found: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Manifests with canonical_id, type and the first fault (null for sound ones, so that callers keep or set aside).

    files: folder, file_name, length, sha256 of what there is; without it, neither files nor digests are checked.
    """
    own = found.withColumns({"type": formal_type(F.col("content_type"), F.col("assets")), "canonical_id": F.concat_ws("_", "platform", "platform_content_id")})
    has = lambda kind: F.coalesce(F.exists("assets", lambda a: artifact_role(a.role, a.content_type) == kind), F.lit(False))
    fault = (
        F.when(F.col("broken").isNotNull(), "json")
        .when(F.col("schema_version").isNull() | F.col("platform").isNull() | F.col("platform_content_id").isNull(), "missing_field")
        .when(F.coalesce(F.size("assets"), F.lit(0)) < 1, "no_assets")
        .when(F.exists("assets", lambda a: F.coalesce(a.file_name, F.lit("")) == ""), "no_file_name")
        .when(F.col("type").isNull(), "content_type")
        .when((F.col("type") == "video") & ~has("VIDEO"), "no_video")
        .when((F.col("type") == "image_album") & ~has("IMAGE"), "no_images")
    )
    own = own.withColumn("fault", fault)
    if files is None:
        return own
    told = own.where("fault is null").select("folder", F.posexplode("assets").alias("at", "a")).select("folder", "at", F.col("a.file_name").alias("file_name"), F.col("a.sha256").alias("want"))
    met = told.join(files.select("folder", "file_name", "length", "sha256"), ["folder", "file_name"], "left")
    bad = F.when(F.col("length").isNull(), "missing_file").when(F.col("length") == 0, "empty_file").when((F.coalesce("want", F.lit("")) != "") & (F.col("want") != F.col("sha256")), "other_digest")
    first = met.withColumn("bad", bad).where("bad is not null").groupBy("folder").agg(F.min_by("bad", "at").alias("bad"))
    return own.join(first, "folder", "left").withColumn("fault", F.coalesce("fault", "bad")).drop("bad")


def files_below(spark: SparkSession, root: str, digests: bool = True) -> DataFrame:
    """folder, file_name, length and, if asked for, sha256 of all files; contents are read only for digests."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    names = [F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"), F.regexp_extract("path", "([^/]+)$", 1).alias("file_name"), "length"]
    return read.select(*names, *([F.sha2("content", 256).alias("sha256")] if digests else []))


def one_asset(found: DataFrame, platform: str, content_id: str) -> DataFrame:
    return found.where((F.col("platform") == platform) & (F.col("platform_content_id") == content_id))


def with_metadata(assets: DataFrame, items: DataFrame) -> DataFrame:
    """Assets with what collection knows of them (items: platform, platform_content_id, metadata); null where it knows nothing."""
    return assets.join(items.select("platform", "platform_content_id", "metadata").dropDuplicates(["platform", "platform_content_id"]), ["platform", "platform_content_id"], "left")


def incoming_files(spark: SparkSession, folder: str, before: str, extensions: tuple[str, ...] = INCOMING) -> DataFrame:
    """Files of some extensions that weren't touched since ``before`` (a timestamp, half a minute ago in use), in order; no content is read."""
    found = spark.read.format("binaryFile").option("modifiedBefore", before).load(folder).select("path", "length", "modificationTime")
    return found.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(list(extensions))).orderBy("path")


def normalised_source(source: Column) -> Column:
    """A source with objective fields alone, unknown ones null, and the platform ``other`` unless it has a name."""
    names = ("source_type", "source_url", "platform_content_id", "author_name", "author_id", "title", "published_at", "collected_at", "original_filename")
    platform = F.when(source["platform"].isin(list(PLATFORMS)), source["platform"]).otherwise("other")
    return F.when(source.isNotNull(), F.struct(platform.alias("platform"), *[source[n].alias(n) for n in names]))


SIDECAR = "schema_version string, source struct<platform string, source_type string, source_url string, platform_content_id string, author_name string, author_id string, title string, published_at string, collected_at string, original_filename string>"


def sidecars(spark: SparkSession, pattern: str) -> DataFrame:
    """path (of the medium) and source of every sidecar file, whose name is the medium's with .source.json."""
    read = spark.read.schema(SIDECAR).option("multiLine", True).json(pattern).withColumn("path", F.regexp_replace(F.col("_metadata.file_path"), r"\.source\.json$", ""))
    return read.select("path", normalised_source(F.col("source")).alias("source")).where("source is not null")


def first_source(media: DataFrame, known: DataFrame) -> DataFrame:
    """Of each asset (asset, paths: an array in order of preference) the first path's source that there is."""
    tried = media.select("asset", F.posexplode("paths").alias("at", "path")).join(known, "path")
    return media.select("asset").join(tried.groupBy("asset").agg(F.min_by("source", "at").alias("source")), "asset", "left")


def write_sidecars(sources: DataFrame, folder: str) -> None:
    """A file a medium: path below the folder, with the normalised source. sources: name, source."""
    told = sources.select("name", F.to_json(F.struct(F.lit("source-v1").alias("schema_version"), normalised_source(F.col("source")).alias("source"))).alias("value"))
    told.write.partitionBy("name").mode("append").text(folder)


def write_report(report: DataFrame, folder: str) -> None:
    """An evaluation's rows as one JSON file; they are as few as the golden queries."""
    report.coalesce(1).write.mode("overwrite").json(folder)


def indexed(index: DataFrame, new: DataFrame) -> DataFrame:
    """The content index (hash, video_id, updated_at), where a hash that comes again takes the newer entry."""
    both = index.unionByName(new)
    return both.groupBy("hash").agg(F.max_by("video_id", "updated_at").alias("video_id"), F.max("updated_at").alias("updated_at"))


def upserted(table: DataFrame, rows: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """A keyed table after rows were put in; the columns in ``keep`` stay those of the row that was there."""
    names = [c for c in table.columns if c not in keys]
    own = rows.select(*keys, *[F.col(c).alias(f"n_{c}") for c in names], F.lit(True).alias("n_"))
    both = table.withColumn("o_", F.lit(True)).join(own, keys, "full_outer")
    pick = lambda c: F.when(F.col("o_").isNull() | (F.col("n_").isNotNull() & F.lit(c not in keep)), F.col(f"n_{c}")).otherwise(F.col(c))
    return both.select(*keys, *[pick(c).alias(c) for c in names])


def listed(items: DataFrame, limit: int, offset: int = 0, active: bool | None = None) -> DataFrame:
    """A page of items, the last seen first, ties by their number."""
    own = items if active is None else items.where(F.col("active") == active)
    return own.orderBy(F.desc("last_seen"), "content_id").offset(offset).limit(limit)


def found(table: DataFrame, **key) -> DataFrame:
    """Rows by a point lookup."""
    for name, value in key.items():
        table = table.where(F.col(name) == value)
    return table


def exists(table: DataFrame, **key) -> bool:
    return not found(table, **key).isEmpty()
