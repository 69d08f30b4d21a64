"""Sources and sinks: units documents, transcripts, raw pages with their digests, evaluation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Explicit schemas; nothing is inferred.
UNIT = """knowledge_unit_id string, canonical_id string, unit_type string, statement string,
evidence_refs array<struct<evidence_id string, source_excerpt string, temporal_range struct<start double, end double, duration double>, sequence_range struct<sequence_index int>>>,
attribution struct<source_actor_name string, source_actor_id string, speaker_name string, speaker_id string, attribution_status string>,
extraction_confidence double, verification_status string, entities array<struct<entity_name string, category string>>, topics array<string>,
extraction_lineage struct<extraction_run_id string, input_chunk_ids array<string>, candidate_id string, source_candidate_ids array<string>, merge_strategy string>"""
VERSION = "knowledge-units-v1"


def unit_schema():
    from pyspark.sql.types import StructType

    return StructType.fromDDL(UNIT)


def units_documents(spark: SparkSession, root: str) -> DataFrame:
    """Final units documents below a folder; a file that isn't valid JSON fails the read, as does a wrong version when checked."""
    from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

    schema = StructType().add("schema_version", StringType()).add("canonical_id", StringType()).add("generated_at", StringType()).add("unit_count", IntegerType()).add("units", ArrayType(unit_schema()))
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(f"{root}/*/knowledge/knowledge_units.json").withColumn("file", F.col("_metadata.file_path"))


def document_faults(documents: DataFrame) -> DataFrame:
    """Files that break an invariant, with the first that they break."""
    ids = F.forall("units", lambda u: u.knowledge_unit_id.rlike("^ku_[a-f0-9]{16}$"))
    fault = (
        F.when(~F.col("schema_version").eqNullSafe(VERSION), "schema_version")
        .when(~F.col("unit_count").eqNullSafe(F.size("units")), "unit_count")
        .when(~F.forall("units", lambda u: u.canonical_id.eqNullSafe(F.col("canonical_id"))), "canonical_id")
        .when(~ids, "knowledge_unit_id")
        .when(F.exists("units", lambda u: F.trim(F.coalesce(u.statement, F.lit(""))) == ""), "statement")
        .when(F.exists("units", lambda u: F.coalesce(F.size(u.evidence_refs), F.lit(0)) < 1), "evidence_refs")
        .when(~F.forall("units", lambda u: u.extraction_confidence.between(0, 1)), "extraction_confidence")
    )
    return documents.select("file", fault.alias("fault")).where(F.col("fault").isNotNull())


def sound_documents(documents: DataFrame) -> DataFrame:
    """The documents, all of them sound: one that breaks an invariant fails the read with its file's name and what it breaks."""
    faults = document_faults(documents)
    told = documents.join(faults, "file", "left")
    message = F.concat(F.col("file"), F.lit(" breaks "), F.col("fault"))
    checked = F.when(F.col("fault").isNull(), F.col("file")).otherwise(F.raise_error(message).cast("string"))
    return told.withColumn("file", checked).select(*documents.columns)


def unit_rows(documents: DataFrame) -> DataFrame:
    """A row a unit, in document order, as the retrieval operators take them."""
    return documents.select(F.posexplode("units").alias("place", "u")).select(
        F.col("u.knowledge_unit_id").alias("knowledge_unit_id"), F.col("u.canonical_id").alias("canonical_id"), F.col("u.unit_type").alias("unit_type"), F.col("u.statement").alias("statement"),
        F.array_join(F.transform("u.evidence_refs", lambda r: r.source_excerpt), " ").alias("excerpt"), F.array_join(F.transform("u.entities", lambda e: e.entity_name), " ").alias("entity"),
        F.array_join("u.topics", " ").alias("topic"), F.col("u.verification_status").alias("verification_status"), F.col("u.extraction_confidence").alias("confidence"), "place",
    )


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Segments of transcript files: trimmed, not empty, end not before start, times to the millisecond, in order."""
    segment = "array<struct<id string, start double, end double, text string>>"
    files = spark.read.schema(f"video_id string, language string, segments {segment}").option("multiLine", True).option("mode", "FAILFAST").json(path)
    rows = files.select("video_id", F.posexplode("segments").alias("place", "s"))
    return rows.select("video_id", "place", F.round("s.start", 3).alias("start"), F.round("s.end", 3).alias("end"), F.trim("s.text").alias("text")).where("text <> '' and end >= start")


def raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """Files as they are, with size and digest."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"), F.decode("content", "UTF-8").alias("content"))


def page_conflicts(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Pages (run_id, page_number, sha256) that come again with another digest; the same digest is a replay."""
    return stored.alias("a").join(incoming.alias("b"), ["run_id", "page_number"]).where(F.col("a.sha256") != F.col("b.sha256")).select("run_id", "page_number")


def new_pages(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    return incoming.join(stored.select("run_id", "page_number"), ["run_id", "page_number"], "left_anti")


def markdown(units: DataFrame) -> DataFrame:
    """One Markdown text per asset: statements with their quoted excerpts, in order."""
    from sheafwork.functions.scalars import escaped_excerpt

    line = F.concat(F.lit("## "), "statement", F.lit("\n\n"), escaped_excerpt(F.col("excerpt")), F.lit("\n"))
    return units.select("canonical_id", F.struct("unit_rowid", line.alias("t")).alias("x")).groupBy("canonical_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x.t), "\n").alias("text"))


def transcript_lines(segments: DataFrame) -> DataFrame:
    """A line of text a segment: [00:00:01 - 00:00:03] seg_000001 text; a writer sorts them within an asset."""
    from sheafwork.functions.scalars import clock

    return segments.withColumn("line", F.concat(F.lit("["), clock(F.col("start")), F.lit(" - "), clock(F.col("end")), F.lit("] "), "segment_id", F.lit(" "), "text"))


def audit(documents: DataFrame) -> DataFrame:
    """The head of an asset's audit: identity, then counts of all types and states, zeros too. documents: canonical_id, schema_version, generated_at, unit_type, verification_status, a row a unit."""
    from sheafwork.plans.views import STATUSES, UNIT_TYPES

    counts = documents.groupBy("canonical_id").agg(F.any_value("schema_version").alias("v"), F.any_value("generated_at").alias("at"), F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("unit_type") == t).alias(t) for t in UNIT_TYPES], *[F.count_if(F.col("verification_status") == s).alias(s) for s in STATUSES])
    show = lambda label, c: F.concat(F.lit(f"- {label}: "), F.col(c).cast("string"))
    lines = [
        F.lit("# Knowledge Audit"), F.lit(""), F.lit("## Asset"), F.lit(""), show("canonical_id", "canonical_id"), show("schema version", "v"), show("generated_at", "at"), show("unit count", "n"), F.lit(""), F.lit("## Summary"), F.lit(""),
        *[show(f"{t} count", t) for t in UNIT_TYPES], F.lit(""), F.lit("Verification status:"), *[show(s, s) for s in STATUSES],
    ]
    return counts.select("canonical_id", F.concat_ws("\n", *lines).alias("text"))


def album_text(images: DataFrame) -> DataFrame:
    """An album's images as text: a heading an image by sequence, with what was recognised and described. images: canonical_id, sequence_index, file_name, ocr_text, description."""
    some = lambda label, c: F.when(F.trim(F.coalesce(c, F.lit(""))) != "", F.concat(F.lit(f"{label}: "), F.trim(c)))
    part = F.concat_ws("\n", F.concat(F.lit("## "), F.col("sequence_index").cast("string"), F.lit(" "), "file_name"), some("OCR", F.col("ocr_text")), some("VLM", F.col("description")))
    return images.select("canonical_id", F.struct("sequence_index", part.alias("t")).alias("x")).groupBy("canonical_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x.t), "\n\n").alias("text"))
