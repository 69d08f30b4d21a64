"""The engine's entities, derived from the driver's tables, as DataFrames and as DuckDB common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The closed vocabularies of knowledge units.
UNIT_TYPES = ("claim", "opinion", "observation", "procedure_step", "verification_question")
STATUSES = ("not_checked", "verified", "contested", "unsupported")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Knowledge units: the first line of a document is its statement, the rest its evidence excerpt."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    kinds = F.array(*[F.lit(t) for t in UNIT_TYPES])
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("unit_rowid"),
        F.col("source").alias("canonical_id"),
        F.get(kinds, (F.col("doc_id") % 5).cast("int")).alias("unit_type"),
        first.alias("statement"),
        F.expr("substring(text, length(split_part(text, '\\n', 1)) + 2)").alias("excerpt"),
        F.col("source").alias("entity"),
        F.col("lang").alias("topic"),
        F.when(F.col("toxic") == 1, "contested").otherwise("not_checked").alias("verification_status"),
        ((F.col("n_chars") % 100).cast("double") / 100).alias("confidence"),
    )


UNITS = """units AS (
  SELECT d.doc_id AS unit_rowid, d.source AS canonical_id,
    ['claim', 'opinion', 'observation', 'procedure_step', 'verification_question'][CAST(d.doc_id % 5 AS INTEGER) + 1] AS unit_type,
    split_part(d.text, chr(10), 1) AS statement, substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS excerpt,
    d.source AS entity, d.lang AS topic, CASE WHEN l.toxic = 1 THEN 'contested' ELSE 'not_checked' END AS verification_status,
    CAST(d.n_chars % 100 AS DOUBLE) / 100 AS confidence
  FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)
)"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript segments: the turns of a conversation, at 15 characters a second."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    talk = table(spark, sf_dir, "conversations").withColumn("chars", F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return talk.select(
        "conv_id", "turn", "role", "text",
        F.format_string("seg_%06d", F.row_number().over(order)).alias("segment_id"),
        ((F.col("chars") - F.length("text")).cast("double") / 15).alias("start"),
        (F.col("chars").cast("double") / 15).alias("end"),
        F.expr("case role when 'user' then 'speech' when 'assistant' then 'visual_text' else 'visual_description' end").alias("modality"),
    )


SEGMENTS = """segments AS (
  SELECT conv_id, turn, role, text, 'seg_' || lpad(CAST(row_number() OVER w AS VARCHAR), 6, '0') AS segment_id,
    CAST(sum(length(text)) OVER w - length(text) AS DOUBLE) / 15 AS start, CAST(sum(length(text)) OVER w AS DOUBLE) / 15 AS "end",
    CASE role WHEN 'user' THEN 'speech' WHEN 'assistant' THEN 'visual_text' ELSE 'visual_description' END AS modality
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings: an event is the sighting of one of 97 items in its user's scope; ten make a page."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rank = F.row_number().over(order)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("scope_id"), (F.col("event_id") % 97).alias("content_id"), "event_id", F.col("ts").alias("observed_at"), rank.cast("bigint").alias("rank"),
        (F.floor((rank - 1) / 10) + 1).cast("bigint").alias("page_number"), F.date_format("ts", "yyyyMMddHHmmssSSSSSS").alias("cursor"),
    )


OBSERVATIONS = """observations AS (
  SELECT user_id AS scope_id, event_id % 97 AS content_id, event_id, ts AS observed_at, row_number() OVER w AS rank,
    (row_number() OVER w - 1) // 10 + 1 AS page_number, strftime(ts, '%Y%m%d%H%M%S%f') AS cursor
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
)"""


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue jobs from orders: state by status, priority by the urgency's number, due at the order date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("task_id"), F.col("o_custkey").alias("scope_id"),
        F.expr("case o_orderstatus when 'O' then 'READY' when 'P' then 'RETRY_WAIT' else 'COMPLETED' end").alias("state"),
        (F.lit(10) - F.try_to_number(F.substring("o_orderpriority", 1, 1), F.lit("9")).cast("int")).alias("priority"),
        F.col("o_orderdate").alias("next_attempt_at"),
    )


JOBS = """jobs AS (
  SELECT o_orderkey AS task_id, o_custkey AS scope_id, CASE o_orderstatus WHEN 'O' THEN 'READY' WHEN 'P' THEN 'RETRY_WAIT' ELSE 'COMPLETED' END AS state,
    10 - CAST(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS INTEGER) AS priority, o_orderdate AS next_attempt_at FROM orders
)"""


_INDEXES: dict[tuple[str, str], object] = {}


def unit_index(spark: SparkSession, sf_dir: str):
    """The index over all units of these tables, built once a session, as a store keeps it from one ingestion to the next."""
    from sheafwork.operators.retrieval import build_index
    from sheafwork.sources.folders import shared_folder

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INDEXES:
        _INDEXES[key] = build_index(units(spark, sf_dir), shared_folder(spark, "index"), buckets=8, parts=8)
    return _INDEXES[key]


def rich_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with several entities, topics and pieces of evidence each: every line of the excerpt is one.

    Every 13th unit's evidence has no place, every fourth has no entity, and every 29th no evidence.
    """
    n = F.col("unit_rowid")
    base = units(spark, sf_dir).drop("entity", "topic")
    lines = F.filter(F.split("excerpt", "\n"), lambda t: t != "")
    entities = F.when(n % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("canonical_id", F.concat(F.lit("e"), (n % 7).cast("string"))))
    topics = F.array(F.col("lang"), F.concat(F.lit("t"), (n % 5).cast("string")), F.concat(F.lit("t"), (n % 3).cast("string")))
    temporal = F.when(n % 13 != 0, F.struct(F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), F.lit(1.0).alias("duration")))
    refs = F.transform(
        F.when(n % 29 == 0, F.array().cast("array<string>")).otherwise(lines),
        lambda t, i: F.struct(F.concat(F.lit("ev_"), n.cast("string"), F.lit("_"), i.cast("string")).alias("evidence_id"), t.alias("source_excerpt"), temporal.alias("temporal_range"), F.lit(None).cast("struct<sequence_index: int>").alias("sequence_range")),
    )
    langs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit_rowid"), "lang")
    own = base.join(langs, "unit_rowid").withColumns({"entities": entities, "topics": topics}).withColumn("evidence_refs", refs).drop("lang", "excerpt")
    joined = lambda c: F.array_join(c, " ")
    unit_id = F.concat(F.lit("ku_"), F.substring(F.sha2(F.concat_ws("|", "canonical_id", "unit_type", "statement"), 256), 1, 16))
    return own.withColumns({"entity": joined("entities"), "topic": joined("topics"), "excerpt": joined(F.transform("evidence_refs", lambda r: r.source_excerpt)), "knowledge_unit_id": unit_id})


RICH = f"""{UNITS}, lined AS (
  SELECT units.* EXCLUDE (entity, topic, excerpt), d.lang, CASE WHEN unit_rowid % 29 = 0 THEN CAST([] AS VARCHAR[]) ELSE list_filter(string_split(units.excerpt, chr(10)), lambda t: t <> '') END AS lines,
    CASE WHEN unit_rowid % 4 = 0 THEN CAST([] AS VARCHAR[]) ELSE [canonical_id, 'e' || unit_rowid % 7] END AS entities, [d.lang, 't' || unit_rowid % 5, 't' || unit_rowid % 3] AS topics
  FROM units JOIN documents d ON d.doc_id = unit_rowid),
rich AS (SELECT lined.* EXCLUDE (lang), array_to_string(entities, ' ') AS entity, array_to_string(topics, ' ') AS topic, array_to_string(lines, ' ') AS excerpt,
  'ku_' || substr(sha256(canonical_id || '|' || unit_type || '|' || statement), 1, 16) AS knowledge_unit_id FROM lined)"""
