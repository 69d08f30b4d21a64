"""Knowledge units: validation of candidates, exact merging with conflict audit, enrichment, identity audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.functions.pytext import surface
from sheafwork.functions.scalars import normalised_statement
from sheafwork.plans.views import STATUSES, UNIT_TYPES

# Fields that a model may not fill in, and kinds of entities.
FORBIDDEN = (
    "knowledge_unit_id", "canonical_id", "source_excerpt", "temporal_range", "sequence_range", "source_actor_name", "source_actor_id", "speaker_name", "speaker_id", "attribution_status", "verification_status", "lineage",
    "extraction_lineage", "extraction_run_id", "input_chunk_ids", "candidate_id", "source_candidate_ids", "merge_strategy", "entities", "topics",
)
CATEGORIES = ("person", "organization", "product", "software", "hardware", "model", "platform", "technology", "standard", "location", "document", "inference_framework", "hardware_platform", "hardware_architecture", "model_family", "model_parameter", "brand_text", "text_mention", "other")
SEMANTIC = ("unit_type", "statement", "verification_status", "topic", "entity")
MOST_TOPICS, TOPIC_LENGTHS = 5, (2, 32)


def ordered_union(rows: DataFrame, key: str, position: str, value: str) -> DataFrame:
    """key, lineage: the different values of each key in the order of their first appearance.

    First positions of (key, value) are an aggregate with map-side minima, so a key that many rows share is spread over
    its values, and only one row a value is gathered into the list that the result holds anyway.
    """
    first = rows.groupBy(key, value).agg(F.min(position).alias("p"))
    ordered = F.array_sort(F.collect_list(F.struct("p", F.col(value).alias("v"))))
    return first.groupBy(key).agg(F.transform(ordered, lambda x: x.v).alias("lineage"))


def merge(units: DataFrame, key: str, position: str, lineage: str, compared: tuple[str, ...] = SEMANTIC) -> DataFrame:
    """One row a key: the first appearance's fields, the highest confidence, lineage in order of appearance.

    Groups whose fields differ from their first row are in conflict; ``conflicts`` lists them. Rows are first combined by
    key and lineage, with map-side partials, so that neither a hot key nor its list of origins grows with its rows.
    """
    # min and max of each field, coalesced with a mark for null, tell whether all rows agree.
    marked = {c: F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in compared}
    first = [F.min_by(F.struct(*compared), position).alias("fields")]
    ends = [x for c in compared for x in (F.min(marked[c]).alias(f"low_{c}"), F.max(marked[c]).alias(f"high_{c}"))]
    by_origin = units.groupBy(key, F.col(lineage).alias("origin")).agg(F.min(position).alias("p"), *first, F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("n"), *ends)
    differ = F.filter(F.array(*[F.when(F.min(f"low_{c}") != F.max(f"high_{c}"), F.lit(c)) for c in compared]), lambda c: c.isNotNull())
    ordered = F.array_sort(F.collect_list(F.struct("p", "origin")))
    merged_rows = by_origin.groupBy(key).agg(
        F.min("p").alias("first_position"), F.min_by("fields", "p").alias("fields"), F.max("confidence").alias("confidence"), F.sum("n").alias("merged"), F.transform(ordered, lambda x: x.origin).alias("lineage"), differ.alias("conflicts")
    )
    return merged_rows.select(key, "first_position", *[F.col(f"fields.{c}").alias(c) for c in compared], "confidence", "merged", "lineage", "conflicts")


def merged(units: DataFrame, key: str, position: str, lineage: str, compared: tuple[str, ...] = SEMANTIC) -> DataFrame:
    return merge(units, key, position, lineage, compared).where(F.size("conflicts") == 0)


def conflicts(units: DataFrame, key: str, position: str, lineage: str, compared: tuple[str, ...] = SEMANTIC) -> DataFrame:
    return merge(units, key, position, lineage, compared).where(F.size("conflicts") > 0)


def parsed_candidates(raw: DataFrame) -> DataFrame:
    """A model's proposals (candidate_id, chunk_id, text: one JSON value each) as candidates, with the faults that come before all others.

    fault: malformed_candidate for anything but an object, forbidden_canonical_fields_present where the model filled in what
    it may not. A missing confidence is 0.8; one that is no number becomes null, which ``validate_candidates`` rejects.
    """
    keys = F.json_object_keys("text")
    told = F.from_json("text", "unit_type string, statement string, evidence_ids array<string>")
    given = F.get_json_object("text", "$.extraction_confidence")
    confidence = F.when(F.array_contains(keys, "extraction_confidence"), given.try_cast("double")).otherwise(0.8)
    fault = F.when(keys.isNull(), "malformed_candidate").when(F.arrays_overlap(keys, F.array(*[F.lit(k) for k in FORBIDDEN])), "forbidden_canonical_fields_present")
    return raw.select("candidate_id", "chunk_id", told.unit_type.alias("unit_type"), told.statement.alias("statement"), confidence.alias("confidence"), told.evidence_ids.alias("evidence_ids"), fault.alias("fault"))


def hydrated_refs(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """candidate_id, refs: what each candidate cites, in its own order, with excerpt and times copied from the evidence.

    candidates: candidate_id, evidence_ids; evidence: evidence_id, excerpt, start, end, sequence_index. A candidate that cites
    what there is not, or what has no excerpt, gets no row.
    """
    cited = candidates.select("candidate_id", F.posexplode("evidence_ids").alias("at", "evidence_id"))
    met = cited.join(evidence, "evidence_id", "left").withColumn("sound", F.trim(F.coalesce("excerpt", F.lit(""))) != "")
    ref = F.struct("at", "evidence_id", "excerpt", "start", "end", "sequence_index")
    rows = met.groupBy("candidate_id").agg(F.min("sound").alias("sound"), F.array_sort(F.collect_list(ref)).alias("r"))
    return rows.where("sound").select("candidate_id", F.transform("r", lambda x: F.struct(x.evidence_id.alias("evidence_id"), x.excerpt.alias("source_excerpt"), x.start.alias("start"), x.end.alias("end"), x.sequence_index.alias("sequence_index"))).alias("refs"))


def validate_entities(units: DataFrame, proposals: DataFrame) -> DataFrame:
    """A row a proposed entity or topic: ref, kind, at, value, reason (null if accepted).

    units: ref, statement, excerpts (an array); proposals: input_ref, entities (array of struct(entity_name, category)), topics.
    Entities: malformed_proposal, invalid_entity_category, entity_not_grounded, duplicate_entity; names are compared by their
    folded surface. Topics: invalid_topic, duplicate_topic, and beyond five accepted ones nothing is looked at any more.
    """
    haystack = surface(F.concat_ws("\n", "statement", F.array_join("excerpts", "\n")))
    own = units.select("ref", F.col("statement"), "excerpts").withColumn("text", haystack)
    named = proposals.select(F.col("input_ref").alias("ref"), F.posexplode("entities").alias("at", "e")).select("ref", "at", F.col("e.entity_name").alias("value"), F.col("e.category").alias("category")).withColumn("key", surface(F.col("value")))
    met = named.join(own.select("ref", "text"), "ref")
    bad = F.when(F.coalesce("key", F.lit("")) == "", "malformed_proposal").when(~F.coalesce(F.col("category").isin(list(CATEGORIES)), F.lit(False)), "invalid_entity_category").when(~F.contains("text", "key"), "entity_not_grounded")
    met = met.withColumn("bad", bad)
    first = F.row_number().over(Window.partitionBy("ref", "key", F.col("bad").isNull()).orderBy("at"))
    entities = met.withColumn("n", first).select("ref", F.lit("entity").alias("kind"), "at", "value", F.coalesce("bad", F.when(F.col("n") > 1, "duplicate_entity")).alias("reason"))
    topics = proposals.select(F.col("input_ref").alias("ref"), F.posexplode("topics").alias("at", "raw")).join(own.select("ref"), "ref", "left_semi")
    clean = normalised_statement(F.col("raw"))
    wrong = F.col("raw").isNull() | F.coalesce(F.col("raw").rlike("[\\n\\r]"), F.lit(True)) | ~F.coalesce(F.length("value").between(*TOPIC_LENGTHS), F.lit(False))
    topics = topics.withColumn("value", clean).withColumn("bad", F.when(wrong, "invalid_topic"))
    topics = topics.withColumn("n", F.row_number().over(Window.partitionBy("ref", "value", F.col("bad").isNull()).orderBy("at"))).withColumn("reason", F.coalesce("bad", F.when(F.col("n") > 1, "duplicate_topic")))
    before = F.sum(F.when(F.col("reason").isNull(), 1).otherwise(0)).over(Window.partitionBy("ref").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    topics = topics.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < MOST_TOPICS)
    return entities.unionByName(topics.select("ref", F.lit("topic").alias("kind"), "at", "value", "reason"))


def enriched(units: DataFrame, results: DataFrame) -> DataFrame:
    """Units with the entities and topics of their results (knowledge_unit_id, status, entities, topics); only status ``enriched`` changes a unit."""
    own = results.where("status = 'enriched'").select(F.col("knowledge_unit_id").alias("r_id"), F.col("entities").alias("r_entities"), F.col("topics").alias("r_topics"))
    met = F.col("r_id").isNotNull()
    changed = {c: F.when(met, F.col(f"r_{c}")).otherwise(F.col(c)) for c in ("entities", "topics")}
    return units.join(own, F.col("knowledge_unit_id") == F.col("r_id"), "left").withColumns(changed).select(*units.columns)


def validate_candidates(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """candidate_id, chunk_id, unit_type, statement, confidence, evidence_ids; evidence: evidence_id, chunk_id, modality, excerpt, position.

    The first reason that applies rejects a candidate; evidence of accepted ones is put in the chunk's order.
    """
    cited = candidates.select("candidate_id", "chunk_id", F.posexplode("evidence_ids").alias("at", "evidence_id"))
    known = cited.join(evidence.withColumnRenamed("chunk_id", "home"), "evidence_id", "left")
    usable = F.trim(F.coalesce("excerpt", F.lit(""))) != ""
    facts = known.groupBy("candidate_id").agg(
        F.count_if(F.col("home").isNull()).alias("unknown"), F.count_if(F.col("home") != F.col("chunk_id")).alias("outside"), F.count_if(~usable).alias("unusable"), F.count_if(F.col("modality") == "speech").alias("spoken"),
        F.count_if(F.coalesce("evidence_id", F.lit("")) == "").alias("malformed"),
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("position", "evidence_id"))), lambda x: x.evidence_id)).alias("ordered_ids"),
    )
    row = candidates.join(facts, "candidate_id", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    reason = (
        F.when(F.trim(F.coalesce("statement", F.lit(""))) == "", "empty_statement")
        .when(~F.coalesce(F.col("unit_type").isin(list(UNIT_TYPES)), F.lit(False)), "invalid_unit_type")
        .when(~F.coalesce(F.col("confidence").between(0, 1), F.lit(False)), "invalid_confidence")
        .when(F.coalesce(F.size("evidence_ids"), F.lit(0)) < 1, "empty_evidence_ids")
        .when(n("malformed") > 0, "malformed_evidence_ids")
        .when(n("unknown") > 0, "unknown_evidence_id")
        .when(n("outside") > 0, "evidence_outside_chunk")
        .when(n("unusable") > 0, "evidence_has_no_usable_semantic_payload")
        .when((F.col("unit_type") == "observation") & (n("spoken") > 0), "observation_without_perceptual_evidence")
    )
    attribution = F.when(F.col("unit_type") == "verification_question", "system_derived").when(n("spoken") < F.size("evidence_ids"), "visual_media").otherwise("unverified_speaker")
    return row.withColumn("reason", reason).select("candidate_id", "reason", F.when(F.col("reason").isNull(), F.array_join("ordered_ids", ",")).alias("evidence"), F.when(F.col("reason").isNull(), attribution).alias("attribution"))


def accepted_topics(topics):
    """Topics of 2 to 32 characters on one line, white space collapsed, distinct, five at most."""
    clean = F.transform(F.filter(topics, lambda t: t.isNotNull() & ~t.rlike("[\\n\\r]")), lambda t: normalised_statement(t))
    return F.slice(F.array_distinct(F.filter(clean, lambda t: F.length(t).between(*TOPIC_LENGTHS))), 1, MOST_TOPICS)


def validate_enrichment(units: DataFrame, proposals: DataFrame) -> DataFrame:
    """Proposals (input_ref, entity_name, topics) against units (ref, statement, excerpt): status and what is accepted.

    A unit without a proposal is unchanged, one with several failed; an entity must occur in the unit's own text.
    """
    counted = proposals.groupBy("input_ref").agg(F.count(F.lit(1)).alias("n"), F.min("entity_name").alias("entity_name"), F.min("topics").alias("topics"))
    row = units.join(counted, F.col("ref") == F.col("input_ref"), "left")
    name = surface(F.coalesce("entity_name", F.lit("")))
    inside = F.contains(surface(F.col("statement")), name) | F.contains(surface(F.col("excerpt")), name)
    entity = F.when((name != "") & inside & (F.col("n") == 1), F.col("entity_name"))
    topics = F.when(F.col("n") == 1, F.array_join(accepted_topics(F.col("topics")), ","))
    status = F.when(F.col("n").isNull(), "unchanged").when(F.col("n") > 1, "failed").when(F.col("entity_ok").isNull() & (F.coalesce("topics_ok", F.lit("")) == ""), "unchanged").otherwise("enriched")
    return row.withColumn("entity_ok", entity).withColumn("topics_ok", topics).select("ref", status.alias("status"), "entity_ok", "topics_ok")


def identity_audit(before: DataFrame, after: DataFrame, key: str, compared: tuple[str, ...]) -> DataFrame:
    """What differs between two states of the same units: removed, added or the fields that changed."""
    a, b = before.alias("a"), after.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    changed = F.concat_ws(",", *[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), c) for c in compared])
    kind = F.when(F.col(f"b.{key}").isNull(), "removed").when(F.col(f"a.{key}").isNull(), "added").when(changed != "", "changed")
    return both.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), kind.alias("kind"), F.when(kind == "changed", changed).alias("fields")).where(F.col("kind").isNotNull())


def status_histogram(units: DataFrame) -> DataFrame:
    """Units by verification status and asset, with zeros for the states that an asset lacks."""
    return units.groupBy("canonical_id").pivot("verification_status", list(STATUSES)).agg(F.count(F.lit(1))).na.fill(0)


def histogram(units: DataFrame) -> DataFrame:
    """Units by type and asset, with zeros for types that an asset lacks."""
    counts = units.groupBy("canonical_id").pivot("unit_type", list(UNIT_TYPES)).agg(F.count(F.lit(1)))
    return counts.na.fill(0)


def batches(units: DataFrame, asset: str, order: str, size: int) -> DataFrame:
    """Numbers u001, u002, ... within an asset, and batches of ``size``."""
    n = F.row_number().over(Window.partitionBy(asset).orderBy(order))
    return units.withColumn("input_ref", F.format_string("u%03d", n)).withColumn("batch", (F.floor((n - 1) / size)).cast("int"))
