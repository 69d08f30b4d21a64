"""Retrieval quality: hit, reciprocal rank, precision, recall and F1 at k for each golden query, verdicts, and their means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEANS = ("hit_at_k", "mrr", "precision_at_k", "recall_at_k", "f1_at_k")


def evaluate(golden: DataFrame, relevant: DataFrame, hits: DataFrame) -> DataFrame:
    """golden: query_id, top_k, judgment ('exhaustive' or 'partial'); relevant: query_id, unit_rowid; hits: query_id, rank, unit_rowid.

    Relevance is a table joined with the hits, never gathered. Precision divides by top_k even if fewer were returned.
    Partial judgements have no precision, recall and F1.
    """
    told = relevant.select("query_id", "unit_rowid").distinct()
    sizes = told.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    marked = hits.select("query_id", "rank", "unit_rowid").join(told.withColumn("good", F.lit(True)), ["query_id", "unit_rowid"], "left")
    found = marked.groupBy("query_id").agg(F.count("unit_rowid").alias("returned"), F.count_if("good").alias("good"), F.min(F.when(F.col("good"), F.col("rank"))).alias("first_relevant_rank"))
    row = golden.select("query_id", "top_k", "judgment").join(sizes, "query_id", "left").join(found, "query_id", "left").na.fill(0, ["n_relevant", "returned", "good"])
    full = (F.col("judgment") == "exhaustive") & (F.col("n_relevant") > 0)
    row = row.withColumn("hit_at_k", F.when(F.col("good") > 0, 1.0).otherwise(0.0)).withColumn("mrr", F.coalesce(F.lit(1.0) / F.col("first_relevant_rank"), F.lit(0.0)))
    row = row.withColumn("precision_at_k", F.when(full, F.col("good") / F.col("top_k"))).withColumn("recall_at_k", F.when(full, F.col("good") / F.col("n_relevant")))
    p, r = F.col("precision_at_k"), F.col("recall_at_k")
    return row.withColumn("f1_at_k", F.when(full, F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))).select(
        "query_id", "returned", "good", "first_relevant_rank", "hit_at_k", *[F.round(c, 9).alias(c) for c in MEANS[1:]]
    )


def summarise(evaluated: DataFrame) -> DataFrame:
    """Means over the suite; measures that a query doesn't have are left out of their mean."""
    return evaluated.agg(F.count(F.lit(1)).alias("queries"), *[F.round(F.avg(c), 9).alias(f"mean_{c}") for c in MEANS])


def evidence_complete(refs: Column) -> Column:
    """Some evidence, each with an id, an excerpt, and a place in time or in a sequence."""
    whole = lambda r: (F.coalesce(r.evidence_id, F.lit("")) != "") & (F.coalesce(r.source_excerpt, F.lit("")) != "") & (r.temporal_range.isNotNull() | r.sequence_range.isNotNull())
    return F.coalesce((F.size(refs) > 0) & F.forall(refs, whole), F.lit(False))


def provenance_complete(unit_id: Column, canonical_id: Column, path: Column, fingerprint: Column) -> Column:
    some = lambda c: F.coalesce(c, F.lit("")) != ""
    return some(path) & some(fingerprint) & some(canonical_id) & F.coalesce(unit_id.rlike("^ku_[a-f0-9]{16}$"), F.lit(False))


def filters_hold(hit: str = "") -> Column:
    """Whether a hit joined with its golden query's filters (arrays ``f_...``, null or empty if unset) passes them all."""
    one = lambda c, f: F.coalesce(F.size(F.col(f)), F.lit(0)).isin(0, -1) | F.coalesce(F.array_contains(F.col(f), F.col(c)), F.lit(False))
    some = lambda c, f: F.coalesce(F.size(F.col(f)), F.lit(0)).isin(0, -1) | F.coalesce(F.arrays_overlap(F.col(f), F.col(c)), F.lit(False))
    return one("canonical_id", "f_assets") & one("unit_type", "f_types") & one("verification_status", "f_statuses") & some("topics", "f_topics") & some("entities", "f_entities")


def verdicts(golden: DataFrame, evaluated: DataFrame, hits: DataFrame, corpus_ok: bool = True) -> DataFrame:
    """Whether each golden query passes, and why not.

    golden: query_id, path, required, forbidden (unit numbers), expected_assets, forbidden_assets, f_assets, f_types,
    f_statuses, f_topics, f_entities (arrays, few values each), zero_expected, max_first_rank. evaluated: from ``evaluate``.
    hits: query_id, unit_rowid, canonical_id, unit_type, verification_status, topics, entities, path, term_coverage,
    evidence_complete, provenance_complete. A corpus other than the judged one fails every query.
    """
    columns = [c for c in golden.columns if c not in ("top_k", "judgment")]
    own = golden.select(*[F.col(c).alias("want_path" if c == "path" else c) for c in columns])
    all_true = lambda c: F.coalesce(F.bool_and(c), F.lit(True))
    facts = own.join(hits, "query_id", "left").groupBy("query_id").agg(
        F.collect_set("unit_rowid").alias("ids"), F.collect_set("canonical_id").alias("assets"), F.count("unit_rowid").alias("n"),
        all_true(F.when(F.col("unit_rowid").isNotNull(), filters_hold())).alias("filter_correct"),
        all_true(F.when(F.col("unit_rowid").isNotNull(), F.col("path").eqNullSafe(F.col("want_path")))).alias("path_correct"),
        all_true("evidence_complete").alias("evidence_complete"), all_true("provenance_complete").alias("provenance_complete"), all_true(F.col("term_coverage") == 1).alias("coverage_valid"),
    )
    row = own.join(facts, "query_id").join(evaluated.select("query_id", "first_relevant_rank", "hit_at_k"), "query_id")
    some = F.col("n") > 0
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    reasons = F.array(
        F.when(size(F.array_except("required", "ids")) > 0, "required_missing"),
        F.when(size(F.array_intersect("forbidden", "ids")) > 0, "forbidden_found"),
        F.when(size(F.array_intersect("forbidden_assets", "assets")) > 0, "forbidden_assets_found"),
        F.when((size("expected_assets") > 0) & (~some | (size(F.array_except("assets", "expected_assets")) > 0)), "expected_assets_violated"),
        F.when(F.col("zero_expected") & some, "hits_not_expected"),
        F.when(~F.col("zero_expected") & (F.col("hit_at_k") == 0), "no_relevant_hit"),
        F.when(~F.col("filter_correct"), "filter_violated"),
        F.when(~F.col("path_correct"), "path"),
        F.when(~F.col("evidence_complete"), "evidence"),
        F.when(~F.col("provenance_complete"), "provenance"),
        F.when(~F.col("coverage_valid"), "coverage"),
        F.when(F.col("max_first_rank").isNotNull() & ~F.coalesce(F.col("first_relevant_rank") <= F.col("max_first_rank"), F.lit(False)), "rank_bound"),
    )
    told = F.filter(reasons, lambda r: r.isNotNull()) if corpus_ok else F.array(F.lit("stale_corpus"))
    row = row.withColumn("reasons", told).withColumn("filtered", F.greatest(*[size(f"f_{k}") for k in ("assets", "types", "statuses", "topics", "entities")]) > 0)
    passed = (F.size("reasons") == 0) & (some | F.col("zero_expected"))
    return row.withColumn("passed", passed).select("query_id", "passed", "reasons", "filtered", "filter_correct", "path_correct", "evidence_complete", "provenance_complete", "coverage_valid")


def rates(judged: DataFrame) -> DataFrame:
    """Suite rates; filter accuracy counts filtered queries alone and is null without any."""
    part = lambda c: F.round(F.avg(c.cast("double")), 9)
    return judged.agg(
        F.count(F.lit(1)).alias("queries"), F.count_if("passed").alias("passed"), part(F.when(F.col("filtered"), F.col("filter_correct"))).alias("filter_accuracy"),
        *[part(F.col(c)).alias(f"{c}_rate") for c in ("path_correct", "evidence_complete", "provenance_complete", "coverage_valid")],
    )


def golden_faults(golden: DataFrame) -> DataFrame:
    """First fault of each golden query: query_id (blank or repeated), query_text, top_k, path, judgment, zero_result (it has what a
    query without results may not have), max_first_rank. golden: query_id, query_text, top_k, path, judgment, relevant, required
    (arrays), zero_expected, max_first_rank."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    repeated = golden.groupBy("query_id").agg((F.count(F.lit(1)) > 1).alias("repeated"))
    fault = (
        F.when(~text("query_id") | F.col("repeated"), "query_id")
        .when(~text("query_text"), "query_text")
        .when(~F.coalesce(F.col("top_k").between(1, 100), F.lit(False)), "top_k")
        .when(~F.coalesce(F.col("path").isin("fts_trigram", "substring_short", "fts_trigram_with_short_filter"), F.lit(False)), "path")
        .when(~F.coalesce(F.col("judgment").isin("exhaustive", "partial"), F.lit(False)), "judgment")
        .when(F.col("zero_expected") & (some("relevant") | some("required") | F.col("max_first_rank").isNotNull()), "zero_result")
        .when(F.coalesce(F.col("max_first_rank") < 1, F.lit(False)), "max_first_rank")
    )
    own = golden.join(repeated.withColumnRenamed("query_id", "r_id"), F.col("query_id").eqNullSafe(F.col("r_id")), "left")
    return own.withColumn("fault", fault).where("fault is not null").select("query_id", "fault")
