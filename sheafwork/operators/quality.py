"""Integrity checks as queries: projections, coverage of windows, chunk totals, payloads, golden expectations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What no outbox payload may hold.
FORBIDDEN = r"(?i)sessionid|sid_guard|cookie\s*[:=]|authorization\s*[:=]"


def projection_faults(units: DataFrame, projection: DataFrame, key: str) -> DataFrame:
    """Rows that a derived projection lacks, and rows it has beyond its source."""
    missing = units.select(key).join(projection.select(key), key, "left_anti").withColumn("fault", F.lit("missing"))
    return missing.unionByName(projection.select(key).join(units.select(key), key, "left_anti").withColumn("fault", F.lit("orphan")))


def uncovered(items: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """Items in no chunk, and ids in chunks that are no items. chunks: ids, an array."""
    return projection_faults(items, chunks.select(F.explode("ids").alias(key)).distinct(), key)


def chunk_summary(chunks: DataFrame, asset: str) -> DataFrame:
    """Per asset: chunks, references, different references. chunks: ids, an array."""
    totals = chunks.groupBy(asset).agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.size("ids")).alias("refs"))
    different = chunks.select(asset, F.explode("ids").alias("id")).groupBy(asset).agg(F.countDistinct("id").alias("unique_refs"))
    return totals.join(different, asset, "left").withColumn("unique_refs", F.coalesce("unique_refs", F.lit(0)))


def payload_faults(rows: DataFrame, identity: dict[str, str]) -> DataFrame:
    """First fault of each outbox payload: empty, a secret, no JSON object, or an identity other than the row's. identity: {row column: JSON path}."""
    payload = F.trim(F.coalesce("payload", F.lit("")))
    fault = F.when(payload == "", "empty").when(payload.rlike(FORBIDDEN), "secret").when(F.try_parse_json("payload").isNull() | ~payload.startswith("{"), "malformed")
    for column, path in identity.items():
        fault = fault.when(~F.get_json_object("payload", path).eqNullSafe(F.col(column).cast("string")), f"identity:{column}")
    return rows.withColumn("fault", fault).where(F.col("fault").isNotNull())


def expectations(golden: DataFrame, hits: DataFrame) -> DataFrame:
    """Whether each golden query's required, forbidden and zero-result expectations hold, and why not.

    golden: query_id, required, forbidden (arrays), zero_expected, path; hits: query_id, unit_rowid, path, term_coverage.
    """
    found = hits.groupBy("query_id").agg(F.collect_set("unit_rowid").alias("ids"), F.min("term_coverage").alias("least"), F.collect_set("path").alias("paths"))
    row = golden.join(found, "query_id", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<bigint>")))
    reasons = F.array(
        F.when(F.size(F.array_except("required", "ids")) > 0, "required_missing"),
        F.when(F.size(F.array_intersect("forbidden", "ids")) > 0, "forbidden_found"),
        F.when(F.col("zero_expected") & (F.size("ids") > 0), "hits_not_expected"),
        F.when(~F.col("zero_expected") & (F.size("ids") == 0), "no_hits"),
        F.when(F.col("least") < 1, "coverage"),
        F.when(F.exists(F.coalesce("paths", F.array().cast("array<string>")), lambda p: p != F.col("path")), "path"),
    )
    return row.select("query_id", F.filter(reasons, lambda r: r.isNotNull()).alias("reasons")).withColumn("passed", F.size("reasons") == 0)
