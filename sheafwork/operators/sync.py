"""Collection sync: first sightings, current state, page facts, stop decisions, outbox."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.functions.scalars import backoff, watermark_reached


def first_sightings(observations: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return observations.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def current_items(observations: DataFrame, keys: list[str], position: str, lapse: int) -> DataFrame:
    """State of each item after all its sightings: first, last, how many, and whether it came back.

    A sighting more than ``lapse`` positions after the one before it is a reappearance. The positions of sightings
    are the only order that counts, so the state is a pair of aggregates around one lag.
    """
    w = Window.partitionBy(*keys).orderBy(position)
    seen = observations.withColumn("_before", F.lag(position).over(w))
    back = F.col("_before").isNotNull() & (F.col(position) - F.col("_before") > lapse)
    return seen.groupBy(*keys).agg(
        F.min(position).alias("first_seen"), F.max(position).alias("last_seen"), F.count(F.lit(1)).alias("observed_count"), F.count_if(back).alias("reappearances"), F.max(F.when(back, F.col(position))).alias("reappeared_at")
    )


def conflicts(observations: DataFrame, key: list[str], payload: str) -> DataFrame:
    """Keys that were seen with different payloads; a replay of the same payload is none."""
    return observations.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(payload).alias("payloads")).where("payloads > 1")


def page_facts(observations: DataFrame, scope: str, item: str, page: str, cursor: str) -> DataFrame:
    """Per page: items, new and known ones, cursors; the last page has no more."""
    first = observations.withColumn("_new", F.row_number().over(Window.partitionBy(scope, item).orderBy("rank")) == 1)
    facts = first.groupBy(scope, page).agg(F.count(F.lit(1)).alias("items"), F.count_if("_new").alias("new_items"), F.max(cursor).alias("response_cursor"))
    w = Window.partitionBy(scope).orderBy(page)
    return facts.withColumn("request_cursor", F.coalesce(F.lag("response_cursor").over(w), F.lit("0"))).withColumn("has_more", F.when(F.lead(page).over(w).isNull(), 0).otherwise(1))


def stop_decisions(pages: DataFrame, scope: str, page: str, mode: str = "incremental", history_complete: bool = True, committed: str | None = None, max_pages: int | None = None, backfill_limit: int | None = None) -> DataFrame:
    """What each page tells the sync to do; the first rule that applies decides. A limit never advances the watermark."""
    w = Window.partitionBy(scope).orderBy(page).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p, cursor = F.col(page), F.col("response_cursor")
    begun = F.when((p == 1) & (F.col("items") > 0) & (F.col("request_cursor") == "0") & ~F.coalesce(cursor, F.lit("")).isin("", "0"), cursor)
    rows = pages.withColumn("candidate", F.max(begun).over(w)).withColumn("accumulated", F.sum("items").over(w))
    never = F.lit(False)
    reached = watermark_reached(cursor, F.lit(committed)) if mode == "incremental" and history_complete and committed is not None else never
    reason = (
        F.when((p > 1) & (cursor == F.col("request_cursor")) & (cursor != "0") & (F.col("has_more") == 1), "loop_detected")
        .when((p == 1) & (F.col("items") == 0), "empty_collection")
        .when((F.col("has_more") == 0) | (cursor == "0") | (F.col("items") == 0), "end_of_collection")
        .when(F.coalesce(reached, never), "watermark_reached")
        .when(p >= max_pages if max_pages is not None else never, "max_pages_reached")
        .when(F.col("accumulated") >= backfill_limit if mode == "backfill" and backfill_limit is not None else never, "backfill_limit_reached")
        .otherwise("has_more")
    )
    action = (
        F.when(F.col("reason") == "loop_detected", "stop_error")
        .when(F.col("reason").isin("empty_collection", "end_of_collection"), "stop_terminal")
        .when(F.col("reason") == "watermark_reached", "stop_safe_boundary")
        .when(F.col("reason").endswith("_reached"), "stop_limit")
        .otherwise("continue")
    )
    keep = F.col("reason").isin("end_of_collection", "watermark_reached", "has_more")
    return rows.withColumn("reason", reason).select(scope, page, "items", "accumulated", "reason", action.alias("action"), F.when(keep, F.col("candidate")).alias("watermark"))


def eligibility(items: DataFrame) -> DataFrame:
    """active, has_asset, reappeared, known -> eligible, reason, priority; the first rule that applies decides."""
    reason = F.when(~F.col("active") | F.col("has_asset"), None).when(F.col("reappeared"), "REAPPEARANCE_ASSET_MISSING").when(F.col("known"), "ASSET_MISSING_REPAIR").otherwise("NEW_COLLECTION_ITEM")
    return items.withColumn("reason", reason).withColumn("eligible", F.col("reason").isNotNull()).withColumn("priority", F.when(F.col("reason").isNull(), 0).when(F.col("reason") == "NEW_COLLECTION_ITEM", 10).otherwise(5))


def after_failure(outbox: DataFrame, most: int, base: float) -> DataFrame:
    """attempts + 1; FAILED at the limit, else PENDING again after a doubling delay."""
    tried = F.col("attempts") + 1
    return outbox.withColumn("attempts", tried).withColumn("status", F.when(F.col("attempts") >= most, "FAILED").otherwise("PENDING")).withColumn("delay", F.when(F.col("status") == "PENDING", backoff(F.col("attempts"), base, 2.0, 1e9)))
