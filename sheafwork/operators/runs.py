"""The life of sync runs as set operations: begin, stage, finish, fail, recover; many runs of different scopes at once.

Tables: runs (run_id, scope_id, platform, status, previous_watermark, candidate_watermark, stop_reason, error_code,
error_message), states (scope_id, platform, watermark, history_complete, backfill_cursor, last_run_id), staging (run_id,
content_id, content_type, payload, reappeared, staged_at), items (scope_id, platform, content_id, content_type, active,
first_seen, last_seen, observed_count, payload). A call gets at most one request for a run, and at most one finishing
run of a scope. Every function returns new tables; a caller writes them together, as a version, and then flips its
pointer (``streaming.observations``), so that no reader sees half a step.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUNNING, COMPLETED, FAILED, ABORTED = "running", "completed", "failed", "aborted"
# What in a message tells a credential, what then stands for the message, and the mark of aborted runs.
CREDENTIALS = ("sessionid=", "cookie=", "authorization=", "token=")
SANITISED = "Sanitized error message (contained potential credential pattern)"
CRASH_CODE, CRASH_MESSAGE, CRASH_STOP = "PROCESS_TERMINATED_ABNORMALLY", "Run aborted during crash recovery.", "manual_abort"
SCOPE = ("scope_id", "platform")
RUN = ("run_id", "scope_id", "platform", "status", "previous_watermark", "candidate_watermark", "stop_reason", "error_code", "error_message")
STATE = ("scope_id", "platform", "watermark", "history_complete", "backfill_cursor", "last_run_id")


def sanitised(message: Column) -> Column:
    """The message, or a fixed text in its place if it holds what looks like a credential; empty for null."""
    text = F.coalesce(message, F.lit(""))
    found = F.lit(False)
    for word in CREDENTIALS:
        found = found | F.lower(text).contains(word)
    return F.when(found, SANITISED).otherwise(text)


def _known(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """Requests with what is known of their run in columns that begin with r_."""
    own = runs.select(*[F.col(c).alias(f"r_{c}") for c in RUN])
    return requests.join(own, F.col("run_id") == F.col("r_run_id"), "left")


class Begun(NamedTuple):
    verdicts: DataFrame
    runs: DataFrame
    states: DataFrame


def begin(runs: DataFrame, states: DataFrame, requests: DataFrame) -> Begun:
    """requests: run_id, scope_id, platform. Verdicts: begun, running (the same run again), other_scope, concluded.

    A run that begins keeps its scope's watermark; a scope without a state gets an empty one.
    """
    asked = _known(requests, runs)
    same = (F.col("r_scope_id") == F.col("scope_id")) & (F.col("r_platform") == F.col("platform"))
    verdict = F.when(F.col("r_run_id").isNull(), "begun").when(F.col("r_status") != RUNNING, "concluded").when(same, "running").otherwise("other_scope")
    marks = states.select(*SCOPE, F.col("watermark").alias("previous_watermark"))
    told = asked.withColumn("verdict", verdict).select("run_id", *SCOPE, "verdict").join(marks, list(SCOPE), "left")
    fresh = told.where("verdict = 'begun'")
    none = F.lit(None).cast("string")
    new_runs = fresh.select("run_id", *SCOPE, F.lit(RUNNING).alias("status"), "previous_watermark", *[none.alias(c) for c in RUN[5:]])
    new_states = fresh.select(*SCOPE).distinct().join(states, list(SCOPE), "left_anti").select(*SCOPE, none.alias("watermark"), F.lit(False).alias("history_complete"), none.alias("backfill_cursor"), none.alias("last_run_id"))
    return Begun(told.select("run_id", "verdict", "previous_watermark"), runs.select(*RUN).unionByName(new_runs), states.select(*STATE).unionByName(new_states))


class Staged(NamedTuple):
    faults: DataFrame
    staging: DataFrame


def stage(staging: DataFrame, runs: DataFrame, rows: DataFrame) -> Staged:
    """Items into a running run's staging. Faults (run_id, content_id, fault): unknown_run, not_running, no_content_id.

    Of several rows of an item the last one staged counts, the content type stays that of the first.
    """
    asked = rows.join(runs.select(F.col("run_id").alias("r_id"), F.col("status").alias("r_status")), F.col("run_id") == F.col("r_id"), "left")
    fault = F.when(F.col("r_id").isNull(), "unknown_run").when(F.col("r_status") != RUNNING, "not_running").when(F.coalesce("content_id", F.lit("")) == "", "no_content_id")
    asked = asked.withColumn("fault", fault)
    good = asked.where("fault is null").select(*staging.columns)
    last = lambda c: F.max_by(c, "staged_at").alias(c)
    merged = staging.unionByName(good).groupBy("run_id", "content_id").agg(F.min_by("content_type", "staged_at").alias("content_type"), last("payload"), last("reappeared"), F.max("staged_at").alias("staged_at"))
    return Staged(asked.where("fault is not null").select("run_id", "content_id", "fault"), merged.select(*staging.columns))


class Finished(NamedTuple):
    verdicts: DataFrame
    runs: DataFrame
    states: DataFrame
    items: DataFrame
    staging: DataFrame


def finish(runs: DataFrame, states: DataFrame, staging: DataFrame, items: DataFrame, requests: DataFrame, inactive: DataFrame, now: Column) -> Finished:
    """Successful ends. requests: run_id, candidate_watermark, expected_watermark, expected_last_run, history_complete,
    backfill_cursor, stop_reason (all but the first may be null); inactive: run_id, content_id of items to switch off.

    Verdicts: completed, already_completed (the same end again), other_watermark, not_running, unknown_run, and
    watermark_moved or last_run_moved where the scope's state isn't the expected one. Only completed ones have effects:
    staged items are upserted (their first sighting stays), items are switched off, a given watermark is committed,
    history counts as complete if told so or else once a watermark is, and staging is cleared.
    """
    asked = _known(requests, runs)
    now_state = states.select(F.col("scope_id").alias("r_scope_id"), F.col("platform").alias("r_platform"), F.col("watermark").alias("s_watermark"), F.col("last_run_id").alias("s_last"), F.col("history_complete").alias("s_complete"), F.col("backfill_cursor").alias("s_cursor"), F.lit(True).alias("s_known"))
    asked = asked.join(now_state, ["r_scope_id", "r_platform"], "left")
    moved = lambda want, have: F.col("s_known") & F.col(want).isNotNull() & ~F.col(want).eqNullSafe(F.col(have))
    verdict = (
        F.when(F.col("r_run_id").isNull(), "unknown_run")
        .when((F.col("r_status") == COMPLETED) & F.col("r_candidate_watermark").eqNullSafe(F.col("candidate_watermark")), "already_completed")
        .when(F.col("r_status") == COMPLETED, "other_watermark")
        .when(F.col("r_status") != RUNNING, "not_running")
        .when(F.coalesce(moved("expected_watermark", "s_watermark"), F.lit(False)), "watermark_moved")
        .when(F.coalesce(moved("expected_last_run", "s_last"), F.lit(False)), "last_run_moved")
        .otherwise("completed")
    )
    asked = asked.withColumn("verdict", verdict)
    done = asked.where("verdict = 'completed'")
    ends = done.select(F.col("run_id").alias("d_run"), F.col("candidate_watermark").alias("d_watermark"), F.col("stop_reason").alias("d_stop"))
    over = F.col("d_run").isNotNull()
    new_runs = runs.join(ends, F.col("run_id") == F.col("d_run"), "left").select(
        "run_id", *SCOPE, F.when(over, COMPLETED).otherwise(F.col("status")).alias("status"), "previous_watermark", F.when(over, F.col("d_watermark")).otherwise(F.col("candidate_watermark")).alias("candidate_watermark"),
        F.when(over, F.col("d_stop")).otherwise(F.col("stop_reason")).alias("stop_reason"), "error_code", "error_message",
    )
    complete = F.coalesce("history_complete", F.when(F.col("candidate_watermark").isNotNull(), True), "s_complete", F.lit(False))
    changed = done.select(
        F.col("r_scope_id").alias("scope_id"), F.col("r_platform").alias("platform"), F.coalesce("candidate_watermark", "s_watermark").alias("n_watermark"), complete.alias("n_complete"),
        F.when(~complete, F.coalesce("backfill_cursor", "s_cursor")).alias("n_cursor"), F.col("run_id").alias("n_run"),
    )
    fresh = F.col("n_run").isNotNull()
    new_states = states.join(changed, list(SCOPE), "left").select(
        *SCOPE, *[F.when(fresh, F.col(n)).otherwise(F.col(c)).alias(c) for c, n in (("watermark", "n_watermark"), ("history_complete", "n_complete"), ("backfill_cursor", "n_cursor"), ("last_run_id", "n_run"))]
    )
    scopes = done.select("run_id", F.col("r_scope_id").alias("scope_id"), F.col("r_platform").alias("platform"))
    key = [*SCOPE, "content_id"]
    put = staging.join(scopes, "run_id").select(*key, F.col("content_type").alias("p_type"), F.col("payload").alias("p_payload"), F.col("staged_at").alias("p_at"))
    off = inactive.join(scopes, "run_id").select(*key).distinct().withColumn("off", F.lit(True))
    both = items.join(put, key, "full_outer").join(off, key, "left")
    staged = F.col("p_at").isNotNull()
    new_items = both.select(
        *key, F.when(staged, F.col("p_type")).otherwise(F.col("content_type")).alias("content_type"), (F.coalesce(F.col("active"), F.lit(True)) | staged).alias("was"), "off",
        F.coalesce("first_seen", "p_at").alias("first_seen"), F.when(staged, F.col("p_at")).otherwise(F.col("last_seen")).alias("last_seen"),
        (F.coalesce("observed_count", F.lit(0)) + staged.cast("int")).cast("bigint").alias("observed_count"), F.when(staged, F.col("p_payload")).otherwise(F.col("payload")).alias("payload"),
        F.when(staged | F.col("off"), now).alias("updated_at"),
    )
    new_items = new_items.withColumn("active", F.col("was") & F.col("off").isNull()).select(*key, "content_type", "active", "first_seen", "last_seen", "observed_count", "payload", "updated_at")
    return Finished(asked.select("run_id", "verdict"), new_runs, new_states, new_items, staging.join(scopes.select("run_id"), "run_id", "left_anti").select(*staging.columns))


class Failed(NamedTuple):
    verdicts: DataFrame
    runs: DataFrame
    staging: DataFrame


def fail(runs: DataFrame, staging: DataFrame, requests: DataFrame) -> Failed:
    """Failed ends. requests: run_id, error_code, error_message, stop_reason. Verdicts: failed, already_failed, completed_before,
    unknown_run. Neither items nor watermarks change; the message is sanitised, staging is cleared."""
    asked = _known(requests.select("run_id", "error_code", "error_message", "stop_reason"), runs)
    verdict = F.when(F.col("r_run_id").isNull(), "unknown_run").when(F.col("r_status") == FAILED, "already_failed").when(F.col("r_status") == COMPLETED, "completed_before").otherwise("failed")
    asked = asked.withColumn("verdict", verdict)
    ends = asked.where("verdict = 'failed'").select(F.col("run_id").alias("d_run"), F.col("error_code").alias("d_code"), sanitised(F.col("error_message")).alias("d_message"), F.col("stop_reason").alias("d_stop"))
    return Failed(asked.select("run_id", "verdict"), _ended(runs, ends, FAILED), staging.join(ends, F.col("run_id") == F.col("d_run"), "left_anti"))


def _ended(runs: DataFrame, ends: DataFrame, status: str) -> DataFrame:
    over = F.col("d_run").isNotNull()
    return runs.join(ends, F.col("run_id") == F.col("d_run"), "left").select(
        "run_id", *SCOPE, F.when(over, status).otherwise(F.col("status")).alias("status"), "previous_watermark", "candidate_watermark",
        *[F.when(over, F.col(n)).otherwise(F.col(c)).alias(c) for c, n in (("stop_reason", "d_stop"), ("error_code", "d_code"), ("error_message", "d_message"))],
    )


def recover(runs: DataFrame, staging: DataFrame, scopes: list | None = None) -> Failed:
    """Running runs (of some scopes) that a crash left behind are aborted and their staging cleared. The caller holds the only lock."""
    stale = runs.where(F.col("status") == RUNNING)
    if scopes is not None:
        stale = stale.where(F.col("scope_id").isin(scopes))
    ends = stale.select(F.col("run_id").alias("d_run"), F.lit(CRASH_CODE).alias("d_code"), F.lit(CRASH_MESSAGE).alias("d_message"), F.lit(CRASH_STOP).alias("d_stop"))
    return Failed(ends.select(F.col("d_run").alias("run_id"), F.lit("aborted").alias("verdict")), _ended(runs, ends, ABORTED), staging.join(ends, F.col("run_id") == F.col("d_run"), "left_anti"))


def committed_progress(stops: DataFrame) -> DataFrame:
    """What a stop means for a scope's state. stops: action, candidate, history_complete, mode, request_cursor, response_cursor,
    backfill_cursor -> candidate (null if it must not advance), history_complete, backfill_cursor.

    An end or a known boundary completes history; a limit never advances the watermark and, while history is incomplete,
    leaves its cursor to go on from; a backfill from the middle never advances it either.
    """
    ended = F.col("action").isin("stop_terminal", "stop_safe_boundary")
    limit = F.col("action") == "stop_limit"
    from_middle = (F.col("mode") == "backfill") & (F.col("request_cursor") != "0")
    cursor = F.when(limit & ~F.col("history_complete"), F.col("response_cursor")).when(~ended, F.col("backfill_cursor"))
    return stops.withColumns({"candidate": F.when(~(limit | from_middle), F.col("candidate")), "backfill_cursor": cursor, "history_complete": F.col("history_complete") | ended})


def staged_of(staging: DataFrame, run_id: str) -> DataFrame:
    """A run's staged items in the order of their staging."""
    return staging.where(F.col("run_id") == run_id).orderBy("staged_at", "content_id")


def committed_of(items: DataFrame, observations: DataFrame, run_id: str) -> DataFrame:
    """Items that a run saw, the last seen first. observations: run_id, content_id."""
    seen = observations.where(F.col("run_id") == run_id).select("content_id").distinct()
    return items.join(seen, "content_id", "left_semi").orderBy(F.desc("last_seen"), "content_id")
