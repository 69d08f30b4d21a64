"""Job queue: intake from the outbox, claims, pauses, attempts, retry decisions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.functions.scalars import backoff, retry_after, without_secrets

# Attempts that an error is given, what follows while they last, and what it means for the worker.
RETRIES = {
    "INVALID_INPUT": (1, "TERMINAL", "HEALTHY"), "UNSUPPORTED_CONTENT": (1, "TERMINAL", "HEALTHY"), "NOT_FOUND": (1, "TERMINAL", "HEALTHY"), "UNAVAILABLE_DELETED": (1, "TERMINAL", "HEALTHY"),
    "NETWORK": (3, "RETRY", "HEALTHY"), "TIMEOUT": (3, "RETRY", "HEALTHY"), "SERVER_ERROR": (3, "RETRY", "HEALTHY"), "MEDIA_INCOMPLETE": (2, "RETRY_AFTER_RERESOLVE", "HEALTHY"),
    "VALIDATION_FAILED": (2, "RETRY_AFTER_RERESOLVE", "HEALTHY"), "TOOL_ERROR": (1, "TERMINAL", "WORKER_UNHEALTHY"), "PERMISSION_DENIED": (1, "TERMINAL", "HEALTHY"), "UNKNOWN": (2, "RETRY", "HEALTHY"),
    "SANDBOX_CREATE_FAILED": (1, "TERMINAL", "WORKER_UNHEALTHY"), "SANDBOX_PATH_ESCAPE": (1, "TERMINAL", "WORKER_UNHEALTHY"), "SANDBOX_METADATA_CORRUPT": (1, "TERMINAL", "WORKER_UNHEALTHY"),
}
# What in a subreason tells a link that expired, and a credential of the wrong account.
EXPIRED, STRUCTURAL = ("CDN", "STALE", "EXPIRED"), ("MISMATCH", "NOT_FOUND", "UNAUTHORIZED_SCOPE")
#: Attempts that a credential's refresh is given, and its delays.
REFRESHES, REFRESH_BASE, REFRESH_MOST = 2, 1.0, 10.0


def claimable(jobs: DataFrame, pauses: DataFrame, now) -> DataFrame:
    """READY jobs and due retries of scopes that aren't paused. pauses: scope_id, pause_until; one row a paused scope."""
    due = (F.col("state") == "READY") | ((F.col("state") == "RETRY_WAIT") & (F.col("next_attempt_at") <= now))
    return jobs.where(due).join(pauses, "scope_id", "left").where(F.col("pause_until").isNull() | (F.col("pause_until") <= now)).drop("pause_until")


def claim_order(jobs: DataFrame, n: int) -> DataFrame:
    """The next n jobs: priority, then due time, then number; a TakeOrderedAndProject."""
    return jobs.orderBy(F.desc("priority"), "next_attempt_at", "task_id").limit(n)


def _any(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | text.contains(w)
    return found


def retry_decisions(attempts: DataFrame, now: Column | None = None) -> DataFrame:
    """error_code, subreason, attempt, retry_after (and message, if there is one) -> action, budget, delay, worker.

    Rules in order, the first one decides: expired links, authentication, credentials, rate limits, the codes of networks
    and servers, incomplete media, conflicts told by subreason or message, then the other codes. now: for dates in
    retry_after.
    """
    code, sub, n = F.col("error_code"), F.upper(F.coalesce("subreason", F.lit(""))), F.col("attempt")
    message = F.lower(F.coalesce("message", F.lit(""))) if "message" in attempts.columns else F.lit("")
    volatile = code.isin("NOT_FOUND", "UNAVAILABLE_DELETED") & _any(sub, EXPIRED)
    auth, limited, bridge = code.isin("AUTH_REQUIRED", "AUTH_CHALLENGE"), code == "RATE_LIMITED", code == "CREDENTIAL_BRIDGE_FAILED"
    structural = bridge & _any(sub, STRUCTURAL)
    before = ("INVALID_INPUT", "UNSUPPORTED_CONTENT", "NOT_FOUND", "UNAVAILABLE_DELETED", "NETWORK", "TIMEOUT", "SERVER_ERROR", "MEDIA_INCOMPLETE")
    conflict = ~code.isin(*before) & (sub.contains("CONFLICT") | message.contains("conflict"))
    table, follow, worker = (F.create_map(*[F.lit(x) for k, row in RETRIES.items() for x in (k, row[at])]) for at in range(3))
    known = F.when(F.map_contains_key(table, code), code).otherwise("UNKNOWN")
    budget = F.when(volatile, 2).when(auth | limited, None).when(bridge, F.when(structural, 1).otherwise(REFRESHES)).when(conflict, 1).otherwise(table[known])
    action = (
        F.when(volatile, F.when(n < 2, "RETRY_AFTER_RERESOLVE").otherwise("TERMINAL"))
        .when(auth, "BLOCKED_AUTH")
        .when(bridge, F.when(structural | (n >= REFRESHES), "TERMINAL").otherwise("RETRY_AFTER_CREDENTIAL_REFRESH"))
        .when(limited, "WAIT_AND_RETRY")
        .when(conflict, "TERMINAL")
        .otherwise(F.when(n < table[known], follow[known]).otherwise("TERMINAL"))
    )
    rows = attempts.withColumn("action", action).withColumn("budget", budget)
    delay = (
        F.when(F.col("action") == "WAIT_AND_RETRY", retry_after(F.col("retry_after"), now))
        .when(F.col("action") == "RETRY_AFTER_CREDENTIAL_REFRESH", backoff(n, REFRESH_BASE, 2.0, REFRESH_MOST))
        .when(F.col("action").startswith("RETRY"), backoff(n))
        .otherwise(0.0)
    )
    return rows.withColumn("delay", delay).withColumn("worker", F.when(auth | limited, "PAUSE_SCOPE").when(conflict | volatile | bridge, "HEALTHY").otherwise(worker[known]))


# Words in an error's text by the code they tell, the first match decides.
CODES_BY_WORDS = (
    ("INVALID_INPUT", ("invalid_input", "malformed", "illegal domain", "id mismatch", "schema error")),
    ("UNSUPPORTED_CONTENT", ("unsupported", "live stream", "vip content")),
    ("AUTH_CHALLENGE", ("auth_challenge", "captcha", "slider", "验证码", "风控验证", "security check")),
    ("AUTH_REQUIRED", ("auth_required", "need login", "session expired", "unauthenticated", "未登录")),
    ("CREDENTIAL_BRIDGE_FAILED", ("credential bridge", "credential_bridge", "scope mismatch", "sidecar disconnect")),
    ("RATE_LIMITED", ("429", "rate limit", "too many requests", "frequency limit")),
    ("UNAVAILABLE_DELETED", ("deleted", "taken down", "unavailable_deleted", "作品已被删除", "作品已被封禁")),
    ("NOT_FOUND", ("404", "not found", "aweme_id not found", "notice_code == 2048", "empty detail")),
    ("PERMISSION_DENIED", ("403", "permission denied", "forbidden", "private_status")),
    ("SERVER_ERROR", ("500", "502", "503", "504", "server error", "gateway timeout")),
    ("TIMEOUT", ("timeout", "timed out", "connect timeout")),
    ("NETWORK", ("connection", "network", "socket", "dns", "ssl", "econnreset")),
    ("VALIDATION_FAILED", ("validation", "corrupt", "ffprobe", "decode failed", "hash mismatch")),
    ("MEDIA_INCOMPLETE", ("incomplete", "missing member", "zero files", "no media files")),
    ("TOOL_ERROR", ("tool error", "ffmpeg missing", "f2 import", "executable broken", "winerror")),
)


def code_from_text(message, subreason):
    """The error code that a raw message tells."""
    text, out = F.lower(F.concat_ws(" ", message, subreason)), None
    for code, words in CODES_BY_WORDS:
        found = F.lit(False)
        for w in words:
            found = found | text.contains(w)
        out = F.when(found, code) if out is None else out.when(found, code)
    return out.otherwise("UNKNOWN")


def outcome(decisions: DataFrame) -> DataFrame:
    """The job's next state from action and worker; a waiting scope is paused too."""
    state = F.when(F.col("action") == "BLOCKED_AUTH", "BLOCKED_AUTH").when(F.col("worker") == "WORKER_UNHEALTHY", "WORKER_UNHEALTHY").when(F.col("action").isin("RETRY", "WAIT_AND_RETRY", "RETRY_AFTER_RERESOLVE", "RETRY_AFTER_CREDENTIAL_REFRESH"), "RETRY_WAIT").otherwise("TERMINAL_FAILED")
    return decisions.withColumn("state", state).withColumn("pauses_scope", (F.col("state") == "RETRY_WAIT") & ((F.col("action") == "WAIT_AND_RETRY") | (F.col("worker") == "PAUSE_SCOPE")))


def accepted_tasks(jobs: DataFrame, tasks: DataFrame, identity: tuple[str, ...]) -> DataFrame:
    """task_id and status of arriving tasks: accepted, refreshed if the same task is known, conflict if its identity differs."""
    known = jobs.select(F.col("task_id").alias("k_id"), *[F.col(c).alias(f"k_{c}") for c in identity])
    same = F.lit(True)
    for c in identity:
        same = same & F.col(c).eqNullSafe(F.col(f"k_{c}"))
    return tasks.join(known, F.col("task_id") == F.col("k_id"), "left").select("task_id", F.when(F.col("k_id").isNull(), "accepted").when(same, "refreshed").otherwise("conflict").alias("status"))


def recovered(jobs: DataFrame, live_owners: DataFrame) -> DataFrame:
    """RUNNING jobs whose owner no longer lives go back to READY. live_owners: claimed_by."""
    live = live_owners.select("claimed_by").distinct().withColumn("lives", F.lit(True))
    lost = (F.col("state") == "RUNNING") & F.col("lives").isNull()
    changed = {"state": F.when(lost, "READY").otherwise(F.col("state")), "claimed_by": F.when(~lost, F.col("claimed_by"))}
    return jobs.join(live, "claimed_by", "left").withColumns(changed).select(*jobs.columns)


class Claimed(NamedTuple):
    claimed: DataFrame
    jobs: DataFrame


def claim(jobs: DataFrame, pauses: DataFrame, worker: str, now: Column, n: int = 1, platforms: list[str] | None = None) -> Claimed:
    """The next n jobs by priority, due time, time of acceptance and number, made RUNNING for a worker.

    jobs: task_id, scope_id, platform, state, priority, next_attempt_at, accepted_at, claimed_by, claimed_at, ...;
    pauses: scope_id, platform, pause_until. A job is changed only if it is still READY or RETRY_WAIT in the table that is
    changed, so a worker that lost the race gets nothing; one writer at a time flips the pointer to the new table.
    """
    due = (F.col("state") == "READY") | ((F.col("state") == "RETRY_WAIT") & (F.col("next_attempt_at") <= now))
    open_jobs = jobs.where(due) if platforms is None else jobs.where(due & F.col("platform").isin(platforms))
    free = open_jobs.join(pauses.where(F.col("pause_until") > now).select("scope_id", "platform"), ["scope_id", "platform"], "left_anti")
    top = free.orderBy(F.desc("priority"), "next_attempt_at", "accepted_at", "task_id").limit(n).select(F.col("task_id").alias("c_id"))
    mine = F.col("c_id").isNotNull() & F.col("state").isin("READY", "RETRY_WAIT")
    after = jobs.join(F.broadcast(top), F.col("task_id") == F.col("c_id"), "left").withColumn("mine", mine)  # n rows
    changed = {"state": F.when(F.col("mine"), "RUNNING").otherwise(F.col("state")), "claimed_by": F.when(F.col("mine"), worker).otherwise(F.col("claimed_by")), "claimed_at": F.when(F.col("mine"), now).otherwise(F.col("claimed_at"))}
    after = after.withColumns(changed)
    return Claimed(after.where("mine").select(*jobs.columns), after.select(*jobs.columns))


def recorded(attempts: DataFrame, new: DataFrame) -> DataFrame:
    """The attempt log with new rows, whose subreasons lose their secrets; nothing in it is ever changed."""
    return attempts.unionByName(new.withColumn("subreason", without_secrets(F.col("subreason"))).select(*attempts.columns))


def with_outcomes(jobs: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Jobs after outcomes (task_id, state, attempt_count, next_attempt_at, error_code, subreason): state changed, claim cleared.

    A missing next time is now. Jobs without an outcome stay as they are; an outcome of an unknown job is left out.
    """
    own = outcomes.select(F.col("task_id").alias("o_id"), *[F.col(c).alias(f"o_{c}") for c in ("state", "attempt_count", "next_attempt_at", "error_code", "subreason")])
    told = F.col("o_id").isNotNull()
    new = {
        "state": F.col("o_state"), "attempt_count": F.col("o_attempt_count"), "next_attempt_at": F.coalesce("o_next_attempt_at", now), "last_error_code": F.col("o_error_code"),
        "last_subreason": without_secrets(F.col("o_subreason")), "claimed_by": F.lit(None), "claimed_at": F.lit(None),
    }
    joined = jobs.join(own, F.col("task_id") == F.col("o_id"), "left")
    return joined.withColumns({c: F.when(told, x).otherwise(F.col(c)) for c, x in new.items()}).select(*jobs.columns)


def with_pauses(pauses: DataFrame, new: DataFrame) -> DataFrame:
    """Pauses by scope and platform, where a new one takes the place of the old; reasons lose their secrets."""
    clean = new.withColumn("reason", without_secrets(F.col("reason"))).select(*pauses.columns)
    return pauses.join(clean.select("scope_id", "platform"), ["scope_id", "platform"], "left_anti").select(*pauses.columns).unionByName(clean)


def active_pauses(pauses: DataFrame, now: Column) -> DataFrame:
    return pauses.where(F.col("pause_until") > now)


def without_pauses(pauses: DataFrame, resumed: DataFrame) -> DataFrame:
    """Pauses but those of the scopes (scope_id, platform) that go on."""
    return pauses.join(resumed.select("scope_id", "platform"), ["scope_id", "platform"], "left_anti").select(*pauses.columns)


def unblocked(jobs: DataFrame, now: Column, scope: str | None = None) -> DataFrame:
    """Jobs that waited for authentication (of one scope) are READY again, from now on."""
    own = (F.col("state") == "BLOCKED_AUTH") if scope is None else (F.col("state") == "BLOCKED_AUTH") & (F.col("scope_id") == scope)
    return jobs.withColumn("own", own).withColumns({"state": F.when(F.col("own"), "READY").otherwise(F.col("state")), "next_attempt_at": F.when(F.col("own"), now).otherwise(F.col("next_attempt_at"))}).select(*jobs.columns)


OUTBOX = ("task_id", "scope_id", "platform", "content_id", "payload", "status", "attempts", "available_at", "first_run", "last_run", "last_error")


def with_tasks(outbox: DataFrame, tasks: DataFrame, now: Column) -> DataFrame:
    """The outbox after tasks (task_id, scope_id, platform, content_id, payload, run_id) were put in.

    A new task is PENDING from now; one that is still PENDING gets the new payload and run; all others stay.
    """
    own = tasks.select(*[F.col(c).alias(f"t_{c}") for c in ("task_id", "scope_id", "platform", "content_id", "payload", "run_id")])
    both = outbox.join(own, F.col("task_id") == F.col("t_task_id"), "full_outer")
    new, renewed = F.col("task_id").isNull(), (F.col("status") == "PENDING") & F.col("t_task_id").isNotNull()
    return both.select(
        *[F.coalesce(c, f"t_{c}").alias(c) for c in ("task_id", "scope_id", "platform", "content_id")], F.when(new | renewed, F.col("t_payload")).otherwise(F.col("payload")).alias("payload"), F.coalesce("status", F.lit("PENDING")).alias("status"),
        F.coalesce("attempts", F.lit(0)).cast("int").alias("attempts"), F.coalesce("available_at", now).alias("available_at"), F.coalesce("first_run", "t_run_id").alias("first_run"), F.when(new | renewed, F.col("t_run_id")).otherwise(F.col("last_run")).alias("last_run"), "last_error",
    )


def acknowledged(outbox: DataFrame, done: DataFrame) -> DataFrame:
    """PENDING tasks (task_id) that were taken over are DISPATCHED; those in any other state stay."""
    own = done.select(F.col("task_id").alias("d_id")).distinct()
    status = F.when((F.col("status") == "PENDING") & F.col("d_id").isNotNull(), "DISPATCHED").otherwise(F.col("status"))
    return outbox.join(own, F.col("task_id") == F.col("d_id"), "left").withColumn("status", status).select(*outbox.columns)


class Intake(NamedTuple):
    verdicts: DataFrame
    jobs: DataFrame
    outbox: DataFrame


def intake(outbox: DataFrame, jobs: DataFrame, faults: DataFrame, now: Column, limit: int | None = None) -> Intake:
    """Due outbox tasks into the job table. faults: task_id, fault of payloads that must not pass (``quality.payload_faults``).

    Verdicts: rejected (a fault), conflict (a known task of another identity), accepted, refreshed. Rejected and conflicting
    tasks FAIL for good; the others are DISPATCHED, which a caller writes only after the new job table: a crash between
    the two leaves them PENDING, and the next intake refreshes instead of doubling them.
    """
    due = outbox.where((F.col("status") == "PENDING") & (F.col("available_at") <= now))
    if limit is not None:
        due = due.orderBy("available_at", "task_id").limit(limit)
    sound = due.join(faults.select("task_id"), "task_id", "left_anti")
    taken = accepted_tasks(jobs, sound, ("scope_id", "platform", "content_id"))
    verdicts = due.join(faults.select("task_id", "fault"), "task_id").select("task_id", F.lit("rejected").alias("verdict"), "fault")
    verdicts = verdicts.unionByName(taken.select("task_id", F.col("status").alias("verdict"), F.lit(None).cast("string").alias("fault")))
    good = taken.where("status <> 'conflict'").select("task_id", F.col("status").alias("took"))
    fresh = sound.join(good.where("took = 'accepted'"), "task_id").select("task_id", "scope_id", "platform", "content_id", "payload", F.lit("READY").alias("state"))
    renewed = sound.join(good.where("took = 'refreshed'"), "task_id").select(F.col("task_id").alias("n_id"), F.col("payload").alias("n_payload"))
    kept = jobs.join(renewed, F.col("task_id") == F.col("n_id"), "left").withColumn("payload", F.coalesce("n_payload", "payload")).select("task_id", "scope_id", "platform", "content_id", "payload", "state")
    told = verdicts.select(F.col("task_id").alias("v_id"), "verdict", "fault")
    bad = F.col("verdict").isin("rejected", "conflict")
    status = F.when(bad, "FAILED").when(F.col("verdict").isNotNull(), "DISPATCHED").otherwise(F.col("status"))
    after = outbox.join(told, F.col("task_id") == F.col("v_id"), "left").withColumns({"status": status, "attempts": F.col("attempts") + F.coalesce(bad, F.lit(False)).cast("int"), "last_error": F.when(bad, F.coalesce("fault", "verdict")).otherwise(F.col("last_error"))})
    return Intake(verdicts, kept.unionByName(fresh), after.select(*outbox.columns))
