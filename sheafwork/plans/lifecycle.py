"""Registered queries of the store's checks, of sync runs, the outbox and the queue, with their SQL.

Expected outcomes in SQL are literal values, not constants that the operators share.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafwork.operators import evaluation, queue, retrieval, runs, store
from sheafwork.plans.queries import _ARRAYS, _HYDRATED, query, retrieval_sql
from sheafwork.plans.views import RICH, UNITS, rich_units, table, units

# Store -------------------------------------------------------------------------------------------------------------


def _with_payload(frame):
    n = F.col("unit_rowid")
    told = F.when(n % 41 == 0, F.concat("statement", F.lit("!"))).otherwise(F.col("statement"))
    payload = F.to_json(F.struct(F.col("unit_type"), told.alias("statement"), "verification_status", F.col("confidence").alias("extraction_confidence")))
    return frame.withColumn("payload", F.when(n % 61 == 0, F.lit("{broken")).otherwise(payload))


@query(f"WITH {UNITS} SELECT unit_rowid, CASE WHEN unit_rowid % 61 = 0 THEN 'payload' ELSE 'projection' END AS fault FROM units WHERE unit_rowid % 61 = 0 OR unit_rowid % 41 = 0")
def projection_equality(spark, sf_dir):
    return store.projection_differs(_with_payload(units(spark, sf_dir)))


def _sizes(*pairs: tuple[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS counter, CAST(({sql}) AS BIGINT) AS value" for name, sql in pairs)


_KEPT_ENTITIES = "(SELECT unit_rowid, unnest(range(len(entities))) AS ordinal FROM rich) x WHERE NOT (unit_rowid % 23 = 0 AND ordinal = 0)"


@query(
    f"WITH {RICH} "
    + _sizes(
        ("assets", "SELECT count(DISTINCT canonical_id) FROM rich WHERE canonical_id <> 'src3'"),
        ("units", "SELECT count(*) FROM rich"),
        ("evidence_refs", "SELECT sum(len(lines)) FROM rich"),
        ("entities", f"SELECT count(*) FROM {_KEPT_ENTITIES}"),
        ("topics", "SELECT sum(3) + count(*) FILTER (WHERE unit_rowid % 47 = 0) FROM rich"),
        ("fts_content_rows", "SELECT count(*) FILTER (WHERE unit_rowid % 31 <> 0) + count(*) FILTER (WHERE unit_rowid % 37 = 0) FROM rich"),
        ("fts_index_rows", "SELECT count(*) FILTER (WHERE unit_rowid % 31 <> 0 AND unit_rowid % 43 <> 0) + count(*) FILTER (WHERE unit_rowid % 37 = 0) FROM rich"),
        ("projection_violations", "SELECT count(*) FROM rich WHERE unit_rowid % 41 = 0 OR unit_rowid % 61 = 0"),
        ("orphan_rows", "SELECT count(*) FILTER (WHERE canonical_id = 'src3') + coalesce(sum(len(lines)) FILTER (WHERE unit_rowid % 53 = 0), 0) FROM rich"),
        ("asset_unit_count_mismatches", "SELECT count(DISTINCT canonical_id) FROM rich WHERE canonical_id LIKE '%7'"),
        ("ku_asset_mismatches", "SELECT count(*) FROM rich WHERE canonical_id = 'src3'"),
        ("duplicate_ordinals", "SELECT count(*) FROM rich WHERE unit_rowid % 47 = 0"),
        ("invalid_ordinals", "SELECT count(*) FILTER (WHERE unit_rowid % 23 = 0 AND len(entities) > 1) + count(*) FILTER (WHERE unit_rowid % 47 = 0) FROM rich"),
        ("fts_missing_content", "SELECT count(*) FROM rich WHERE unit_rowid % 31 = 0"),
        ("fts_orphan_content", "SELECT count(*) FROM rich WHERE unit_rowid % 37 = 0"),
        ("fts_integrity_violations", "SELECT count(*) FROM rich WHERE unit_rowid % 31 <> 0 AND unit_rowid % 43 = 0"),
    )
)
def store_validation(spark, sf_dir):
    """All counters of a store with planted faults."""
    n, rich = F.col("unit_rowid"), _with_payload(rich_units(spark, sf_dir))
    counted = rich.where("canonical_id <> 'src3'").groupBy("canonical_id").agg((F.count(F.lit(1)) + F.when(F.col("canonical_id").endswith("7"), 1).otherwise(0)).alias("unit_count"))
    child = lambda values: rich.select(n, F.posexplode(values).alias("ordinal", "value")).select("unit_rowid", "ordinal")
    entities, topics, refs = child("entities"), child("topics"), child("evidence_refs")
    children = {
        "evidence_refs": refs.withColumn("unit_rowid", F.when(n % 53 == 0, n + 10**9).otherwise(n)),
        "entities": entities.where(~((n % 23 == 0) & (F.col("ordinal") == 0))),
        "topics": topics.unionByName(topics.where((n % 47 == 0) & (F.col("ordinal") == 0))),
    }
    rows = store.text_projection(rich).select("unit_rowid")
    projection = rows.where(n % 31 != 0).unionByName(rows.where(n % 37 == 0).withColumn("unit_rowid", n + 10**9))
    # A row that is left out of the index; rows above the bound are orphans of the content.
    index = projection.where((n > 10**8) | (n % 43 != 0))
    return store.validation(counted, rich, children, projection, index, key="unit_rowid")


@query(f"""
WITH {UNITS}, s AS (SELECT canonical_id, sha256(canonical_id) AS fingerprint, 100 + min(unit_rowid) AS ingested_at FROM units WHERE canonical_id <> 'src3' GROUP BY canonical_id),
i AS (SELECT canonical_id, sha256(canonical_id || CASE WHEN canonical_id LIKE '%4' THEN 'x' ELSE '' END) AS fingerprint FROM (SELECT DISTINCT canonical_id FROM units WHERE canonical_id <> 'src5') d)
SELECT coalesce(s.canonical_id, i.canonical_id) AS canonical_id, coalesce(i.fingerprint, s.fingerprint) AS fingerprint, CASE WHEN s.canonical_id IS NULL OR coalesce(i.canonical_id, '') LIKE '%4' THEN 999 ELSE ingested_at END AS ingested_at FROM s FULL JOIN i ON s.canonical_id = i.canonical_id
""")
def ingest_times(spark, sf_dir):
    u = units(spark, sf_dir)
    stored = u.where("canonical_id <> 'src3'").groupBy("canonical_id").agg((F.min("unit_rowid") + 100).alias("ingested_at")).withColumn("fingerprint", F.sha2("canonical_id", 256))
    incoming = u.where("canonical_id <> 'src5'").select("canonical_id").distinct().withColumn("fingerprint", F.sha2(F.concat("canonical_id", F.when(F.col("canonical_id").endswith("4"), "x").otherwise("")), 256))
    return store.kept_times(stored, incoming, F.lit(999).cast("bigint"))


# Evaluation --------------------------------------------------------------------------------------------------------

_SUITE = {"a": _ARRAYS, "h": _HYDRATED, "z": retrieval.Query("zzzqqq", 5)}


def _suite_sql() -> str:
    columns = "unit_rowid, canonical_id, unit_type, len(lines) AS n_lines, len(list_intersect(topics, ['t2', 'de'])) AS hit_topics, term_coverage"
    parts = " UNION ALL ".join(f"SELECT '{name}' AS query_id, x.* FROM ({retrieval_sql(q, columns, RICH, 'rich')}) x" for name, q in _SUITE.items())
    return f"""
WITH h AS ({parts}), g AS (SELECT unnest(['a', 'h', 'z']) AS query_id)
SELECT g.query_id, coalesce(bool_and(CASE g.query_id WHEN 'a' THEN hit_topics > 0 WHEN 'h' THEN canonical_id IN ('src1', 'src2') ELSE true END), true) AS filter_correct,
  coalesce(bool_and(n_lines > 0 AND unit_rowid % 13 <> 0), true) AS evidence_complete, coalesce(bool_and(canonical_id <> 'src7'), true) AS provenance_complete, coalesce(bool_and(term_coverage = 1), true) AS coverage_valid,
  g.query_id <> 'z' AS filtered, g.query_id <> 'h' OR count(h.query_id) = 0 AS path_correct, count(h.query_id) AS hits FROM g LEFT JOIN h USING (query_id) GROUP BY g.query_id
"""


def _judged(spark, sf_dir):
    """Three golden queries: one by its own filters, one whose declared assets and path its hits don't keep to, one without hits."""
    hits, every = retrieval.retrieve_many(rich_units(spark, sf_dir), _SUITE)
    known = F.when(F.col("canonical_id") != "src7", F.col("canonical_id"))
    told = hits.withColumns({"evidence_complete": evaluation.evidence_complete(F.col("evidence_refs")), "provenance_complete": evaluation.provenance_complete(F.col("knowledge_unit_id"), F.col("canonical_id"), known, known)})
    fields = "query_id string, top_k int, judgment string, path string, required array<bigint>, forbidden array<bigint>, expected_assets array<string>, forbidden_assets array<string>, f_assets array<string>, f_types array<string>, f_statuses array<string>, f_topics array<string>, f_entities array<string>, zero_expected boolean, max_first_rank int"
    golden = spark.createDataFrame(
        [
            ("a", 25, "exhaustive", "fts_trigram", [], [], [], [], [], ["claim", "observation", "opinion"], [], ["t2", "de"], ["e1", "e3", "src4"], False, None),
            ("h", 12, "partial", "substring_short", [], [], [], [], ["src1", "src2"], [], [], [], [], False, 1),
            ("z", 5, "exhaustive", "fts_trigram", [], [], [], [], [], [], [], [], [], True, None),
        ],
        fields,
    )
    return evaluation.verdicts(golden, evaluation.evaluate(golden, every, hits), told), hits


@query(_suite_sql())
def eval_verdicts(spark, sf_dir):
    judged, hits = _judged(spark, sf_dir)
    n = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"))
    return judged.join(n, "query_id", "left").na.fill(0, ["hits"]).drop("passed", "reasons")


@query(f"SELECT count(*) AS queries, round(avg(filter_correct::INT) FILTER (WHERE filtered), 9) AS filter_accuracy, round(avg(path_correct::INT), 9) AS path_correct_rate, round(avg(evidence_complete::INT), 9) AS evidence_complete_rate, round(avg(provenance_complete::INT), 9) AS provenance_complete_rate, round(avg(coverage_valid::INT), 9) AS coverage_valid_rate FROM ({_suite_sql()}) s")
def eval_filter_accuracy(spark, sf_dir):
    return evaluation.rates(_judged(spark, sf_dir)[0]).drop("passed")


# Sync runs ---------------------------------------------------------------------------------------------------------

_RUNS = """runs AS (SELECT 'r' || c_custkey AS run_id, c_custkey AS scope_id, 'p' AS platform, CASE WHEN c_custkey % 5 < 3 THEN 'running' WHEN c_custkey % 5 = 3 THEN 'completed' ELSE 'failed' END AS status, CASE WHEN c_custkey % 5 = 3 THEN '' || c_custkey END AS candidate_watermark FROM customer),
states AS (SELECT c_custkey AS scope_id, 'p' AS platform, '' || c_custkey * 10 AS watermark, c_custkey % 2 = 0 AS history_complete, 'old' || c_custkey AS last_run_id FROM customer WHERE c_custkey % 3 <> 0)"""


def _runs(spark, sf_dir):
    k, c = F.col("c_custkey"), table(spark, sf_dir, "customer")
    none = F.lit(None).cast("string")
    r = c.select(
        F.concat(F.lit("r"), k.cast("string")).alias("run_id"), k.alias("scope_id"), F.lit("p").alias("platform"), F.when(k % 5 < 3, "running").when(k % 5 == 3, "completed").otherwise("failed").alias("status"), none.alias("previous_watermark"),
        F.when(k % 5 == 3, k.cast("string")).alias("candidate_watermark"), *[none.alias(x) for x in runs.RUN[6:]],
    )
    s = c.where(k % 3 != 0).select(k.alias("scope_id"), F.lit("p").alias("platform"), (k * 10).cast("string").alias("watermark"), (k % 2 == 0).alias("history_complete"), F.lit("c0").alias("backfill_cursor"), F.concat(F.lit("old"), k.cast("string")).alias("last_run_id"))
    return r, s


@query(f"""
WITH {_RUNS}, q AS (SELECT CASE WHEN c_custkey % 7 = 0 THEN 'n' ELSE 'r' END || c_custkey AS run_id, c_custkey + (c_custkey % 11 = 0)::INT AS scope_id, 'p' AS platform FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 7 = 0)
SELECT q.run_id, CASE WHEN r.run_id IS NULL THEN 'begun' WHEN r.status <> 'running' THEN 'concluded' WHEN r.scope_id = q.scope_id THEN 'running' ELSE 'other_scope' END AS verdict, s.watermark AS previous_watermark
FROM q LEFT JOIN runs r ON r.run_id = q.run_id LEFT JOIN states s ON s.scope_id = q.scope_id
""")
def sync_begin(spark, sf_dir):
    r, s = _runs(spark, sf_dir)
    k = F.col("c_custkey")
    asked = table(spark, sf_dir, "customer").where((k % 2 == 0) | (k % 7 == 0)).select(F.concat(F.when(k % 7 == 0, "n").otherwise("r"), k.cast("string")).alias("run_id"), (k + F.when(k % 11 == 0, 1).otherwise(0)).alias("scope_id"), F.lit("p").alias("platform"))
    return runs.begin(r, s, asked).verdicts


_STAGED = """rows AS (SELECT 'r' || o_custkey AS run_id, CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE 'i' || o_orderkey % 6 END AS content_id, CASE WHEN o_totalprice > 100000 THEN 'video' ELSE 'image_album' END AS content_type, o_orderpriority AS payload, o_orderkey AS staged_at FROM orders)"""


def _rows(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("r"), F.col("o_custkey").cast("string")).alias("run_id"), F.when(k % 19 == 0, "").otherwise(F.concat(F.lit("i"), (k % 6).cast("string"))).alias("content_id"), F.when(F.col("o_totalprice") > 100000, "video").otherwise("image_album").alias("content_type"),
        F.col("o_orderpriority").alias("payload"), F.lit(False).alias("reappeared"), k.alias("staged_at"),
    )


def _staging(spark, sf_dir):
    r, _ = _runs(spark, sf_dir)
    rows = _rows(spark, sf_dir)
    return runs.stage(rows.where("false"), r, rows)


_MERGED = f"""{_RUNS}, {_STAGED}, staging AS (SELECT run_id, content_id, arg_min(content_type, staged_at) AS content_type, arg_max(payload, staged_at) AS payload, max(staged_at) AS staged_at FROM rows JOIN runs USING (run_id) WHERE status = 'running' AND content_id <> '' GROUP BY run_id, content_id)"""


@query(f"WITH {_MERGED} SELECT run_id, content_id, content_type, payload, staged_at FROM staging")
def sync_stage(spark, sf_dir):
    return _staging(spark, sf_dir).staging.drop("reappeared")


@query(f"WITH {_RUNS}, {_STAGED} SELECT run_id, content_id, CASE WHEN status <> 'running' THEN 'not_running' ELSE 'no_content_id' END AS fault FROM rows JOIN runs USING (run_id) WHERE status <> 'running' OR content_id = ''")
def sync_stage_faults(spark, sf_dir):
    return _staging(spark, sf_dir).faults


_ENDS = f"""{_MERGED},
q AS (SELECT 'r' || c_custkey AS run_id, CASE WHEN c_custkey % 4 <> 0 THEN '' || c_custkey END AS candidate, CASE WHEN c_custkey % 13 = 0 THEN 'other' WHEN c_custkey % 3 <> 0 THEN '' || c_custkey * 10 END AS expected FROM customer WHERE c_custkey % 6 <> 5 UNION ALL SELECT 'gone', '1', NULL),
v AS (SELECT q.*, r.scope_id, s.watermark, s.history_complete, s.last_run_id, CASE WHEN r.run_id IS NULL THEN 'unknown_run' WHEN status = 'completed' AND candidate_watermark IS NOT DISTINCT FROM candidate THEN 'already_completed' WHEN status = 'completed' THEN 'other_watermark' WHEN status <> 'running' THEN 'not_running'
  WHEN s.scope_id IS NOT NULL AND expected IS NOT NULL AND expected IS DISTINCT FROM watermark THEN 'watermark_moved' ELSE 'completed' END AS verdict FROM q LEFT JOIN runs r USING (run_id) LEFT JOIN states s USING (scope_id)),
items AS (SELECT o_custkey AS scope_id, 'i' || o_orderkey % 9 AS content_id, max(o_orderkey) AS at FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2)"""


def _finished(spark, sf_dir):
    r, s = _runs(spark, sf_dir)
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    asked = table(spark, sf_dir, "customer").where(k % 6 != 5).select(F.concat(F.lit("r"), k.cast("string")).alias("run_id"), F.when(k % 4 != 0, k.cast("string")).alias("candidate_watermark"), F.when(k % 13 == 0, "other").when(k % 3 != 0, (k * 10).cast("string")).alias("expected_watermark"))
    asked = asked.unionByName(spark.createDataFrame([("gone", "1", None)], "run_id string, candidate_watermark string, expected_watermark string"))
    asked = asked.withColumns({"expected_last_run": none, "history_complete": F.lit(None).cast("boolean"), "backfill_cursor": none, "stop_reason": F.lit("end")}).drop("x")
    o = F.col("o_orderkey")
    items = table(spark, sf_dir, "orders").where(o % 2 == 0).groupBy(F.col("o_custkey").alias("scope_id"), F.concat(F.lit("i"), (o % 9).cast("string")).alias("content_id")).agg(F.max(o).alias("last_seen"))
    items = items.select("scope_id", F.lit("p").alias("platform"), "content_id", F.lit("old").alias("content_type"), F.lit(True).alias("active"), F.col("last_seen").alias("first_seen"), "last_seen", F.lit(3).cast("bigint").alias("observed_count"), F.lit("old").alias("payload"))
    off = asked.select("run_id", F.lit("i8").alias("content_id"))
    return runs.finish(r, s, _staging(spark, sf_dir).staging, items, asked, off, F.lit(0))


@query(f"WITH {_ENDS} SELECT run_id, verdict FROM v")
def sync_finish_verdicts(spark, sf_dir):
    return _finished(spark, sf_dir).verdicts


@query(f"""
WITH {_ENDS}, d AS (SELECT * FROM v WHERE verdict = 'completed'), p AS (SELECT d.scope_id, content_id, content_type, payload, staged_at FROM staging JOIN d USING (run_id))
SELECT coalesce(i.scope_id, p.scope_id) AS scope_id, coalesce(i.content_id, p.content_id) AS content_id, coalesce(p.content_type, 'old') AS content_type, NOT (coalesce(i.content_id, p.content_id) = 'i8' AND coalesce(i.scope_id, p.scope_id) IN (SELECT scope_id FROM d)) AS active,
  coalesce(i.at, p.staged_at) AS first_seen, coalesce(p.staged_at, i.at) AS last_seen, CASE WHEN i.at IS NULL THEN 0 ELSE 3 END + (p.staged_at IS NOT NULL)::INT AS observed_count, coalesce(p.payload, 'old') AS payload
FROM items i FULL JOIN p ON p.scope_id = i.scope_id AND p.content_id = i.content_id
""")
def sync_finish_items(spark, sf_dir):
    return _finished(spark, sf_dir).items.drop("platform", "updated_at").withColumn("observed_count", F.col("observed_count").cast("int"))


@query(f"WITH {_ENDS} SELECT s.scope_id, coalesce(d.candidate, s.watermark) AS watermark, s.history_complete OR coalesce(d.candidate IS NOT NULL, false) AS history_complete, CASE WHEN d.run_id IS NULL OR NOT (s.history_complete OR d.candidate IS NOT NULL) THEN 'c0' END AS backfill_cursor, coalesce(d.run_id, s.last_run_id) AS last_run_id FROM states s LEFT JOIN (SELECT * FROM v WHERE verdict = 'completed') d USING (scope_id)")
def sync_finish_states(spark, sf_dir):
    return _finished(spark, sf_dir).states.drop("platform")


@query(f"""
WITH {_RUNS}, q AS (SELECT 'r' || c_custkey AS run_id, CASE WHEN c_custkey % 2 = 0 THEN 'Cookie=abc' ELSE 'line down' END AS m FROM customer WHERE c_custkey % 7 < 5)
SELECT run_id, CASE WHEN status = 'running' AND m IS NOT NULL THEN 'failed' ELSE status END AS status, CASE WHEN status = 'running' AND m IS NOT NULL THEN CASE WHEN m = 'line down' THEN m ELSE 'Sanitized error message (contained potential credential pattern)' END END AS error_message FROM runs LEFT JOIN q USING (run_id)
""")
def sync_fail(spark, sf_dir):
    r, _ = _runs(spark, sf_dir)
    k = F.col("c_custkey")
    asked = table(spark, sf_dir, "customer").where(k % 7 < 5).select(F.concat(F.lit("r"), k.cast("string")).alias("run_id"), F.lit("E").alias("error_code"), F.when(k % 2 == 0, "Cookie=abc").otherwise("line down").alias("error_message"), F.lit("error").alias("stop_reason"))
    return runs.fail(r, _rows(spark, sf_dir), asked).runs.select("run_id", "status", "error_message")


@query(f"WITH {_RUNS} SELECT run_id, CASE WHEN status = 'running' THEN 'aborted' ELSE status END AS status, CASE WHEN status = 'running' THEN 'PROCESS_TERMINATED_ABNORMALLY' END AS error_code, CASE WHEN status = 'running' THEN 'manual_abort' END AS stop_reason FROM runs")
def sync_recover(spark, sf_dir):
    r, _ = _runs(spark, sf_dir)
    return runs.recover(r, _rows(spark, sf_dir)).runs.select("run_id", "status", "error_code", "stop_reason")


# Outbox and queue --------------------------------------------------------------------------------------------------

_OUT = """ob AS (SELECT o_orderkey AS task_id, o_custkey AS scope_id, o_orderkey % 97 AS content_id, 'p' || o_orderkey AS payload, CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'F' THEN 'DISPATCHED' ELSE 'FAILED' END AS status, o_orderkey % 3 AS attempts, o_orderkey % 50 AS due_at FROM orders WHERE o_orderkey % 3 <> 0)"""


def _outbox(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").where(k % 3 != 0).select(
        k.alias("task_id"), F.col("o_custkey").alias("scope_id"), F.lit("p").alias("platform"), (k % 97).alias("content_id"), F.concat(F.lit("p"), k.cast("string")).alias("payload"),
        F.expr("case o_orderstatus when 'O' then 'PENDING' when 'F' then 'DISPATCHED' else 'FAILED' end").alias("status"), (k % 3).cast("int").alias("attempts"), (k % 50).alias("available_at"), F.lit("r1").alias("first_run"), F.lit("r1").alias("last_run"), F.lit(None).cast("string").alias("last_error"),
    )


@query(f"""WITH {_OUT}, t AS (SELECT o_orderkey AS task_id, 'new' || o_orderkey AS payload FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(ob.task_id, t.task_id) AS task_id, CASE WHEN t.task_id IS NOT NULL AND coalesce(ob.status, 'PENDING') = 'PENDING' THEN t.payload ELSE ob.payload END AS payload, coalesce(ob.status, 'PENDING') AS status, coalesce(ob.due_at, 77) AS available_at, CASE WHEN ob.task_id IS NULL THEN 'r2' ELSE 'r1' END AS first_run,
  CASE WHEN t.task_id IS NOT NULL AND coalesce(ob.status, 'PENDING') = 'PENDING' THEN 'r2' ELSE 'r1' END AS last_run FROM ob FULL JOIN t ON ob.task_id = t.task_id""")
def outbox_upsert(spark, sf_dir):
    k = F.col("o_orderkey")
    tasks = table(spark, sf_dir, "orders").where(k % 2 == 0).select(k.alias("task_id"), F.col("o_custkey").alias("scope_id"), F.lit("p").alias("platform"), (k % 97).alias("content_id"), F.concat(F.lit("new"), k.cast("string")).alias("payload"), F.lit("r2").alias("run_id"))
    return queue.with_tasks(_outbox(spark, sf_dir), tasks, F.lit(77).cast("bigint")).select("task_id", "payload", "status", "available_at", "first_run", "last_run")


@query(f"WITH {_OUT} SELECT task_id, CASE WHEN status = 'PENDING' AND task_id % 5 < 2 THEN 'DISPATCHED' ELSE status END AS status FROM ob")
def outbox_ack(spark, sf_dir):
    return queue.acknowledged(_outbox(spark, sf_dir), table(spark, sf_dir, "orders").where("o_orderkey % 5 < 2").select(F.col("o_orderkey").alias("task_id"))).select("task_id", "status")


_TAKEN = f"""{_OUT}, v AS (SELECT *, CASE WHEN status <> 'PENDING' OR due_at > 30 THEN NULL WHEN task_id % 10 = 0 THEN 'rejected' WHEN task_id % 4 <> 0 THEN 'accepted' WHEN task_id % 28 = 0 THEN 'conflict' ELSE 'refreshed' END AS verdict FROM ob)"""


def _taken(spark, sf_dir):
    k, due = F.col("o_orderkey"), F.lit(30).cast("bigint")
    known = table(spark, sf_dir, "orders").where(k % 4 == 0).select(k.alias("task_id"), F.col("o_custkey").alias("scope_id"), F.lit("p").alias("platform"), (k % 97 + F.when(k % 28 == 0, 1).otherwise(0)).alias("content_id"), F.lit("known").alias("payload"), F.lit("RUNNING").alias("state"))
    bad = table(spark, sf_dir, "orders").where(k % 10 == 0).select(k.alias("task_id"), F.lit("secret").alias("fault"))
    return queue.intake(_outbox(spark, sf_dir), known, bad, due)


@query(f"WITH {_TAKEN} SELECT task_id, CASE WHEN verdict IN ('rejected', 'conflict') THEN 'FAILED' WHEN verdict IS NOT NULL THEN 'DISPATCHED' ELSE status END AS status, CAST(attempts + coalesce(verdict IN ('rejected', 'conflict'), false)::INT AS INTEGER) AS attempts, CASE verdict WHEN 'rejected' THEN 'secret' WHEN 'conflict' THEN 'conflict' END AS last_error FROM v")
def outbox_intake(spark, sf_dir):
    return _taken(spark, sf_dir).outbox.select("task_id", "status", F.col("attempts").cast("int").alias("attempts"), "last_error")


@query(f"WITH {_TAKEN} SELECT task_id, CASE WHEN verdict = 'refreshed' THEN payload ELSE 'known' END AS payload, 'RUNNING' AS state FROM (SELECT o_orderkey AS task_id, v.verdict, v.payload FROM orders LEFT JOIN v ON v.task_id = o_orderkey WHERE o_orderkey % 4 = 0) k UNION ALL SELECT task_id, payload, 'READY' FROM v WHERE verdict = 'accepted'")
def jobs_after_intake(spark, sf_dir):
    return _taken(spark, sf_dir).jobs.select("task_id", "payload", "state")


_QUEUED = """jobs AS (SELECT o_orderkey AS task_id, o_custkey AS scope_id, CASE WHEN o_orderkey % 2 = 0 THEN 'p' ELSE 'q' END AS platform, CASE o_orderstatus WHEN 'O' THEN 'READY' WHEN 'P' THEN 'RETRY_WAIT' ELSE 'BLOCKED_AUTH' END AS state, CAST(o_orderkey % 4 AS INTEGER) AS priority, o_orderdate AS next_attempt_at, o_orderkey % 11 AS accepted_at FROM orders)"""


def _queued(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("task_id"), F.col("o_custkey").alias("scope_id"), F.when(k % 2 == 0, "p").otherwise("q").alias("platform"), F.expr("case o_orderstatus when 'O' then 'READY' when 'P' then 'RETRY_WAIT' else 'BLOCKED_AUTH' end").alias("state"), (k % 4).cast("int").alias("priority"),
        F.col("o_orderdate").alias("next_attempt_at"), (k % 11).alias("accepted_at"), F.lit(None).cast("string").alias("claimed_by"), F.lit(None).cast("timestamp_ntz").alias("claimed_at"), F.lit(0).alias("attempt_count"), F.lit(None).cast("string").alias("last_error_code"), F.lit(None).cast("string").alias("last_subreason"),
    )


def _now():
    return F.expr("timestamp_ntz'1997-06-01 00:00:00'")


@query(f"""WITH {_QUEUED}, c AS (SELECT * FROM jobs WHERE (state = 'READY' OR (state = 'RETRY_WAIT' AND next_attempt_at <= TIMESTAMP '1997-06-01')) AND platform = 'p' AND scope_id % 3 <> 0),
t AS (SELECT task_id FROM c ORDER BY priority DESC, next_attempt_at, accepted_at, task_id LIMIT 40)
SELECT task_id, CASE WHEN task_id IN (SELECT task_id FROM t) THEN 'RUNNING' ELSE state END AS state, CASE WHEN task_id IN (SELECT task_id FROM t) THEN 'w1' END AS claimed_by FROM jobs""")
def queue_claim(spark, sf_dir):
    pauses = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("scope_id"), F.lit("p").alias("platform"), F.expr("timestamp_ntz'2030-01-01 00:00:00'").alias("pause_until"))
    return queue.claim(_queued(spark, sf_dir), pauses, "w1", _now(), 40, ["p"]).jobs.select("task_id", "state", "claimed_by")


@query(f"""WITH {_QUEUED} SELECT task_id, CASE WHEN task_id % 6 = 0 THEN 'RETRY_WAIT' ELSE state END AS state, CAST(CASE WHEN task_id % 6 = 0 THEN 2 ELSE 0 END AS INTEGER) AS attempt_count, CASE WHEN task_id % 6 <> 0 THEN next_attempt_at WHEN task_id % 12 = 0 THEN TIMESTAMP '1997-06-01' ELSE TIMESTAMP '1999-01-01' END AS next_attempt_at, CASE WHEN task_id % 6 = 0 THEN 'token=[REDACTED]' END AS last_subreason FROM jobs""")
def queue_outcomes(spark, sf_dir):
    jobs = _queued(spark, sf_dir)
    t = F.col("task_id")
    told = jobs.where(t % 6 == 0).select(t, F.lit("RETRY_WAIT").alias("state"), F.lit(2).alias("attempt_count"), F.when(t % 12 != 0, F.expr("timestamp_ntz'1999-01-01 00:00:00'")).alias("next_attempt_at"), F.lit("NETWORK").alias("error_code"), F.lit("token=abc").alias("subreason"))
    return queue.with_outcomes(jobs, told, _now()).select("task_id", "state", "attempt_count", "next_attempt_at", "last_subreason")


@query(f"WITH {_QUEUED} SELECT task_id, CASE WHEN state = 'BLOCKED_AUTH' AND scope_id = 7 THEN 'READY' ELSE state END AS state FROM jobs")
def queue_unblock(spark, sf_dir):
    return queue.unblocked(_queued(spark, sf_dir), _now(), 7).select("task_id", "state")


@query("""
WITH p AS (SELECT c_custkey AS scope_id, c_custkey % 40 AS pause_until FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT c_custkey AS scope_id, 50 AS pause_until FROM customer WHERE c_custkey % 6 = 0),
m AS (SELECT * FROM n UNION ALL SELECT * FROM p WHERE scope_id NOT IN (SELECT scope_id FROM n)) SELECT scope_id, CAST(pause_until AS BIGINT) AS pause_until, CASE WHEN pause_until = 50 THEN 'token=[REDACTED]' ELSE 'old' END AS reason FROM m WHERE scope_id % 10 <> 0 AND pause_until > 20
""")
def queue_pauses(spark, sf_dir):
    k, c = F.col("c_custkey"), table(spark, sf_dir, "customer")
    frame = lambda rows, until, why: rows.select(k.alias("scope_id"), F.lit("p").alias("platform"), until.cast("bigint").alias("pause_until"), F.lit(why).alias("reason"))
    after = queue.with_pauses(frame(c.where(k % 2 == 0), k % 40, "old"), frame(c.where(k % 6 == 0), F.lit(50), "token=abc"))
    return queue.active_pauses(queue.without_pauses(after, frame(c.where(k % 10 == 0), F.lit(0), "")), F.lit(20)).select("scope_id", "pause_until", "reason")


_CASES = (
    ("CREDENTIAL_BRIDGE_FAILED", "SCOPE_MISMATCH", "", "", 1, "TERMINAL", 1, 0.0, "HEALTHY"),
    ("CREDENTIAL_BRIDGE_FAILED", "SIDECAR", "", "", 1, "RETRY_AFTER_CREDENTIAL_REFRESH", 2, 1.0, "HEALTHY"),
    ("CREDENTIAL_BRIDGE_FAILED", "SIDECAR", "", "", 2, "TERMINAL", 2, 0.0, "HEALTHY"),
    ("RATE_LIMITED", "", "", "Wed, 21 Oct 2026 07:28:00 GMT", 9, "WAIT_AND_RETRY", None, 90.0, "PAUSE_SCOPE"),
    ("RATE_LIMITED", "", "", "Wed, 21 Oct 2020 07:28:00 GMT", 1, "WAIT_AND_RETRY", None, 60.0, "PAUSE_SCOPE"),
    ("RATE_LIMITED", "", "", "-4", 1, "WAIT_AND_RETRY", None, 60.0, "PAUSE_SCOPE"),
    ("RATE_LIMITED", "", "", "0.5", 1, "WAIT_AND_RETRY", None, 1.0, "PAUSE_SCOPE"),
    ("NOT_FOUND", "STALE_URL", "", "", 1, "RETRY_AFTER_RERESOLVE", 2, 2.0, "HEALTHY"),
    ("UNAVAILABLE_DELETED", "url_signature_expired", "", "", 2, "TERMINAL", 2, 0.0, "HEALTHY"),
    ("NOT_FOUND", "", "", "", 1, "TERMINAL", 1, 0.0, "HEALTHY"),
    ("TOOL_ERROR", "", "Archive conflict", "", 1, "TERMINAL", 1, 0.0, "HEALTHY"),
    ("SANDBOX_PATH_ESCAPE", "", "", "", 1, "TERMINAL", 1, 0.0, "WORKER_UNHEALTHY"),
    ("NETWORK", "NAME_CONFLICT", "", "", 2, "RETRY", 3, 4.0, "HEALTHY"),
    ("ODD", "", "", "", 1, "RETRY", 2, 2.0, "HEALTHY"),
)


def _literal(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


@query(
    "WITH t(n, code, action, budget, delay, worker) AS (VALUES "
    + ", ".join(f"({k}, '{c[0]}', {_literal(c[5])}, {_literal(c[6])}, {c[7]}, '{c[8]}')" for k, c in enumerate(_CASES))
    + f") SELECT l_orderkey, l_linenumber, code, action, CAST(budget AS INTEGER) AS budget, CAST(delay AS DOUBLE) AS delay, worker FROM lineitem JOIN t ON t.n = l_partkey % {len(_CASES)}"
)
def retry_rules(spark, sf_dir):
    """Rules by literal cases: codes, subreasons, messages and dates in, expected decisions out."""
    at = (F.col("l_partkey") % len(_CASES)).cast("int")
    pick = lambda k: F.get(F.array(*[F.lit(c[k]) for c in _CASES]), at)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", pick(0).alias("error_code"), pick(1).alias("subreason"), pick(2).alias("message"), pick(3).alias("retry_after"), pick(4).alias("attempt"))
    found = queue.retry_decisions(rows, F.lit("2026-10-21T07:26:30Z").cast("timestamp"))
    return found.select("l_orderkey", "l_linenumber", F.col("error_code").alias("code"), "action", "budget", "delay", "worker")
