"""Registered queries of what comes in: pages, manifests, stages and keyed tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafwork.operators import stages
from sheafwork.plans.queries import query
from sheafwork.plans.views import SEGMENTS, segments, table
from sheafwork.sources import assets, pages

_RAW = (
    # http, error, raw -> fault, cursor, has_more, items
    (200, "", '{"status_code": 0, "cursor": 17, "has_more": 1, "aweme_list": [{"aweme_id": "1"}, {"aweme_id": "2"}]}', None, "17", True, 2),
    (200, "", '{"status_code": 0, "has_more": 0, "aweme_list": null}', None, "0", False, 0),
    (200, "", '{"status_code": 0, "cursor": 5, "has_more": true}', "no_list", None, None, None),
    (200, "", '{"status_code": 0, "aweme_list": {"a": 1}}', "list_shape", None, None, None),
    (200, "", '{"status_code": 8}', "platform", None, None, None),
    (200, "", '{"cursor": 8}', "no_status", None, None, None),
    (200, "", "<html>", "json", None, None, None),
    (429, "", "{}", "http", None, None, None),
    (None, "", "{}", "no_http_status", None, None, None),
    (None, "TIMEOUT", "", "timeout", None, None, None),
    (None, "RESET", "", "transport", None, None, None),
)


def _value(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


@query("WITH t(n, fault, response_cursor, has_more, items) AS (VALUES " + ", ".join(f"({k}, {', '.join(_value(v) for v in r[3:])})" for k, r in enumerate(_RAW)) + f") SELECT event_id, fault, response_cursor, has_more, CAST(items AS INTEGER) AS items FROM events JOIN t ON t.n = event_id % {len(_RAW)}")
def page_responses(spark, sf_dir):
    at = (F.col("event_id") % len(_RAW)).cast("int")
    rows = table(spark, sf_dir, "events").select("event_id", *[F.get(F.array(*[F.lit(r[k]) for r in _RAW]), at).alias(n) for k, n in enumerate(("http_status", "fetch_error", "raw"))])
    return pages.responses(rows).select("event_id", "fault", "response_cursor", "has_more", F.when(F.col("items").isNotNull(), F.size("items")).alias("items"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' || event_id WHEN 1 THEN '0' WHEN 2 THEN '' || event_id END AS cursor, CAST(CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 10 ELSE event_id % 5 END AS INTEGER) AS count FROM events")
def cursor_checks(spark, sf_dir):
    n = F.col("event_id")
    raw = F.when(n % 4 == 0, n.cast("string")).when(n % 4 == 2, F.concat(F.lit(" "), n.cast("string"), F.lit(" "))).when(n % 4 == 3, F.concat(F.lit("-"), n.cast("string")))
    return table(spark, sf_dir, "events").select(n, pages.cursor_of(raw).alias("cursor"), pages.count_of(F.when(n % 5 != 1, (n % 5).cast("int")), 10).alias("count"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Cookie,access_token' WHEN 1 THEN '' WHEN 2 THEN '' ELSE 'password' END AS keys FROM events""")
def sensitive_key_scan(spark, sf_dir):
    texts = ('{"a": {"Cookie": 1, "b": [{"access_token": "x"}]}}', '{"text": "say \\"cookie\\": now", "cookie_jar": 1}', '{"tokens": "password"}', '[{"password" : null}]')
    text = F.get(F.array(*[F.lit(t) for t in texts]), (F.col("event_id") % 4).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(pages.sensitive_keys(text), ",").alias("keys"))


@query("""
SELECT o_orderkey AS page_number, CASE WHEN o_orderkey % 11 = 0 THEN 'invalid_id' WHEN o_orderkey % 7 = 0 THEN 'secret' WHEN o_orderkey % 2 = 0 THEN 'new' WHEN o_orderkey % 3 = 0 THEN 'conflict' ELSE 'replay' END AS verdict FROM orders
""")
def archive_gate(spark, sf_dir):
    k = F.col("o_orderkey")
    run = F.when(k % 11 == 0, "../x").otherwise("run_1")
    raw = F.when(k % 7 == 0, '{"sessionid": 1}').otherwise(F.concat(F.lit('{"n": '), k.cast("string"), F.lit("}")))
    new = table(spark, sf_dir, "orders").select(run.alias("run_id"), k.alias("page_number"), raw.alias("raw"), F.sha2(raw, 256).alias("sha256"))
    old = new.where("page_number % 2 = 1").select("run_id", "page_number", F.when(F.col("page_number") % 3 == 0, "other").otherwise(F.col("sha256")).alias("sha256"))
    return pages.archive_verdicts(old, new).select("page_number", "verdict")


@query("""
WITH a AS (SELECT c_custkey AS asset, unnest(['asr', 'visual', 'knowledge']) AS stage FROM customer),
s AS (SELECT asset, stage, CASE WHEN asset % 5 = 0 AND stage = 'visual' THEN 'failed' WHEN asset % 7 = 0 AND stage = 'knowledge' THEN 'running' ELSE 'completed' END AS status, asset % 3 = 0 AND stage = 'asr' AS changed FROM a WHERE NOT (asset % 11 = 0 AND stage = 'asr')),
r AS (SELECT a.asset, a.stage, CASE WHEN s.status IS NULL THEN 'pending' WHEN s.status = 'failed' THEN 'failed' WHEN s.status = 'running' THEN 'pending' WHEN s.changed THEN 'changed' WHEN a.stage = 'knowledge' AND a.asset % 3 = 0 AND a.asset % 11 <> 0 THEN 'upstream' END AS reason FROM a LEFT JOIN s ON s.asset = a.asset AND s.stage = a.stage)
SELECT asset, stage, reason FROM r WHERE reason IS NOT NULL
""")
def due_stages(spark, sf_dir):
    k, s = F.col("asset"), F.col("stage")
    own = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("asset"), F.explode(F.array(F.lit("asr"), F.lit("visual"), F.lit("knowledge"))).alias("stage"))
    states = own.where(~((k % 11 == 0) & (s == "asr"))).select(k, s, F.when((k % 5 == 0) & (s == "visual"), "failed").when((k % 7 == 0) & (s == "knowledge"), "running").otherwise("completed").alias("status"), F.lit("f").alias("fingerprint"))
    wanted = own.select(k, s, F.when((k % 3 == 0) & (s == "asr"), "g").when(s == "asr", "f").alias("fingerprint"))
    return stages.due_stages(states, wanted, {"knowledge": ("asr", "visual")}).select("asset", "stage", "reason")


@query("SELECT l_orderkey AS asset, l_suppkey AS chunk_id, count(*) FILTER (WHERE l_returnflag <> 'R') AS accepted, count(*) FILTER (WHERE l_returnflag = 'R') AS rejected, count(*) AS raw FROM lineitem GROUP BY 1, 2")
def extraction_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("asset"), F.col("l_suppkey").alias("chunk_id"), "l_returnflag")
    return stages.extraction_totals(rows.where("l_returnflag <> 'R'"), rows.where("l_returnflag = 'R'"))


@query(f"""WITH {SEGMENTS} SELECT conv_id AS asset, turn, row_number() OVER (PARTITION BY conv_id ORDER BY (modality <> 'speech')::INT, CASE WHEN modality = 'speech' THEN start ELSE turn // 2 END, CASE WHEN modality = 'speech' THEN turn WHEN modality = 'visual_text' THEN 0 ELSE 1 END, segment_id) AS place FROM segments""")
def evidence_order(spark, sf_dir):
    s = segments(spark, sf_dir).select(F.col("conv_id").alias("asset"), "turn", "modality", "start", F.col("turn").alias("segment_order"), F.floor(F.col("turn") / 2).alias("sequence_index"), F.col("segment_id").alias("evidence_id"))
    return stages.evidence_order(s).select("asset", "turn", F.col("place").cast("bigint").alias("place"))


@query("""
SELECT event_id AS content_id, CASE WHEN event_id % 3 = 0 THEN event_id ELSE event_id - 100 END AS first_seen, event_id AS last_seen, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 OR event_id % 5 = 0 THEN event_id WHEN event_id % 2 = 0 THEN event_id - 50 END AS reappeared_at,
  CASE WHEN event_id % 3 = 0 THEN 1 ELSE event_id % 4 + 1 END AS observed_count, event_id % 3 = 0 AS is_first, event_id % 3 <> 0 AND (event_id % 3 = 1 OR event_id % 5 = 0) AS is_reappearance FROM events
""")
def collection_states(spark, sf_dir):
    n = F.col("event_id")
    known = n % 3 != 0
    seen = table(spark, sf_dir, "events").select(
        n.alias("content_id"), n.alias("observed_at"), F.lit(1).alias("position"), (n % 5 == 0).alias("reappears"), F.when(known, n - 100).alias("p_first"), F.when(known, n % 4).alias("p_count"), F.when(known, n % 3 == 2).alias("p_active"), F.when(known & (n % 2 == 0), n - 50).alias("p_reappeared")
    )
    return stages.collection_state(seen).drop("last_position")


@query("SELECT CAST(row_number() OVER (ORDER BY last_seen DESC, content_id) AS INTEGER) AS place, content_id, last_seen FROM (SELECT o_orderkey AS content_id, o_orderdate AS last_seen FROM orders WHERE o_orderstatus = 'O' ORDER BY last_seen DESC, content_id LIMIT 25 OFFSET 50) x")
def items_page(spark, sf_dir):
    from pyspark.sql import Window

    items = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("content_id"), F.col("o_orderdate").alias("last_seen"), (F.col("o_orderstatus") == "O").alias("active"))
    top = assets.listed(items, 25, 50, True)
    return top.select(F.row_number().over(Window.orderBy(F.desc("last_seen"), "content_id")).alias("place"), "content_id", "last_seen")  # 25 rows


@query("SELECT md5('' || o_custkey) AS hash, arg_max(o_orderkey, o_orderkey) AS video_id, max(o_orderkey) AS updated_at FROM orders GROUP BY o_custkey")
def content_index(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.md5(F.col("o_custkey").cast("string")).alias("hash"), F.col("o_orderkey").alias("video_id"), F.col("o_orderkey").alias("updated_at"))
    return assets.indexed(rows.where("video_id % 2 = 0"), rows.where("video_id % 2 = 1"))


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'old' ELSE 'new' END AS first_seen, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE 'old' END AS state FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def keyed_upsert(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    row = lambda rows, v: rows.select("k", F.lit(v).alias("first_seen"), F.lit(v).alias("state"))
    return assets.upserted(row(c.where("k % 2 = 0"), "old"), row(c.where("k % 3 = 0"), "new"), ["k"], keep=("first_seen",))


@query("""
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'video' WHEN 1 THEN 'image_album' WHEN 2 THEN 'image_album' WHEN 3 THEN 'video' END AS type, CASE p_partkey % 6 WHEN 2 THEN 'no_images' WHEN 4 THEN 'no_assets' WHEN 5 THEN 'content_type' END AS fault FROM part
""")
def formal_types(spark, sf_dir):
    n = F.col("p_partkey")
    item = lambda role, kind: F.struct(F.lit("f").alias("file_name"), F.lit(role).alias("role"), F.lit(kind).alias("content_type"), F.lit("").alias("sha256"), F.lit(1).cast("bigint").alias("byte_size"), F.lit(1).alias("sequence_index"))
    listed = F.when(n % 6 == 0, F.array(item("BGM", ""), item("ArtifactRole.PRIMARY_VIDEO", ""))).when(n % 6 == 1, F.array(item("", "image"))).when(n % 6 == 2, F.array(item("", "audio"))).when(n % 6 == 3, F.array(item("", "Video"))).when(n % 6 == 5, F.array(item("x", "y")))
    found = table(spark, sf_dir, "part").select(n, F.lit("v").alias("schema_version"), F.lit("p").alias("platform"), n.cast("string").alias("platform_content_id"), F.when(n % 6 == 2, "image_album").otherwise("odd").alias("content_type"), listed.alias("assets"), F.lit(None).cast("string").alias("broken"), F.lit("f").alias("folder"))
    return assets.formal_assets(found).select(n, "type", "fault")
