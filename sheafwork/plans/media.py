"""Registered queries of visual evidence, older forms of knowledge, routes and checks of assets, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sheafwork.operators import assets, collection, evaluation, evidence, knowledge, legacy, queue, visual
from sheafwork.plans.queries import _WALK, query
from sheafwork.plans.views import SEGMENTS, UNITS, segments, table, units
from sheafwork.sources import documents

# Evidence ----------------------------------------------------------------------------------------------------------


@query(
    _WALK
    + """
c AS (SELECT conv_id, i, total, segment_id, tokens + 12 AS size, CAST(sum(tokens + 12) OVER (PARTITION BY conv_id ORDER BY i) AS BIGINT) AS upto FROM t),
p AS (SELECT a.conv_id, a.i AS first, max(z.i) AS last, a.total FROM c a JOIN c z ON a.conv_id = z.conv_id AND z.i >= a.i AND (z.i = a.i OR z.upto - a.upto + a.size <= 600) GROUP BY a.conv_id, a.i, a.total),
n AS (SELECT p.*, coalesce((SELECT max(b.i) FROM c b, c z WHERE b.conv_id = p.conv_id AND z.conv_id = p.conv_id AND z.i = p.last AND b.i > p.first AND b.i <= p.last AND z.upto - b.upto + b.size >= 80), p.first + 1) AS next FROM p),
w AS (SELECT conv_id, 1 AS chunk, first, last, total, next, 0 AS carried FROM n WHERE first = 1
  UNION ALL SELECT n.conv_id, w.chunk + 1, n.first, n.last, n.total, n.next, greatest(0, w.last - n.first + 1) FROM w JOIN n ON n.conv_id = w.conv_id AND n.first = w.next WHERE w.last < w.total)
SELECT w.conv_id AS asset, CAST(w.chunk AS INTEGER) AS chunk, a.segment_id AS first_segment, z.segment_id AS last_segment, CAST(w.carried AS INTEGER) AS n_overlap, CAST(z.upto - a.upto + a.size AS INTEGER) AS tokens
FROM w JOIN c a ON a.conv_id = w.conv_id AND a.i = w.first JOIN c z ON z.conv_id = w.conv_id AND z.i = w.last
"""
)
def transcript_chunks(spark, sf_dir):
    return evidence.transcript_chunks(segments(spark, sf_dir), "conv_id", tokens=600, overlap=80)


@query(f"""
WITH RECURSIVE {SEGMENTS}, o AS (SELECT conv_id, turn, segment_id, start AS s, "end" AS e, lead(segment_id) OVER w AS n_id, lead(start) OVER w AS n_s, lead("end") OVER w AS n_e FROM segments WINDOW w AS (PARTITION BY conv_id ORDER BY start, segment_id)),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY s, segment_id) AS k, CASE WHEN n_id IS NOT NULL AND n_s - e <= 1 THEN [segment_id, n_id] ELSE [segment_id] END AS ids, round(greatest(0, s - 3), 3) AS b, round(CASE WHEN n_id IS NOT NULL AND n_s - e <= 1 THEN n_e ELSE e END + 4, 3) AS f,
  ['screen_reference', 'configuration', 'path_or_ui'][CAST(turn % 9 // 3 AS INTEGER) + 1] AS kind, 3 - CAST(turn % 9 // 3 AS INTEGER) AS score FROM o WHERE turn % 3 = 0),
g AS (SELECT conv_id, k, 1 AS grp, ids, b, f, kind, score FROM r WHERE k = 1 UNION ALL
  SELECT r.conv_id, r.k, CASE WHEN j THEN grp ELSE grp + 1 END, CASE WHEN j THEN list_concat(g.ids, list_filter(r.ids, lambda x: NOT list_contains(g.ids, x))) ELSE r.ids END, CASE WHEN j THEN g.b ELSE r.b END, CASE WHEN j THEN greatest(g.f, r.f) ELSE r.f END, r.kind, r.score
  FROM g JOIN (SELECT * FROM r) r ON r.conv_id = g.conv_id AND r.k = g.k + 1, LATERAL (SELECT r.score = g.score AND r.b - g.f <= 12 AND greatest(g.f, r.f) - g.b <= 24 AS j) x),
m AS (SELECT conv_id, grp, arg_max(ids, k) AS ids, max(f) AS f, min(b) AS b, any_value(kind) AS kind, any_value(score) AS score FROM g GROUP BY conv_id, grp),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, b) AS place FROM m)
SELECT conv_id AS asset, 'vr_' || lpad(CAST(row_number() OVER (PARTITION BY conv_id ORDER BY b) AS VARCHAR), 3, '0') AS request_id, array_to_string(ids, ',') AS segments, b AS start, f AS "end", kind AS reason FROM t WHERE place <= 12
""")
def cue_requests(spark, sf_dir):
    # The tables hold no Han text, so every third turn gets one of the phrases.
    s = segments(spark, sf_dir)
    phrase = F.get(F.array(F.lit("直接看这张图"), F.lit("这里显示显卡配置"), F.lit("打开这个目录")), (F.col("turn") % 9 / 3).cast("int"))
    return evidence.cue_requests(s.withColumn("text", F.when(F.col("turn") % 3 == 0, F.concat(phrase, "text")).otherwise(F.col("text"))), "conv_id")


_POINTS = f"""{UNITS}, points AS (SELECT unit_rowid AS point_id, [unit_rowid % 97, unit_rowid % 89, unit_rowid * 7 % 101] AS visual_ids FROM units),
ev AS (SELECT doc_id AS evidence_id, CASE WHEN doc_id % 4 = 0 THEN 'failed' ELSE 'completed' END AS status, CASE WHEN doc_id % 3 = 0 THEN 'visual_vlm' ELSE 'visual_ocr' END AS source_type, doc_id % 100 AS start, doc_id % 100 + 5 AS "end" FROM documents)"""


def _points(spark, sf_dir):
    n, d = F.col("unit_rowid"), F.col("doc_id")
    points = units(spark, sf_dir).select(n.alias("point_id"), F.array(n % 97, n % 89, n * 7 % 101).alias("visual_ids"))
    seen = table(spark, sf_dir, "documents").select(d.alias("evidence_id"), F.when(d % 4 == 0, "failed").otherwise("completed").alias("status"), F.when(d % 3 == 0, "visual_vlm").otherwise("visual_ocr").alias("source_type"), (d % 100).alias("start"), (d % 100 + 5).alias("end"))
    return points, seen


@query(f"WITH {_POINTS}, c AS (SELECT point_id, unnest(visual_ids) AS evidence_id, CAST(unnest(range(3)) AS INTEGER) AS at_ FROM points) SELECT point_id, at_ AS \"at\", evidence_id, source_type, start, \"end\" FROM c JOIN ev USING (evidence_id) WHERE status = 'completed'")
def visual_hydration(spark, sf_dir):
    return visual.hydrated(*_points(spark, sf_dir))


@query(f"WITH {_POINTS}, c AS (SELECT DISTINCT point_id, source_type FROM (SELECT point_id, unnest(visual_ids) AS evidence_id FROM points) x JOIN ev USING (evidence_id)) SELECT source_type, count(*) AS evidence, count(*) FILTER (WHERE status = 'completed') AS completed, (SELECT count(*) FROM c WHERE c.source_type = ev.source_type) AS used_by FROM ev GROUP BY source_type")
def visual_usage(spark, sf_dir):
    return visual.usage(*_points(spark, sf_dir))


@query(f"WITH {SEGMENTS}, u AS (SELECT conv_id, unnest(['x', segment_id]) AS s FROM segments WHERE turn % 2 = 0) SELECT conv_id AS point_id, min(start) AS start, max(\"end\") AS \"end\", count(*) AS segments FROM segments WHERE turn % 2 = 0 GROUP BY conv_id")
def audio_envelope(spark, sf_dir):
    s = segments(spark, sf_dir).withColumn("segment_id", F.concat_ws(":", F.col("conv_id").cast("string"), "segment_id"))
    points = s.where("turn % 2 = 0").groupBy(F.col("conv_id").alias("point_id")).agg(F.concat(F.collect_list("segment_id"), F.array(F.lit("x"))).alias("segment_ids"))
    return visual.envelope(points, s)


@query("""
WITH c AS (SELECT DISTINCT l_orderkey // 4 AS chunk_id, l_partkey AS s FROM lineitem WHERE l_linenumber <= 2), r AS (SELECT DISTINCT l_orderkey AS request_id, l_partkey AS s FROM lineitem WHERE l_linenumber = 3), i AS (SELECT l_orderkey AS request_id, l_suppkey AS item_id FROM lineitem WHERE l_linenumber = 4)
SELECT DISTINCT chunk_id, item_id FROM c JOIN r USING (s) JOIN i USING (request_id)
""")
def visual_chunk_items(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    chunks = rows.where("l_linenumber <= 2").groupBy(F.expr("l_orderkey div 4").alias("chunk_id")).agg(F.collect_list("l_partkey").alias("segment_ids"))
    requests = rows.where("l_linenumber = 3").groupBy(F.col("l_orderkey").alias("request_id")).agg(F.collect_list("l_partkey").alias("trigger_ids"))
    return visual.chunk_items(chunks, requests, rows.where("l_linenumber = 4").select(F.col("l_suppkey").alias("item_id"), F.col("l_orderkey").alias("request_id")))


@query("""
WITH c AS (SELECT l_orderkey, count(*) AS images, count(*) FILTER (WHERE l_returnflag = 'A') AS completed, count(*) FILTER (WHERE l_returnflag = 'N') AS insufficient, count(*) FILTER (WHERE l_returnflag = 'R') AS failed FROM lineitem GROUP BY l_orderkey)
SELECT *, CASE WHEN failed = 0 THEN 'completed' WHEN completed = 0 AND insufficient = 0 THEN 'failed' ELSE 'partial' END AS overall FROM c
""")
def album_status(spark, sf_dir):
    state = F.expr("case l_returnflag when 'A' then 'completed' when 'N' then 'insufficient' else 'failed' end")
    return visual.album_status(table(spark, sf_dir, "lineitem").withColumn("state", state), "l_orderkey", "state")


@query("""
WITH f AS (SELECT user_id, event_id AS t, event_id * 2654435761 % 65536 AS h, (event_id % 10) / 20.0 AS delta FROM events), l AS (SELECT *, bit_count(xor(h, lag(h) OVER w)) AS d FROM f WINDOW w AS (PARTITION BY user_id ORDER BY t)),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t) AS n FROM l WHERE d IS NULL OR d > 7 OR delta > 0.18)
SELECT user_id, 'frame_' || lpad(CAST(t * 1000 AS VARCHAR), CAST(greatest(9, length(CAST(t * 1000 AS VARCHAR))) AS INTEGER), '0') AS frame_id, t AS time, CAST(coalesce(d, 999) AS INTEGER) AS distance FROM k WHERE n <= 5
""")
def keyframes(spark, sf_dir):
    n = F.col("event_id")
    frames = table(spark, sf_dir, "events").select("user_id", n.alias("time"), (n * 2654435761 % 65536).alias("dhash"), (n % 10 / 20).alias("scene_delta"))
    return visual.keyframes(frames, "user_id")


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'resolved' WHEN 1 THEN 'unresolved_visual_reference' WHEN 2 THEN 'unresolved_visual_reference' END AS status, CASE WHEN event_id % 4 = 0 THEN event_type END AS answer, CASE WHEN event_id % 4 = 0 THEN 0.5 END AS confidence, CASE event_id % 4 WHEN 1 THEN 'visual information is insufficient' WHEN 2 THEN 'dark' END AS reason FROM events
""")
def vlm_answers(spark, sf_dir):
    n = F.col("event_id")
    raw = F.when(n % 4 == 0, F.concat(F.lit('{"status": "resolved", "answer": " '), "event_type", F.lit(' ", "confidence": 0.5}'))).when(n % 4 == 1, '{"status": "resolved", "answer": " "}').when(n % 4 == 2, '{"status": "x", "reason": "dark"}').otherwise("broken")
    told = table(spark, sf_dir, "events").select(n, visual.answer(raw).alias("a"))
    return told.select(n, "a.status", "a.answer", "a.confidence", "a.reason")


@query("""SELECT event_id, CASE WHEN event_id % 5 < 3 THEN '{"id": ' || event_id || '}' END AS body FROM events""")
def fenced_json(spark, sf_dir):
    n = F.col("event_id")
    plain = F.concat(F.lit('{"id": '), n.cast("string"), F.lit("}"))
    text = F.when(n % 5 == 0, plain).when(n % 5 == 1, F.concat(F.lit(" ```json\n"), plain, F.lit("\n```\n"))).when(n % 5 == 2, F.concat(F.lit("```\n"), plain)).when(n % 5 == 3, "[1]").otherwise("```json\n{broken\n```")
    return table(spark, sf_dir, "events").select(n, visual.json_object(text).alias("body"))


# Older forms -------------------------------------------------------------------------------------------------------


@query(f"""
WITH {UNITS}, p AS (SELECT *, ['author_claim', 'author_opinion', 'verification_question', 'observation', 'guess'][CAST(unit_rowid % 5 AS INTEGER) + 1] AS old, ['claim', 'opinion', 'verification_question', 'observation', 'guess'][CAST(unit_rowid % 5 AS INTEGER) + 1] AS kind, trim(regexp_replace(statement, '\\s+', ' ', 'g')) AS said FROM units),
k AS (SELECT *, 'ku_' || substr(sha256('knowledge-units-v1|' || canonical_id || '|' || kind || '|' || 'e' || unit_rowid || '|' || said), 1, 16) AS id, CASE WHEN kind = 'guess' THEN 'unit_type' WHEN unit_rowid % 11 = 0 THEN 'verification_status' END AS fault FROM p)
SELECT unit_rowid, kind AS unit_type, said AS statement, CASE WHEN fault IS NULL THEN id END AS knowledge_unit_id, CASE WHEN unit_rowid % 2 = 0 THEN 'c' || unit_rowid WHEN fault IS NULL THEN id END AS candidate_id, CASE WHEN kind = 'verification_question' THEN 'system_derived' ELSE 'unverified_speaker' END AS attribution, fault FROM k
""")
def legacy_adapted(spark, sf_dir):
    n = F.col("unit_rowid")
    old = F.get(F.array(*[F.lit(t) for t in ("author_claim", "author_opinion", "verification_question", "observation", "guess")]), (n % 5).cast("int"))
    points = units(spark, sf_dir).select(
        "canonical_id", F.when(n % 2 == 0, F.concat(F.lit("c"), n.cast("string"))).alias("id"), old.alias("type"), F.col("statement").alias("title"), F.when(n % 3 == 0, "").otherwise(F.col("statement")).alias("content"), F.lit(None).cast("double").alias("confidence"),
        F.when(n % 11 == 0, "sure").alias("verification_status"), F.array(F.concat(F.lit("e"), n.cast("string"))).alias("evidence_ids"),
    )
    told = legacy.adapted(points)
    return told.select(F.substring(F.col("evidence_ids")[0], 2, 20).cast("bigint").alias("unit_rowid"), "unit_type", "statement", "knowledge_unit_id", "candidate_id", "attribution", "fault")


_LOCAL = """lines AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS k FROM lineitem),
local AS (SELECT l_orderkey AS asset, 'l' || k AS local_id, k AS position, CASE WHEN k % 2 = 0 THEN 'claim' ELSE 'opinion' END AS type, 's' || k AS seg FROM lines),
sizes AS (SELECT asset, count(*) AS n FROM local GROUP BY asset),
bad AS (SELECT asset, CASE WHEN asset % 10 = 0 THEN 'no_text' WHEN n < 4 THEN 'unknown_source' WHEN asset % 7 = 0 THEN 'other_type' END AS fault FROM sizes)"""


def _legacy(spark, sf_dir):
    k, n = F.col("l_orderkey"), F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    rows = table(spark, sf_dir, "lineitem").select(k, n.alias("n"))
    n = F.col("n")
    local = rows.select(k.alias("asset"), F.concat(F.lit("l"), n.cast("string")).alias("local_id"), n.alias("position"), F.when(n % 2 == 0, "claim").otherwise("opinion").alias("type"), F.lit("t").alias("title"), F.lit("c").alias("content"), F.array(F.concat(F.lit("s"), n.cast("string"))).alias("segment_ids"))
    proposals = rows.select(k.alias("asset")).distinct().select("asset", F.lit(1).alias("position"), F.lit("claim").alias("type"), F.when(F.col("asset") % 10 == 0, " ").otherwise(" both ").alias("title"), F.lit("c").alias("content"), F.array(F.lit("l4"), F.when(F.col("asset") % 7 == 0, "l3").otherwise("l2"), F.lit("l4")).alias("source_ids"))
    return legacy.merged(local, proposals)


@query(f"WITH {_LOCAL} SELECT asset, 1 AS position, fault FROM bad WHERE fault IS NOT NULL")
def legacy_merge_faults(spark, sf_dir):
    return _legacy(spark, sf_dir).faults


@query(f"""WITH {_LOCAL}, good AS (SELECT asset FROM bad WHERE fault IS NULL), p AS (SELECT asset, 0 AS late, 1 AS position, 'both' AS title, 'l4,l2' AS sources, 's2,s4' AS segs, 'claim' AS type FROM good
  UNION ALL SELECT asset, 1, position, 't', local_id, seg, type FROM local JOIN good USING (asset) WHERE local_id NOT IN ('l2', 'l4'))
SELECT asset, 'k_' || lpad(CAST(row_number() OVER (PARTITION BY asset ORDER BY late, position) AS VARCHAR), 3, '0') AS id, type, title, sources, segs, late = 1 AS preserved FROM p""")
def legacy_merge(spark, sf_dir):
    return _legacy(spark, sf_dir).points.select("asset", "id", "type", "title", F.array_join("source_ids", ",").alias("sources"), F.array_join("segment_ids", ",").alias("segs"), "preserved")


_ANSWERS = f"""WITH {SEGMENTS}, f AS (SELECT conv_id AS asset, turn AS position, CASE WHEN conv_id % 7 = 0 AND turn = 1 THEN 'type' WHEN conv_id % 5 = 0 AND turn = 0 THEN 'no_text' WHEN conv_id % 11 = 0 THEN 'no_segments' WHEN conv_id % 3 = 0 AND turn = 1 THEN 'unknown_segment' WHEN conv_id % 13 = 0 AND turn % 2 = 0 THEN 'unfinished_visual' END AS fault FROM segments)"""


def _answers(spark, sf_dir):
    k, t = F.col("conv_id"), F.col("turn")
    s = segments(spark, sf_dir)
    ids = F.when(k % 11 == 0, F.array().cast("array<string>")).otherwise(F.array("segment_id", F.when((k % 3 == 0) & (t == 1), "gone").otherwise(F.col("segment_id"))))
    points = s.select(k.alias("asset"), t.alias("position"), F.when((k % 7 == 0) & (t == 1), "guess").otherwise("author_claim").alias("type"), F.when((k % 5 == 0) & (t == 0), " ").otherwise(" T ").alias("title"), F.lit("c").alias("content"), ids.alias("segment_ids"), F.when(t % 2 == 0, F.array(F.lit("v"), F.lit("v"))).alias("visual_ids"))
    seen = s.select(k.alias("asset")).distinct().select("asset", F.lit("v").alias("evidence_id"), F.when(F.col("asset") % 13 == 0, "failed").otherwise("completed").alias("status"))
    return legacy.checked_answer(points, s.select(k.alias("asset"), "segment_id", "start", "end"), seen)


@query(_ANSWERS + "SELECT asset, position, fault FROM f WHERE fault IS NOT NULL")
def legacy_answer_faults(spark, sf_dir):
    return _answers(spark, sf_dir).faults


@query(_ANSWERS + """ SELECT conv_id AS asset, 'k_' || lpad(CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS VARCHAR), 3, '0') AS id, 'T' AS title, segment_id AS segments, CASE WHEN turn % 2 = 0 THEN 'v' ELSE '' END AS visuals, start, "end" FROM segments WHERE conv_id NOT IN (SELECT asset FROM f WHERE fault IS NOT NULL)""")
def legacy_answers(spark, sf_dir):
    return _answers(spark, sf_dir).points.select("asset", "id", "title", F.array_join("segment_ids", ",").alias("segments"), F.array_join("visual_ids", ",").alias("visuals"), "start", "end")


@query(f"WITH {UNITS} SELECT unit_rowid AS unit_id FROM units WHERE unit_type = 'observation' AND unit_rowid % 2 = 0 AND unit_rowid % 3 = 0")
def ungrounded_observations(spark, sf_dir):
    n = F.col("unit_rowid")
    u = units(spark, sf_dir)
    own = u.select(n.alias("unit_id"), "unit_type", F.array(n * 2, n * 2 + 1, F.lit(-1)).alias("evidence_ids"))
    ev = u.select((n * 2).alias("evidence_id"), F.when(n % 2 == 0, "speech").otherwise("visual_text").alias("modality")).unionByName(u.select((n * 2 + 1).alias("evidence_id"), F.when(n % 3 == 0, "speech").otherwise("perceptual_metric").alias("modality")))
    return legacy.ungrounded(own, ev)


@query("""
SELECT event_id, CASE WHEN event_id % 6 = 5 THEN 'unenriched' ELSE 'enriched' END AS enrichment_status, CASE event_id % 6 WHEN 0 THEN 'T' WHEN 4 THEN 'shown' END AS title, CASE event_id % 6 WHEN 1 THEN 'N' WHEN 2 THEN 'plain' WHEN 3 THEN 'other' END AS author_name, CASE event_id % 6 WHEN 1 THEN 'S' WHEN 3 THEN '7' END AS author_id,
  CASE WHEN event_id % 6 = 1 THEN '2020' END AS first_seen_at, CASE WHEN event_id % 6 = 0 THEN 'u' ELSE 'https://example.org/' || event_id END AS source_url, CASE WHEN event_id % 6 = 2 THEN 'a,b' ELSE '' END AS tags FROM events
""")
def source_snapshots(spark, sf_dir):
    n = F.col("event_id")
    metas = ('{"title": "T", "source_url": "u"}', '{"author": {"username": "N", "sec_uid": "S"}, "collection": {"first_seen_at": "2020"}}', '{"author": "plain", "tags": ["a", "b"]}', '{"author_name": "other", "author_id": "7"}', "{}", "{}")
    meta = F.get(F.array(*[F.lit(m) for m in metas]), (n % 6).cast("int"))
    own = n.cast("string")
    s = legacy.source_snapshot(meta, F.when(n % 6 == 4, "shown").otherwise(own), own, "https://example.org/")
    return table(spark, sf_dir, "events").select(n, s.alias("s")).select(n, "s.enrichment_status", "s.title", "s.author_name", "s.author_id", "s.first_seen_at", "s.source_url", F.array_join("s.tags", ",").alias("tags"))


@query("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'v.mp4:PRIMARY_VIDEO:' WHEN 1 THEN 'b.jpg:ALBUM_IMAGE:1,a.jpg:ALBUM_IMAGE:2' ELSE '' END || CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 3 < 2 THEN ',' ELSE '' END || 's.m4a:AUDIO_TRACK:' ELSE '' END AS artifacts FROM part
""")
def artifact_binding(spark, sf_dir):
    n = F.col("p_partkey")
    file = lambda name: F.struct(F.lit(name).alias("file_name"), F.lit("d").alias("sha256"), F.lit(1).cast("bigint").alias("byte_size"))
    image = lambda name, k: F.struct(F.lit(name).alias("file_name"), F.lit("d").alias("sha256"), F.lit(1).cast("bigint").alias("byte_size"), F.lit(k).alias("sequence_index"))
    kind = F.when(n % 3 == 0, "video").when(n % 3 == 1, "image_album").otherwise("x")
    found = legacy.bound_artifacts(kind, F.when(n % 3 == 0, file("v.mp4")), F.array(image("a.jpg", 2), image("b.jpg", 1)), F.when(n % 2 == 0, file("s.m4a")))
    shown = F.transform(found, lambda a: F.concat(a.file_name, F.lit(":"), a.role, F.lit(":"), F.coalesce(a.sequence_index.cast("string"), F.lit(""))))
    return table(spark, sf_dir, "part").select(n, F.array_join(shown, ",").alias("artifacts"))


@query("SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'Bilibili' WHEN 2 THEN 'YouTube' WHEN 3 THEN 'Douyin' ELSE 'Other' END || ' · ' || CASE WHEN l_returnflag = 'A' THEN '未提供' ELSE l_returnflag END AS label FROM lineitem")
def source_labels(spark, sf_dir):
    platform = F.expr("case l_linenumber when 1 then 'bilibili' when 2 then 'youtube' when 3 then 'douyin' when 4 then 'x' end")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", legacy.source_label(platform, F.when(F.col("l_returnflag") == "A", "").otherwise(F.col("l_returnflag"))).alias("label"))


_SIGNALS = (
    # challenge, login, identity, url, title, scope, hint, http, platform, code, message, shape, readable, empty -> state, health, access, sync, reason
    (True, True, True, "", "", "s", False, 200, 0, "", "", True, True, False, "AUTH_CHALLENGE", "HEALTHY", "UNAVAILABLE", False, "INTERACTIVE_CHALLENGE"),
    (False, False, True, "x/verify", "", "s", True, 200, 0, "", "", True, True, False, "AUTH_CHALLENGE", "HEALTHY", "UNAVAILABLE", False, "INTERACTIVE_CHALLENGE"),
    (False, False, True, "", "", "s", False, 200, 8, "", "", True, True, False, "AUTH_REQUIRED", "HEALTHY", "UNAVAILABLE", False, "LOGIN_REQUIRED"),
    (False, False, True, "", "", "s", False, 200, 2154, "", "", True, True, False, "AUTH_UNCERTAIN", "RATE_LIMITED", "UNAVAILABLE", False, "SOURCE_RATE_LIMITED"),
    (False, False, True, "", "", "s", False, 503, 0, "", "", True, True, False, "AUTH_UNCERTAIN", "SERVER_ERROR", "UNAVAILABLE", False, "SOURCE_SERVER_ERROR"),
    (False, False, True, "", "", "s", False, None, 0, "", "gone", True, True, False, "AUTH_UNCERTAIN", "NETWORK_ERROR", "UNAVAILABLE", False, "SOURCE_NETWORK_ERROR"),
    (False, False, True, "a/passport", "", "s", False, 403, 0, "", "", True, True, False, "AUTH_REQUIRED", "SOURCE_ERROR", "UNAVAILABLE", False, "LOGIN_REQUIRED"),
    (False, False, False, "", "", "s", False, 403, 0, "", "", True, True, False, "AUTH_UNCERTAIN", "SOURCE_ERROR", "UNKNOWN", False, "IDENTITY_MISSING"),
    (False, False, True, "", "", "s", False, 403, 0, "", "", True, True, False, "AUTH_UNCERTAIN", "SOURCE_ERROR", "UNAVAILABLE", False, "SOURCE_HTTP_403_AMBIGUOUS"),
    (False, False, True, "", "", "s", False, 200, 0, "", "", False, True, False, "AUTH_UNCERTAIN", "SOURCE_ERROR", "UNAVAILABLE", False, "SOURCE_RESPONSE_INVALID"),
    (False, False, False, "a/login", "", "s", False, 200, 0, "", "", True, False, False, "AUTH_REQUIRED", "HEALTHY", "UNAVAILABLE", False, "LOGIN_REQUIRED"),
    (False, False, True, "", "", "", False, 200, 0, "", "", True, True, True, "AUTH_VALID", "HEALTHY", "EMPTY", False, "ACCOUNT_SCOPE_UNRESOLVED"),
    (False, False, True, "", "", "s", False, 200, 0, "", "", True, True, True, "AUTH_VALID", "HEALTHY", "EMPTY", True, "COLLECTION_EMPTY"),
    (False, False, True, "", "", "s", False, 200, 0, "", "", True, True, False, "AUTH_VALID", "HEALTHY", "READABLE", True, "AUTH_OK"),
    (False, False, True, "", "", "s", False, 200, 5, "", "", True, True, False, "AUTH_UNCERTAIN", "SOURCE_ERROR", "UNKNOWN", False, "EVIDENCE_CONFLICT"),
)


@query("WITH t(n, auth_state, source_health, access, can_sync, reason) AS (VALUES " + ", ".join(f"({k}, '{r[14]}', '{r[15]}', '{r[16]}', {r[17]}, '{r[18]}')" for k, r in enumerate(_SIGNALS)) + f") SELECT c_custkey, auth_state, source_health, access, can_sync, reason FROM customer JOIN t ON t.n = c_custkey % {len(_SIGNALS)}")
def auth_preflight(spark, sf_dir):
    """The account's preflight by literal cases."""
    names = ("challenge_visible", "login_modal", "identity_present", "url", "title", "scope_id", "challenge_hint", "http_status", "platform_status", "error_code", "error_message", "shape_valid", "items_readable", "collection_empty")
    at = (F.col("c_custkey") % len(_SIGNALS)).cast("int")
    rows = table(spark, sf_dir, "customer").select("c_custkey", *[F.get(F.array(*[F.lit(r[k]) for r in _SIGNALS]), at).alias(name) for k, name in enumerate(names)])
    return legacy.preflight(rows).select("c_custkey", "auth_state", "source_health", "access", "can_sync", "reason")


# Assets ------------------------------------------------------------------------------------------------------------

_NAMES = (("7_img_012.JPG", "album_image", 12), ("7_bgm.mp3", "bgm_audio", None), ("7_cover.webp", "cover_image", None), ("clip.MP4", "primary_video", None), ("pic.png", "album_image", None), ("song.flac", "bgm_audio", None), ("notes.txt", "other_diagnostic", None), ("a.b/none", "other_diagnostic", None))


@query("WITH t(n, name, role, seq) AS (VALUES " + ", ".join(f"({k}, '{a}', '{b}', {'NULL' if c is None else c})" for k, (a, b, c) in enumerate(_NAMES)) + ") SELECT p_partkey, role, CAST(CASE WHEN role = 'album_image' AND p_partkey % 3 = 0 THEN 99 ELSE seq END AS INTEGER) AS sequence FROM part JOIN t ON t.n = p_partkey % 8")
def artifact_roles(spark, sf_dir):
    n = F.col("p_partkey")
    name = F.get(F.array(*[F.lit(a) for a, _, _ in _NAMES]), (n % 8).cast("int"))
    return table(spark, sf_dir, "part").select(n, assets.role_of(name).alias("role"), assets.sequence_of(name, F.when(n % 3 == 0, 99)).alias("sequence"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 8 = 1 THEN 'unfinished' END AS fault FROM part WHERE p_partkey % 8 IN (0, 1, 4, 5)")
def media_files(spark, sf_dir):
    n = F.col("p_partkey")
    names = ("a.mp4", "a.part", "a.txt", "a.json", "b.webp", "b.ts", "c.desc", "d.mp4")
    files = table(spark, sf_dir, "part").select(n, F.get(F.array(*[F.lit(x) for x in names]), (n % 8).cast("int")).alias("file_name"), F.when(n % 8 == 7, "other_diagnostic").otherwise("primary_video").alias("role"))
    return assets.media_files(files).select(n, "fault")


@query("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'video' WHEN 1 THEN 'image_album' END AS mode, CAST(CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN CASE WHEN p_size > 10 THEN p_size ELSE 1 END END AS INTEGER) AS min_primary, CAST(CASE WHEN p_partkey % 3 = 0 THEN 1 END AS INTEGER) AS max_primary,
  CASE p_partkey % 3 WHEN 0 THEN p_partkey % 2 = 0 WHEN 1 THEN false END AS require_audio, CASE p_partkey % 3 WHEN 0 THEN false WHEN 1 THEN true END AS strict_sequence, CASE WHEN p_partkey % 3 = 2 THEN 'unsupported_content_type' END AS fault FROM part
""")
def execution_routes(spark, sf_dir):
    n = F.col("p_partkey")
    tasks = table(spark, sf_dir, "part").select(n, F.when(n % 3 == 0, " Video").when(n % 3 == 1, "image_album").otherwise("live").alias("content_type"), F.when(n % 2 == 0, True).alias("has_audio"), F.when(F.col("p_size") > 10, F.col("p_size")).otherwise(-1).alias("image_count"))
    return assets.routes(tasks).select(n, "mode", "min_primary", "max_primary", "require_audio", "strict_sequence", "fault")


@query("""
WITH p AS (SELECT p_partkey, p_partkey % 4 = 3 AS audio_only, p_partkey % 5 <> 0 AS v, p_partkey % 7 <> 0 AS a, p_partkey % 3 = 0 AS want, CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE 100 END AS w, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size END AS d, p_partkey % 17 <> 0 AS ok FROM part),
c AS (SELECT *, CASE WHEN NOT audio_only AND NOT v THEN 'MISSING_VIDEO_STREAM' WHEN audio_only AND NOT a THEN 'MISSING_AUDIO_STREAM' WHEN NOT audio_only AND want AND NOT a THEN 'MISSING_AUDIO_STREAM' WHEN NOT audio_only AND w <= 0 THEN 'INVALID_DIMENSIONS' WHEN NOT audio_only AND d IS NULL THEN 'INVALID_DURATION' WHEN NOT ok THEN 'DECODE_SMOKE_FAILURE' END AS failed_check FROM p)
SELECT p_partkey, failed_check, CASE WHEN failed_check LIKE 'MISSING%' THEN 'MEDIA_INCOMPLETE' WHEN failed_check IS NOT NULL THEN 'VALIDATION_FAILED' END AS code, failed_check IS NULL AND NOT audio_only AND abs(d - 25) > 5 AS odd_length FROM c
""")
def media_verdicts(spark, sf_dir):
    n = F.col("p_partkey")
    probes = table(spark, sf_dir, "part").select(
        n, F.when(n % 4 == 3, "AUDIO").otherwise("VIDEO").alias("profile"), (n % 5 != 0).alias("has_video"), (n % 7 != 0).alias("has_audio"), (n % 3 == 0).alias("expect_audio"), F.when(n % 11 == 0, 0).otherwise(100).alias("width"), F.lit(50).alias("height"),
        F.when(n % 13 != 0, F.col("p_size").cast("double")).alias("duration"), F.lit(25000).alias("expected_ms"), F.when(n % 17 == 0, False).alias("decodes"),
    )
    return assets.media_verdicts(probes).select(n, "failed_check", "code", "odd_length")


@query("""
WITH c AS (SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber <> 7) AS images, count(*) FILTER (WHERE l_linenumber <> 7 AND l_partkey % 9 = 0) AS bad, count(*) FILTER (WHERE l_linenumber = 7 AND l_partkey % 9 = 0) AS bad_audio FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey AS task_id, images, CASE WHEN images < 3 THEN 'IMAGE_COUNT_BELOW_MINIMUM' WHEN l_orderkey % 4 = 0 AND images <> 5 THEN 'IMAGE_COUNT_MISMATCH' WHEN bad > 0 THEN 'IMAGE_SET_CORRUPT_MEMBER' WHEN bad_audio > 0 THEN 'IMAGE_SET_CORRUPT_AUDIO' END AS failed_check FROM c
""")
def image_set_verdicts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    files = rows.select(F.col("l_orderkey").alias("task_id"), F.when(F.col("l_linenumber") == 7, "x.mp3").otherwise("x.jpg").alias("file_name"), (F.col("l_partkey") % 9 != 0).alias("passed"))
    wanted = rows.select(F.col("l_orderkey").alias("task_id")).distinct().select("task_id", F.lit(3).alias("least"), F.when(F.col("task_id") % 4 == 0, 5).alias("exactly"))
    return assets.image_set_verdicts(files, wanted)


@query("""
WITH c AS (SELECT l_orderkey AS content_id, count(*) AS files, bool_or(l_linenumber = 1) AS has_one, min(CASE WHEN l_orderkey % 11 = 0 THEN 'not_validated' WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN 'zero_bytes' WHEN l_orderkey % 17 = 0 AND l_linenumber = 1 THEN 'changed_since' END) AS reason FROM lineitem GROUP BY l_orderkey)
SELECT content_id, CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN content_id % 2 = 1 THEN 'promoted' WHEN content_id % 3 = 0 AND has_one THEN 'conflict' ELSE 'idempotent' END AS outcome, reason, files FROM c
""")
def promotions(spark, sf_dir):
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    digest = F.sha2(F.concat_ws(":", k.cast("string"), n.cast("string")), 256)
    rows = table(spark, sf_dir, "lineitem")
    new = rows.select(
        k.alias("content_id"), F.concat(n.cast("string"), F.lit(".jpg")).alias("file_name"), digest.alias("sha256"), F.when((k % 13 == 0) & (n == 1), 0).otherwise(9).alias("byte_size"), F.when((k % 17 == 0) & (n == 1), "x").otherwise(digest).alias("validated_sha256"), (k % 11 != 0).alias("validated")
    )
    old = rows.where(k % 2 == 0).select(k.alias("content_id"), F.concat(n.cast("string"), F.lit(".jpg")).alias("file_name"), F.when((k % 3 == 0) & (n == 1), "other").otherwise(digest).alias("sha256"))
    return assets.promotions(new, old)


@query("""
SELECT l_orderkey AS content_id, CASE WHEN l_orderkey % 5 = 0 THEN 'no_assets' WHEN l_orderkey % 7 = 0 THEN 'no_file_name' WHEN l_orderkey % 3 = 0 THEN 'missing_file' ELSE 'other_digest' END AS fault
FROM (SELECT DISTINCT l_orderkey FROM lineitem) x WHERE l_orderkey % 5 = 0 OR l_orderkey % 7 = 0 OR l_orderkey % 3 = 0 OR l_orderkey % 4 = 0
""")
def archive_faults(spark, sf_dir):
    k = F.col("content_id")
    own = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("content_id")).distinct()
    item = lambda name, sha: F.struct(name.alias("file_name"), sha.alias("sha256"))
    first = F.when(k % 7 == 0, F.lit("")).otherwise(F.lit("a"))
    listed = F.when(k % 5 == 0, F.array().cast("array<struct<file_name: string, sha256: string>>")).otherwise(F.array(item(first, F.lit("")), item(F.lit("b"), F.when(k % 4 == 0, "y").otherwise("x"))))
    files = own.where(k % 3 != 0).select(k, F.lit("a").alias("file_name"), F.lit("q").alias("sha256")).unionByName(own.select(k, F.lit("b").alias("file_name"), F.lit("x").alias("sha256")))
    return assets.archive_faults(own.select(k, listed.alias("assets")), files)


_BOXES = """boxes AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'missing' WHEN event_id % 10 = 1 THEN 'corrupt' ELSE 'good' END AS metadata, ['ACTIVE', 'INITIALIZING', 'SUCCESS', 'FAILED', 'ODD'][CAST(event_id % 5 AS INTEGER) + 1] AS state, event_id % 3 = 0 AS alive, event_id * 37 % 100000 AS age FROM events),
k AS (SELECT event_id, age, CASE WHEN metadata <> 'good' THEN 'quarantine' WHEN alive THEN 'active' WHEN state IN ('ACTIVE', 'INITIALIZING') THEN 'orphaned' WHEN state = 'SUCCESS' THEN 'success' WHEN state = 'FAILED' THEN 'failed' ELSE 'unknown_state' END AS kind FROM boxes),
g AS (SELECT event_id, kind, CASE kind WHEN 'orphaned' THEN age >= 600 WHEN 'success' THEN age >= 300 WHEN 'failed' THEN age >= 86400 ELSE false END AS may_go FROM k)"""


def _boxes(spark, sf_dir):
    n = F.col("event_id")
    states = F.array(*[F.lit(s) for s in ("ACTIVE", "INITIALIZING", "SUCCESS", "FAILED", "ODD")])
    return assets.sandboxes(table(spark, sf_dir, "events").select(n, F.when(n % 10 == 0, "missing").when(n % 10 == 1, "corrupt").otherwise("good").alias("metadata"), F.get(states, (n % 5).cast("int")).alias("state"), (n % 3 == 0).alias("alive"), (n * 37 % 100000).cast("double").alias("age")))


@query(f"WITH {_BOXES} SELECT * FROM g")
def sandbox_classes(spark, sf_dir):
    return _boxes(spark, sf_dir).select("event_id", "kind", "may_go")


@query(f"WITH {_BOXES} SELECT count(*) AS scanned, count(*) FILTER (WHERE kind = 'active') AS active, count(*) FILTER (WHERE kind = 'quarantine') AS quarantined, count(*) FILTER (WHERE kind = 'failed' AND NOT may_go) AS kept_failures, count(*) FILTER (WHERE kind = 'orphaned') AS orphaned, count(*) FILTER (WHERE may_go) AS deletable FROM g")
def sandbox_summary(spark, sf_dir):
    return assets.sandbox_summary(_boxes(spark, sf_dir))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'a,c' ELSE 'a' END AS lines, CAST(CASE WHEN p_partkey % 2 = 0 THEN 0.8 ELSE 0.9 END AS DOUBLE) AS confidence, p_partkey % 2 = 0 AND p_partkey % 3 = 0 AS suffices FROM part")
def recognised_lines(spark, sf_dir):
    n = F.col("p_partkey")
    texts, scores = F.array(F.lit(" a "), F.lit(" "), F.lit("b"), F.lit("c")), F.array(F.lit(0.9), F.lit(0.99), F.lit(0.6), F.when(n % 2 == 0, 0.7).otherwise(0.1))
    rows = table(spark, sf_dir, "part").select(n, collection.kept_lines(texts, scores).alias("l"))
    told = rows.select(n, F.array_join(F.transform("l", lambda x: x.text), ",").alias("lines"), collection.line_confidence(F.col("l")).alias("confidence"))
    reasons = F.when(n % 3 == 0, F.array(F.lit("configuration"))).otherwise(F.array(F.lit("screen_reference")))
    return told.withColumn("suffices", collection.text_suffices(F.when(n % 2 == 0, "completed").otherwise("failed"), F.col("confidence"), F.col("lines"), reasons))


# Messages and the codes that they tell, spelt out anew.
_MESSAGES = (
    ("Malformed url", "INVALID_INPUT"), ("ID mismatch", "INVALID_INPUT"), ("live stream", "UNSUPPORTED_CONTENT"), ("slider shown", "AUTH_CHALLENGE"), ("请输入验证码", "AUTH_CHALLENGE"), ("Need Login", "AUTH_REQUIRED"), ("用户未登录", "AUTH_REQUIRED"), ("sidecar disconnect", "CREDENTIAL_BRIDGE_FAILED"),
    ("HTTP 429", "RATE_LIMITED"), ("rate limit, 503", "RATE_LIMITED"), ("taken down", "UNAVAILABLE_DELETED"), ("作品已被封禁", "UNAVAILABLE_DELETED"), ("HTTP 404 at host", "NOT_FOUND"), ("notice_code == 2048", "NOT_FOUND"), ("empty detail", "NOT_FOUND"), ("private_status", "PERMISSION_DENIED"), ("502 bad", "SERVER_ERROR"),
    ("Gateway Timeout", "SERVER_ERROR"), ("Connect Timeout", "TIMEOUT"), ("ECONNRESET", "NETWORK"), ("dns", "NETWORK"), ("hash mismatch", "VALIDATION_FAILED"), ("zero files", "MEDIA_INCOMPLETE"), ("ffmpeg missing", "TOOL_ERROR"), ("F2 import", "TOOL_ERROR"), ("WinError 5", "TOOL_ERROR"), ("odd", "UNKNOWN"),
)


@query("WITH t(n, code) AS (VALUES " + ", ".join(f"({k}, '{c}')" for k, (_, c) in enumerate(_MESSAGES)) + f") SELECT l_orderkey, l_linenumber, code FROM lineitem JOIN t ON t.n = l_partkey % {len(_MESSAGES)}")
def error_codes(spark, sf_dir):
    said = F.get(F.array(*[F.lit(m) for m, _ in _MESSAGES]), (F.col("l_partkey") % len(_MESSAGES)).cast("int"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", queue.code_from_text(said, F.lit("")).alias("code"))


# Knowledge ---------------------------------------------------------------------------------------------------------

_RAW = (
    ('{"unit_type": "claim", "statement": "s", "evidence_ids": ["e"], "extraction_confidence": 0.25}', None, "claim", 0.25, 1),
    ('{"statement": "s", "evidence_ids": []}', None, None, 0.8, 0),
    ('{"statement": "s", "extraction_confidence": "much"}', None, None, None, None),
    ('{"statement": "s", "speaker_name": "x"}', "forbidden_canonical_fields_present", None, 0.8, None),
    ("[1]", "malformed_candidate", None, None, None),
    ("broken", "malformed_candidate", None, None, None),
)


def _sql(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


@query("WITH t(n, fault, unit_type, confidence, cited) AS (VALUES " + ", ".join(f"({k}, {', '.join(_sql(v) for v in r[1:])})" for k, r in enumerate(_RAW)) + f") SELECT event_id, fault, unit_type, CAST(CASE WHEN fault = 'malformed_candidate' THEN NULL ELSE confidence END AS DOUBLE) AS confidence, CAST(cited AS INTEGER) AS cited FROM events JOIN t ON t.n = event_id % {len(_RAW)}")
def raw_candidates(spark, sf_dir):
    text = F.get(F.array(*[F.lit(r[0]) for r in _RAW]), (F.col("event_id") % len(_RAW)).cast("int"))
    told = knowledge.parsed_candidates(table(spark, sf_dir, "events").select(F.col("event_id").alias("candidate_id"), F.lit("c").alias("chunk_id"), text.alias("text")))
    return told.select(F.col("candidate_id").alias("event_id"), "fault", "unit_type", F.when(F.col("fault").isNull() | (F.col("fault") != "malformed_candidate"), F.col("confidence")).alias("confidence"), F.when(F.col("evidence_ids").isNotNull(), F.size("evidence_ids")).alias("cited"))


@query(f"""
WITH {SEGMENTS}, u AS (SELECT conv_id, list(segment_id ORDER BY turn DESC) AS ids FROM segments GROUP BY conv_id HAVING conv_id % 5 <> 0)
SELECT conv_id AS candidate_id, array_to_string(ids, ',') AS ids, len(ids) AS n, (SELECT CAST(sum(length(text)) AS BIGINT) FROM segments s WHERE s.conv_id = u.conv_id) AS chars FROM u
""")
def evidence_hydration(spark, sf_dir):
    """Cited evidence in the candidate's own order; every fifth cites something that there is not."""
    s = segments(spark, sf_dir).withColumn("evidence_id", F.concat_ws(":", F.col("conv_id").cast("string"), "segment_id"))
    cited = s.groupBy("conv_id").agg(F.reverse(F.transform(F.array_sort(F.collect_list(F.struct("turn", "evidence_id"))), lambda x: x.evidence_id)).alias("ids"))
    ids = F.when(F.col("conv_id") % 5 == 0, F.concat("ids", F.array(F.lit("gone")))).otherwise(F.col("ids"))
    own = knowledge.hydrated_refs(cited.select(F.col("conv_id").alias("candidate_id"), ids.alias("evidence_ids")), s.select("evidence_id", F.col("text").alias("excerpt"), "start", "end", F.lit(None).cast("int").alias("sequence_index")))
    shown = F.array_join(F.transform("refs", lambda r: F.split_part(r.evidence_id, F.lit(":"), F.lit(2))), ",")
    return own.select("candidate_id", shown.alias("ids"), F.size("refs").cast("bigint").alias("n"), F.aggregate("refs", F.lit(0).cast("bigint"), lambda a, r: a + F.length(r.source_excerpt)).alias("chars"))


@query(f"""
WITH {UNITS}, w AS (SELECT unit_rowid AS ref, string_split(trim(regexp_replace(statement, '\\s+', ' ', 'g')), ' ')[1] AS word FROM units WHERE regexp_full_match(statement, '[ -~]*') AND statement <> ''),
e AS (SELECT ref, 'entity' AS kind, 0 AS at_, upper(word) AS value, CASE WHEN ref % 3 = 0 THEN 'invalid_entity_category' END AS reason FROM w UNION ALL SELECT ref, 'entity', 1, lower(word), CASE WHEN ref % 3 <> 0 THEN 'duplicate_entity' END FROM w UNION ALL SELECT ref, 'entity', 2, 'zzqqzz', 'entity_not_grounded' FROM w UNION ALL SELECT ref, 'entity', 3, ' ', 'malformed_proposal' FROM w),
t AS (SELECT ref, 'topic' AS kind, unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS at_, unnest(['one', 'x', 'one', 'two words', 'three', 'four', 'five', NULL]) AS value, unnest([NULL, 'invalid_topic', 'duplicate_topic', NULL, NULL, NULL, NULL, 'drop']) AS reason FROM w)
SELECT ref, kind, CAST(at_ AS INTEGER) AS "at", value, reason FROM e UNION ALL SELECT ref, kind, CAST(at_ AS INTEGER), value, reason FROM t WHERE reason IS NULL OR reason <> 'drop'
""")
def enrichment_rejections(spark, sf_dir):
    """Over units in ASCII, whose folded surface SQL has too."""
    u = units(spark, sf_dir).where("statement rlike '^[ -~]*$' and statement <> ''")
    n, word = F.col("unit_rowid"), F.split_part(F.trim(F.regexp_replace("statement", r"\s+", " ")), F.lit(" "), F.lit(1))
    entity = lambda name, kind: F.struct(name.alias("entity_name"), kind.alias("category"))
    good = F.lit("software")
    entities = F.array(entity(F.upper(word), F.when(n % 3 == 0, "thing").otherwise("software")), entity(F.lower(word), good), entity(F.lit("zzqqzz"), good), entity(F.lit(" "), good))
    topics = F.array(*[F.lit(t) for t in ("one", "x", " one ", "two  words", "three", "four", "five", "six")])
    found = knowledge.validate_entities(u.select(n.alias("ref"), "statement", F.array("excerpt").alias("excerpts")), u.select(n.alias("input_ref"), entities.alias("entities"), topics.alias("topics")))
    return found.select("ref", "kind", "at", "value", "reason")


@query(f"WITH {UNITS} SELECT unit_rowid, CASE WHEN unit_rowid % 3 = 0 THEN 'new' ELSE entity END AS entities, CASE WHEN unit_rowid % 3 = 0 THEN 'a,b' ELSE topic END AS topics FROM units")
def enrichment_applied(spark, sf_dir):
    u = units(spark, sf_dir).select("unit_rowid", F.col("unit_rowid").alias("knowledge_unit_id"), F.array("entity").alias("entities"), F.array("topic").alias("topics"))
    results = u.where("unit_rowid % 2 = 0 or unit_rowid % 3 = 0").select("knowledge_unit_id", F.when(F.col("unit_rowid") % 3 == 0, "enriched").otherwise("failed").alias("status"), F.array(F.lit("new")).alias("entities"), F.array(F.lit("a"), F.lit("b")).alias("topics"))
    return knowledge.enriched(u, results).select("unit_rowid", F.array_join("entities", ",").alias("entities"), F.array_join("topics", ",").alias("topics"))


@query(f"WITH {UNITS} SELECT canonical_id, count(*) FILTER (WHERE verification_status = 'not_checked') AS not_checked, 0 AS verified, count(*) FILTER (WHERE verification_status = 'contested') AS contested, 0 AS unsupported FROM units GROUP BY canonical_id")
def status_histogram(spark, sf_dir):
    found = knowledge.status_histogram(units(spark, sf_dir))
    return found.withColumns({c: F.col(c).cast("int") for c in ("verified", "unsupported")})


@query("SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'said' WHEN 2 THEN 'seen' WHEN 3 THEN 'said' WHEN 5 THEN 'seen' END AS excerpt FROM events")
def semantic_excerpts(spark, sf_dir):
    n = (F.col("event_id") % 6).cast("int")
    pick = lambda *values: F.get(F.array(*[F.lit(v) for v in values]), n)
    found = evidence.semantic_excerpt(pick("speech", "visual_text", "visual_description", "visual_description", "visual_description", "other"), pick("said", " ", "said", "said", "said", ""), pick("seen", "seen", "seen", " ", "seen", "seen"), pick(None, None, "completed", None, "unresolved_visual_reference", None))
    return table(spark, sf_dir, "events").select("event_id", found.alias("excerpt"))


@query(f"""
WITH {SEGMENTS}, p AS (SELECT *, CAST(round_even(start, 0) AS BIGINT) AS b, CAST(round_even("end", 0) AS BIGINT) AS e FROM segments)
SELECT conv_id, turn, '[' || lpad('' || b // 3600, 2, '0') || ':' || lpad('' || b // 60 % 60, 2, '0') || ':' || lpad('' || b % 60, 2, '0') || ' - ' || lpad('' || e // 3600, 2, '0') || ':' || lpad('' || e // 60 % 60, 2, '0') || ':' || lpad('' || e % 60, 2, '0') || '] ' || segment_id || ' ' || text AS line FROM p
""")
def transcript_lines(spark, sf_dir):
    return documents.transcript_lines(segments(spark, sf_dir)).select("conv_id", "turn", "line")


@query("SELECT c_custkey, CASE c_custkey % 8 WHEN 1 THEN 'query_text' WHEN 2 THEN 'top_k' WHEN 3 THEN 'path' WHEN 4 THEN 'judgment' WHEN 5 THEN 'zero_result' WHEN 6 THEN 'max_first_rank' END AS fault FROM customer WHERE c_custkey % 8 BETWEEN 1 AND 6")
def golden_suite_faults(spark, sf_dir):
    k = F.col("c_custkey")
    g = table(spark, sf_dir, "customer").select(
        k.cast("string").alias("query_id"), F.when(k % 8 == 1, " ").otherwise("q").alias("query_text"), F.when(k % 8 == 2, 101).otherwise(5).alias("top_k"), F.when(k % 8 == 3, "x").otherwise("fts_trigram").alias("path"), F.when(k % 8 == 4, "x").otherwise("partial").alias("judgment"),
        F.array(F.lit(1)).alias("relevant"), F.array().cast("array<int>").alias("required"), (k % 8 == 5).alias("zero_expected"), F.when(k % 8 == 6, 0).alias("max_first_rank"),
    )
    return evaluation.golden_faults(g).select(F.col("query_id").cast("bigint").alias("c_custkey"), "fault")
