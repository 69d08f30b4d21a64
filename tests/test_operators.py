"""Semantics that the tables don't show: Han text, decision tables, paths, replays."""

import math
import re

import pytest
from pyspark.sql import functions as F

from sheafwork.functions import scalars
from sheafwork.functions.pytext import canonical_json, similarity, surface
from sheafwork.operators import assets, evaluation, evidence, queue, retrieval, store, sync


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()[0]


def test_query_paths_and_checks():
    assert retrieval.Query("Vulkan").path == "fts_trigram"
    assert retrieval.Query("模型").path == "substring_short"
    assert retrieval.Query(" Vulkan　 模型 ").path == "fts_trigram_with_short_filter"
    assert retrieval.Query("Ｖulkan").terms == ["vulkan"]
    for wrong in ({"text": " "}, {"text": "a", "top_k": 0}, {"text": "a", "top_k": True}, {"text": "a", "filters": {"unit_type": ("guess",)}}):
        with pytest.raises(ValueError):
            retrieval.Query(**wrong)


def test_retrieval_of_han_units(spark):
    rows = [(1, "V", "claim", "Vulkan 后端让 27B 模型跑得很快。", "", "V", "推理", "not_checked", 0.5), (2, "V", "claim", "RDNA 架构优化了 Vulkan 的算子。", "x", "V", "硬件", "verified", 0.5), (3, "A", "opinion", "Thinking", "Vulkan in the evidence", "A", "b", "not_checked", 0.5)]
    units = spark.createDataFrame(rows, "unit_rowid long, canonical_id string, unit_type string, statement string, excerpt string, entity string, topic string, verification_status string, confidence double")
    found = retrieval.retrieve(units, retrieval.Query("Vulkan", 10)).collect()
    assert [r.unit_rowid for r in found][2] == 3 and found[2].evidence_only
    assert [r.unit_rowid for r in retrieval.retrieve(units, retrieval.Query("模型")).collect()] == [1]
    assert [r.unit_rowid for r in retrieval.retrieve(units, retrieval.Query("Vulkan 模型")).collect()] == [1]
    assert [r.unit_rowid for r in retrieval.retrieve(units, retrieval.Query("Vulkan", 10, {"verification_status": ("verified",)})).collect()] == [2]
    assert retrieval.retrieve(units, retrieval.Query("50% [odd]")).count() == 0


def test_bm25_counts_overlaps(spark):
    assert one(spark, retrieval.occurrences("statement", "aaa"), statement="aaaa") == 2


def test_evaluation_of_partial_and_exhaustive(spark):
    golden = spark.createDataFrame([("a", 4, "exhaustive"), ("b", 4, "partial"), ("c", 2, "exhaustive")], "query_id string, top_k int, judgment string")
    relevant = spark.createDataFrame([("a", 1), ("a", 2), ("b", 9), ("c", 5)], "query_id string, unit_rowid long")
    hits = spark.createDataFrame([("a", 1, 7), ("a", 2, 1), ("b", 1, 9)], "query_id string, rank int, unit_rowid long")
    got = {r.query_id: r for r in evaluation.evaluate(golden, relevant, hits).collect()}
    assert (got["a"].mrr, got["a"].precision_at_k, got["a"].recall_at_k) == (0.5, 0.25, 0.5)
    assert got["b"].precision_at_k is None and got["b"].hit_at_k == 1.0
    assert got["c"].hit_at_k == 0.0 and got["c"].f1_at_k == 0.0
    assert evaluation.summarise(evaluation.evaluate(golden, relevant, hits)).first().mean_precision_at_k == 0.125


def test_scalars(spark):
    text = F.col("t")
    assert one(spark, scalars.estimated_tokens(text), t="模型 abcde, x") == 2 + 2 + 1 + 1
    assert one(spark, scalars.normalised_statement(text), t=" a　 b\n") == "a b"
    assert one(spark, scalars.clock(text), t=3661.5) == "01:01:02"
    assert one(spark, scalars.safe_name(text), t="con.txt") == "_con.txt"
    assert one(spark, scalars.safe_name(text), t=" .. ") == "unnamed"
    assert one(spark, scalars.safe_extension(text), t="JP-G") == ".jpg"
    assert one(spark, scalars.safe_extension(text), t=".part") is None
    assert one(spark, scalars.without_secrets(text), t="Cookie sessionid=abc; Bearer x.y-z") == "Cookie sessionid=[REDACTED]; Bearer [REDACTED]"
    assert one(spark, scalars.watermark_reached(F.col("a"), F.col("b")), a="9", b="10") is True
    assert one(spark, scalars.watermark_reached(F.col("a"), F.col("b")), a="x", b="x") is True
    assert one(spark, scalars.backoff(F.lit(7)), t=1) == 60.0
    assert one(spark, scalars.retry_after(text), t="soon") == 60.0
    assert one(spark, scalars.published_at(text), t=1700000000123) == "2023-11-14T22:13:20.123000+00:00"
    assert one(spark, surface(text), t="Straße ＡＢ") == "strasse ab"
    assert one(spark, canonical_json(text), t='{"b": 1e-5, "a": 10000000.0}') == '{"a":10000000.0,"b":1e-05}'
    assert math.isclose(one(spark, similarity(F.col("a"), F.col("b")), a="abcd", b="bcde"), 0.75)


def test_cues_of_the_example(spark):
    rows = [(1, "s1", 10.0, 12.0, "直接看这张图"), (1, "s2", 12.1, 14.0, "这里显示显卡配置"), (1, "s3", 90.0, 91.0, "选择"), (1, "s4", 95.0, 96.0, "打开目录")]
    found = evidence.cue_requests(spark.createDataFrame(rows, "v long, segment_id string, start double, end double, text string"), "v").collect()
    assert (found[0].segments, found[0].start, found[0].end) == ("s1,s2", 7.0, 18.0)
    assert [r.segments for r in found[1:]] == ["s2", "s4"] or [r.segments for r in found[1:]] == ["s4"]


def test_speech_chunks_cover_and_overlap(spark):
    rows = [(1, f"seg_{k:06d}", k * 10.0, k * 10.0 + 10, "word") for k in range(10)]
    found = evidence.speech_chunks(spark.createDataFrame(rows, "v long, segment_id string, start double, end double, text string"), "v", seconds=40, overlap=2).orderBy("chunk").collect()
    assert [(r.first_segment[-1], r.last_segment[-1], r.n_overlap) for r in found] == [("0", "3", 0), ("2", "5", 2), ("4", "7", 2), ("6", "9", 2)]


def test_retry_rules(spark):
    rows = [("NETWORK", None, 1, None), ("NETWORK", None, 3, None), ("NOT_FOUND", "CDN", 1, None), ("RATE_LIMITED", None, 9, "900"), ("AUTH_REQUIRED", None, 1, None), ("TOOL_ERROR", None, 1, None), ("VALIDATION_FAILED", "CONFLICT", 1, None)]
    got = queue.retry_decisions(spark.createDataFrame(rows, "error_code string, subreason string, attempt int, retry_after string")).collect()
    assert [(r.action, r.delay, r.worker) for r in got] == [("RETRY", 2.0, "HEALTHY"), ("TERMINAL", 0.0, "HEALTHY"), ("RETRY_AFTER_RERESOLVE", 2.0, "HEALTHY"), ("WAIT_AND_RETRY", 300.0, "PAUSE_SCOPE"), ("BLOCKED_AUTH", 0.0, "PAUSE_SCOPE"), ("TERMINAL", 0.0, "WORKER_UNHEALTHY"), ("TERMINAL", 0.0, "HEALTHY")]


def test_stop_rules(spark):
    pages = spark.createDataFrame([(1, 1, 10, "0", "90", 1), (1, 2, 10, "90", "80", 1), (1, 3, 5, "80", "70", 0), (2, 1, 0, "0", "0", 0), (3, 1, 4, "0", "9", 1), (3, 2, 4, "9", "9", 1)], "s long, p long, items long, request_cursor string, response_cursor string, has_more int")
    got = {(r.s, r.p): (r.reason, r.watermark) for r in sync.stop_decisions(pages, "s", "p").collect()}
    assert got == {(1, 1): ("has_more", "90"), (1, 2): ("has_more", "90"), (1, 3): ("end_of_collection", "90"), (2, 1): ("empty_collection", None), (3, 1): ("has_more", "9"), (3, 2): ("loop_detected", None)}
    limited = sync.stop_decisions(pages.where("s = 1"), "s", "p", committed="85", max_pages=1).orderBy("p").collect()
    assert [(r.reason, r.watermark) for r in limited] == [("max_pages_reached", None), ("watermark_reached", "90"), ("end_of_collection", "90")]
    history = sync.stop_decisions(pages.where("s = 1"), "s", "p", committed="85", history_complete=False).orderBy("p").collect()
    assert history[1].reason == "has_more"


def test_pairing(spark):
    fields = "id long, name string, duration double, modified double"
    videos = spark.createDataFrame([(1, "a_2.mp4", 60.0, 100.0), (2, "b.mp4", 500.0, 0.0), (3, "c.mp4", 1024.5, 0.0)], fields)
    audios = spark.createDataFrame([(11, "a_3.m4a", 60.08, 105.0), (21, "x.m4a", 900.0, 0.0), (31, "c.m4a", 1023.0, 0.0), (32, "c.m4a", 1026.0, 0.0)], fields)
    got = {r.video_id: (r.decision, r.audio_id) for r in assets.pair_streams(videos, audios).collect()}
    assert got == {1: ("pair_found", 11), 2: ("missing_audio", None), 3: ("pair_ambiguous", None)}


@pytest.mark.parametrize("chunk", [3, 50_000])
def test_pairing_by_brute_force(spark, chunk, monkeypatch):
    """Copies, dense durations, chunks, odd values: the decisions of all pairs, which never become rows."""
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from sheafwork.functions.pytext import ratio

    monkeypatch.setattr(assets, "AUDIOS", chunk)
    monkeypatch.setattr(assets, "VIDEOS", chunk)
    g = random.Random(4)
    made = lambda n, at: [(at + k, g.choice(["red", "reed", "blue", "b.lue", None]), g.choice([g.uniform(60, 63), 61.0, g.uniform(1000, 1030)]), float(g.choice([0, 450, g.randrange(4000)]))) for k in range(n)]
    videos, audios = made(150, 0) + [(900, "x", None, 0.0), (901, "x", math.nan, 0.0), (902, "red", 61.0, None), (903, "red", 5000.0, 0.0)], made(150, 1000)
    audios += [(2000 + k, *audios[k][1:]) for k in range(40)] + [(3000, "red", 61.0, None), (3001, "red", None, 0.0)]
    fields = "id long, name string, duration double, modified double"

    def want(v):
        scores = []
        for a in audios:
            if v[2] is None or a[2] is None or math.isnan(v[2]) or abs(v[2] - a[2]) > (tolerance := max(1.0, v[2] * 0.002)):
                continue
            time = 0.0 if v[3] is None or a[3] is None else max(0.0, 1 - abs(v[3] - a[3]) / 900)
            key = lambda n: (n or "").rsplit(".", 1)[0]
            score = 0.5 * (1 - abs(v[2] - a[2]) / tolerance) + 0.35 * time + 0.15 * ratio(key(v[1]), key(a[1]))
            scores.append((-float(Decimal(repr(score)).quantize(Decimal("0.00001"), ROUND_HALF_UP)), a[0]))
        scores.sort()
        if not scores:
            return "missing_audio", None, None
        return ("pair_ambiguous", None, None) if len(scores) > 1 and scores[1][0] - scores[0][0] <= 0.04 else ("pair_found", scores[0][1], -scores[0][0])

    frame = assets.pair_streams(spark.createDataFrame(videos, fields).repartition(3), spark.createDataFrame(audios, fields).repartition(3))
    got = {r.video_id: (r.decision, r.audio_id, r.score) for r in frame.collect()}
    assert got == {v[0]: want(v) for v in videos} and {d for d, _, _ in got.values()} == {"missing_audio", "pair_ambiguous", "pair_found"}
    plan = frame._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Window" not in plan


def test_pairing_sends_rows_in_proportion(spark, monkeypatch):
    """A crowded bucket: its audios aren't sent once for every few videos, and videos go on only to buckets that can still count."""
    monkeypatch.setattr(assets, "VIDEOS", 5)
    fields = "id long, name string, duration double, modified double"
    made = lambda n, at: spark.createDataFrame([(at + k, "red", 60 + k * 37 % 100 / 100, float(k)) for k in range(n)], fields)
    videos, audios = made(300, 0), made(300, 1000)
    dealt, kind = [], type(videos)
    monkeypatch.setattr(kind, "repartition", lambda self, *a, f=kind.repartition: (dealt.append(self), f(self, *a))[1])
    assert assets.pair_streams(videos, audios).count() == 300
    assert sum(rows.count() for rows in dealt) <= 4 * (300 + 300)


def test_store_is_idempotent(spark):
    fields = "unit_rowid long, canonical_id string, unit_type string, statement string, excerpt string, verification_status string"
    a = spark.createDataFrame([(1, "x", "claim", "s", "e", "n"), (2, "y", "claim", "s", "e", "n")], fields)
    prints = store.asset_fingerprints(a)
    assert {r.status for r in store.ingest_status(prints, prints).collect()} == {"unchanged"}
    assert store.ingest(a, a.where("canonical_id = 'x'")).count() == 2
    assert store.revision(prints.where("false")).first().revision == "4f53cda18c2baa0c0354bb5f9a3ecbe5ed12ab4d8e11ba873c2f11161202b945"
    assert re.fullmatch("[0-9a-f]{64}", store.revision(prints).first().revision)


def test_canonical_items(spark):
    import json

    from sheafwork.operators import collection

    item = {"aweme_id": "7", "desc": "see #a #b", "create_time": 1700000000, "images": [{"uri": "i", "url_list": ["u1"], "width": 0}], "text_extra": [{"hashtag_name": "#x"}, {"hashtag_name": "x"}, {}], "author": {"nickname": "", "sec_uid": "s"}, "video": {"duration": 1234, "bit_rate": [{"play_addr": {"url_list": []}}]}}
    frame = spark.createDataFrame([(json.dumps(item),), ("{broken",), (None,)], "raw string")
    row = collection.canonical_items(collection.parsed(frame), "https://example.org/").collect()
    assert len(row) == 1
    row = row[0]
    assert (row.content_type, row.tags, row.title, row.published_at) == ("image_album", ["x"], "see #a #b", "2023-11-14T22:13:20+00:00")
    assert (row.author.display_name, row.author.profile_url, row.media.duration_seconds, row.media.images[0].url, row.media.images[0].width) == ("Unknown Author", "https://example.org/s", 1.234, "u1", None)
    assert row.media.bitrate_variants == [] and row.chapters is None


def test_recognised_lines(spark):
    from sheafwork.operators import collection

    frame = spark.createDataFrame([(["a ", " ", "b"], [0.9, 0.9, 0.5])], "t array<string>, s array<double>")
    row = frame.select(collection.kept_lines(F.col("t"), F.col("s")).alias("l")).select("l", collection.line_confidence(F.col("l")).alias("c")).first()
    assert [x.text for x in row.l] == ["a"] and row.c == 0.9


def test_job_outcomes_and_recovery(spark):
    rows = [("RETRY", "HEALTHY"), ("WAIT_AND_RETRY", "PAUSE_SCOPE"), ("BLOCKED_AUTH", "PAUSE_SCOPE"), ("TERMINAL", "WORKER_UNHEALTHY"), ("TERMINAL", "HEALTHY")]
    got = [(r.state, r.pauses_scope) for r in queue.outcome(spark.createDataFrame(rows, "action string, worker string")).collect()]
    assert got == [("RETRY_WAIT", False), ("RETRY_WAIT", True), ("BLOCKED_AUTH", False), ("WORKER_UNHEALTHY", False), ("TERMINAL_FAILED", False)]
    jobs = spark.createDataFrame([(1, "RUNNING", "a"), (2, "RUNNING", "b"), (3, "READY", None)], "task_id long, state string, claimed_by string")
    live = spark.createDataFrame([("a",)], "claimed_by string")
    assert {(r.task_id, r.state, r.claimed_by) for r in queue.recovered(jobs, live).collect()} == {(1, "RUNNING", "a"), (2, "READY", None), (3, "READY", None)}
    tasks = spark.createDataFrame([(1, "RUNNING"), (2, "x"), (9, "y")], "task_id long, state string")
    assert {(r.task_id, r.status) for r in queue.accepted_tasks(jobs, tasks, ("state",)).collect()} == {(1, "refreshed"), (2, "conflict"), (9, "accepted")}


def test_expectations_and_coverage(spark):
    from sheafwork.operators import quality

    golden = spark.createDataFrame([("a", [1], [9], False, "p"), ("b", [2], [], False, "p"), ("c", [], [3], False, "q"), ("d", [], [], True, "p")], "query_id string, required array<long>, forbidden array<long>, zero_expected boolean, path string")
    hits = spark.createDataFrame([("a", 1, "p", 1.0), ("c", 3, "p", 0.5)], "query_id string, unit_rowid long, path string, term_coverage double")
    got = {r.query_id: r.reasons for r in quality.expectations(golden, hits).collect()}
    assert got == {"a": [], "b": ["required_missing", "no_hits"], "c": ["forbidden_found", "coverage", "path"], "d": []}
    items, chunks = spark.createDataFrame([("x",), ("y",)], "id string"), spark.createDataFrame([(["x", "z"],)], "ids array<string>")
    assert {(r.id, r.fault) for r in quality.uncovered(items, chunks, "id").collect()} == {("y", "missing"), ("z", "orphan")}
