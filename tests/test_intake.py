"""Files, streams, fingerprints and versions: what SQL over the driver's tables can't show."""

import datetime
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sheafwork.functions import fingerprints, scalars
from sheafwork.operators import assets as asset_ops
from sheafwork.operators import legacy, queue, retrieval, runs, stages, store, visual
from sheafwork.sources import assets, config, pages


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")
    return path


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_formal_assets_from_files(spark, tmp_path):
    manifest = lambda items, **more: {"schema_version": "v1", "platform": "p", "platform_content_id": more.pop("cid"), "assets": items, **more}
    put(tmp_path, "p/1/asset_manifest.json", manifest([{"file_name": "v.mp4", "role": "PRIMARY_VIDEO", "sha256": sha("film")}], cid="1"))
    put(tmp_path, "p/1/v.mp4", "film")
    put(tmp_path, "p/2/asset_manifest.json", manifest([{"file_name": "a.jpg", "role": "ALBUM_IMAGE", "sha256": sha("x")}], cid="2"))
    put(tmp_path, "p/2/a.jpg", "other")
    put(tmp_path, "p/3/asset_manifest.json", manifest([{"file_name": "a.jpg", "content_type": "image"}], cid="3"))
    put(tmp_path, "p/4/asset_manifest.json", "{broken")
    put(tmp_path, "p/5/asset_manifest.json", manifest([], cid="5"))
    found = assets.formal_assets(assets.manifests(spark, str(tmp_path)), assets.files_below(spark, str(tmp_path)))
    got = {r.folder.rsplit("/", 1)[1]: (r.type, r.fault) for r in found.collect()}
    assert got == {"1": ("video", None), "2": ("image_album", "other_digest"), "3": ("image_album", "missing_file"), "4": (None, "json"), "5": (None, "no_assets")}
    assert assets.one_asset(found, "p", "1").first().canonical_id == "p_1"
    items = spark.createDataFrame([("p", "1", "{}")], "platform string, platform_content_id string, metadata string")
    assert {r.platform_content_id: r.metadata for r in assets.with_metadata(found.where("fault is null or fault = 'no_assets'"), items).collect()} == {"1": "{}", "5": None}


def test_incoming_files_and_sidecars(spark, tmp_path):
    for name in ("b.mp4", "a.MP4", "c.txt"):
        put(tmp_path / "in", name, "x")
    later = (datetime.datetime.now() + datetime.timedelta(hours=30)).strftime("%Y-%m-%dT%H:%M:%S")
    assert [r.path.rsplit("/", 1)[1] for r in assets.incoming_files(spark, str(tmp_path / "in"), later).collect()] == ["a.MP4", "b.mp4"]
    assert assets.incoming_files(spark, str(tmp_path / "in"), "2001-01-01T00:00:00").count() == 0
    put(tmp_path / "side", "v.mp4.source.json", {"schema_version": "source-v1", "source": {"platform": "myspace", "title": "T"}})
    known = assets.sidecars(spark, str(tmp_path / "side/*.source.json"))
    row = known.first()
    assert row.path.endswith("/v.mp4") and (row.source.platform, row.source.title, row.source.author_id) == ("other", "T", None)
    media = spark.createDataFrame([("x", ["none", row.path]), ("y", ["none"])], "asset string, paths array<string>")
    assert {r.asset: r.source and r.source.title for r in assets.first_source(media, known).collect()} == {"x": "T", "y": None}
    assets.write_sidecars(known.select(F.lit("v").alias("name"), "source"), str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first().value)["source"]["platform"] == "other"
    assets.write_report(spark.range(3), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 3
    assert assets.exists(spark.range(3), id=2) and not assets.exists(spark.range(3), id=9)


def fetch_page(cursor, count, options):
    """A collection of 25 items, newest first; cursors fall."""
    at = int(cursor) or 1000
    items = [{"aweme_id": str(n)} for n in range(at - 1, at - 1 - count, -1) if n >= 975]
    after = at - len(items)
    return {"http_status": 200, "fetched_at": "now", "raw_response": {"status_code": 0, "cursor": after, "has_more": int(after > 975), "aweme_list": items}}


def test_pages_as_a_stream(spark, tmp_path):
    spark.dataSource.register(pages.CollectionPages)
    for until, want in ((None, [("0", "990"), ("990", "980"), ("980", "975")]), ("985", [("0", "990"), ("990", "980")])):
        out = tmp_path / f"out{until}"
        for _ in range(2):  # a second run goes on from the checkpoint and finds nothing new
            reader = spark.readStream.format("collection_pages").option("fetch", "tests.test_intake:fetch_page").option("count", "10")
            stream = (reader.option("until", until) if until else reader).load()
            query = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}-check").trigger(processingTime="0 seconds").start(str(out))
            query.processAllAvailable()
            query.stop()
        found = spark.read.parquet(str(out)).orderBy(F.desc(F.col("response_cursor").cast("int")))
        assert [(r.request_cursor, r.response_cursor) for r in found.collect()] == want
        checked = pages.responses(found.select("http_status", "fetch_error", "raw"))
        assert checked.where("fault is not null").count() == 0 and checked.select(F.sum(F.size("items"))).first()[0] == (25 if until is None else 20)


def test_raw_archive(spark, tmp_path):
    put(tmp_path, "page_1.json", "{}")
    put(tmp_path, "page_2.json", "[1]")
    put(tmp_path, "notes.json", "x")
    found = pages.discovered(spark, str(tmp_path))
    assert {(r.page_number, r.byte_size) for r in found.collect()} == {(1, 2), (2, 3)}
    manifest = spark.createDataFrame([(1, sha("{}"), 2), (2, sha("no"), 3), (3, "", 0), (4, "", 9)], "page_number int, sha256 string, byte_size long")
    assert {r.page_number: r.fault for r in pages.archive_differs(manifest, found).collect()} == {2: "digest", 3: "missing", 4: "missing"}
    assert pages.pages_of_run(None, found).count() == 2 and pages.pages_of_run(manifest, found).count() == 4


def test_configurations(tmp_path):
    good = {"paths": {}, "pipeline": {}, "asr": {}, "llm": {"model": "m"}}
    assert config.load(str(put(tmp_path, "a.json", good))) == good
    with pytest.raises(ValueError, match="asr"):
        config.load(str(put(tmp_path, "b.json", {k: v for k, v in good.items() if k != "asr"})))
    with pytest.raises(ValueError, match=r"paths\[0\]\.cookie, llm\.Access_Token"):
        config.load(str(put(tmp_path, "c.json", {**good, "llm": {"Access_Token": 1}, "paths": [{"cookie": 1}]})))
    assert config.fingerprint({"b": 1, "a": "é"}) == sha('{"a":"é","b":1}')


def test_fingerprints_of_manifests_and_chunks(spark):
    manifest = {"schema_version": "evidence-manifest-v1", "canonical_id": "v", "source_metadata": {"t": "é"}, "formal_asset": {"artifacts": [{"b": 1, "a": 2.5}]}, "evidence_summary": {"verification_status": "not_checked"}, "evidence_items": [{"verification_status": "not_checked", "x": 1e-05}]}
    spelt = "v" + '{"t": "é"}' + '[{"a": 2.5, "b": 1}]' + "{}" + '{"verification_status": "not_checked", "x": 1e-05}'
    good = {**manifest, "manifest_fingerprint": sha(spelt)}
    texts = [good, {**good, "canonical_id": "w"}, {**good, "schema_version": "x"}, {**good, "evidence_items": [{}]}]
    frame = spark.createDataFrame([(json.dumps(t),) for t in texts] + [("{",), (None,)], "t string")
    assert [r.f for r in frame.select(fingerprints.manifest_fault("t").alias("f")).collect()] == [None, "fingerprint", "schema_version", "verification_status", "json", "json"]
    chunk = {"chunk_id": "chk_000001", "sequence_order": 1, "modalities": ["b", "a"], "evidence_ids": ["e1", "e2"], "verification_status": "not_checked"}
    told = '{"canonical_id": "", "chunk_id": "chk_000001", "content_type": "", "evidence_ids": ["e1", "e2"], "image_sequence_range": null, "modalities": ["a", "b"], "overlap_evidence_ids": [], "sequence_order": 1, "source_artifacts": [], "temporal_range": null, "verification_status": "not_checked"}'
    chunk["chunk_fingerprint"] = sha(told)
    document = {"schema_version": "evidence-chunks-v1", "summary": {"verification_status": "not_checked", "total_evidence_referenced": 2, "unique_evidence_referenced": 2}, "chunks": [chunk], "source_manifest_fingerprint": "m", "chunking_policy": {"p": 1}}
    document["chunks_fingerprint"] = sha("m" + '{"p": 1}' + sha(told))
    texts = [document, {**document, "chunks_fingerprint": "x"}, {**document, "chunks": [{**chunk, "sequence_order": 2}]}, {**document, "chunks": [{**chunk, "evidence_ids": ["e1"]}]}, {**document, "chunks": [{**chunk, "modalities": ["z"]}]}]
    frame = spark.createDataFrame([(json.dumps(t),) for t in texts], "t string")
    assert [r.f for r in frame.select(fingerprints.chunks_fault("t").alias("f")).collect()] == [None, "fingerprint", "order", "totals", "chunk_fingerprint"]


def test_json_schema(spark):
    schema = {"type": "object", "required": ["id", "n"], "additionalProperties": False, "properties": {"id": {"type": "string", "pattern": "^[a-z]+$"}, "n": {"type": ["integer", "null"], "minimum": 1}, "k": {"enum": ["x", "y"]}, "l": {"type": "array", "items": {"type": "number"}}}}
    cases = [({"id": "a", "n": 1}, None), ({"id": "a", "n": None, "k": "y", "l": [1, 2.5]}, None), ({"id": "A", "n": 1}, "$.id: pattern"), ({"id": "a"}, "$.n: required"), ({"id": "a", "n": 0}, "$.n: minimum"), ({"id": "a", "n": True}, "$.n: type"), ({"id": "a", "n": 1, "k": "z"}, "$.k: enum"), ({"id": "a", "n": 1, "q": 1}, "$.q: additional"), ({"id": "a", "n": 1, "l": [1, "2"]}, "$.l[1]: type"), ([], "$: type")]
    frame = spark.createDataFrame([(json.dumps(v),) for v, _ in cases], "t string")
    assert [r.f for r in frame.select(fingerprints.schema_faults(schema)("t").alias("f")).collect()] == [want for _, want in cases]


def test_versions_are_checked_before_they_are_seen(spark, tmp_path):
    versions = store.Versions(spark, str(tmp_path / "store"))
    check = lambda tables: tables["t"].where("bad").agg(F.count(F.lit(1)).alias("value")).select(F.lit("projection_violations").alias("counter"), "value").unionByName(tables["t"].agg(F.count(F.lit(1)).alias("value")).select(F.lit("units").alias("counter"), "value"))
    rows = lambda bad, n: {"t": spark.range(n).withColumn("bad", F.lit(bad))}
    assert versions.current() is None
    versions.rebuild("one", rows(False, 3), check)
    with pytest.raises(ValueError, match="projection_violations"):
        versions.rebuild("two", rows(True, 5), check)
    assert versions.current() == "one" and versions.read("t").count() == 3 and not (tmp_path / "store/two").exists()
    versions.rebuild("three", rows(False, 7), check)
    versions.rebuild("four", rows(False, 8), check)
    assert versions.read("t").count() == 8 and (tmp_path / "store/three").exists() and not (tmp_path / "store/one").exists()


def test_store_versions_and_revisions(spark):
    meta = spark.createDataFrame([("schema_version", "knowledge-store-v1"), ("user_version", "2")], "key string, value string")
    assert {r.key: r.value for r in store.meta_faults(meta).collect()} == {"user_version": "2", "fts_policy_version": None}
    prints = spark.createDataFrame([(f"a{k}", sha(str(k))) for k in range(50)], "canonical_id string, fingerprint string")
    one = store.revision_by_parts(prints).first()
    assert one == store.revision_by_parts(prints.repartition(7).orderBy(F.desc("canonical_id"))).first() and one.assets == 50
    assert one.revision != store.revision_by_parts(prints.where("canonical_id <> 'a7'")).first().revision


def test_index_gives_what_a_scan_gives(spark, tmp_path):
    words = ["vulkan", "RDNA 架构", "Thinking 模式", "logitech", "aaaa", "%[odd]", "x"]
    rows = [(n * 1000, f"c{n % 3}", "claim", " ".join(words[(n * k) % 7] for k in range(1, 5)), words[n % 7], f"t{n % 2}", words[n * 3 % 7], "not_checked", 0.5) for n in range(60)]
    fields = "unit_rowid long, canonical_id string, unit_type string, statement string, entity string, topic string, excerpt string, verification_status string, confidence double"
    units = spark.createDataFrame(rows, fields)
    index = retrieval.build_index(units, str(tmp_path / "index"), buckets=4, parts=5)
    for q in (retrieval.Query("vulkan", 20), retrieval.Query("VULKAN logitech", 20), retrieval.Query("aaa", 50), retrieval.Query("架构", 9), retrieval.Query("vulkan 架构", 30), retrieval.Query("%[odd]", 30, {"topic": ("t1",)}), retrieval.Query("absent", 5)):
        assert [tuple(r) for r in retrieval.retrieve(index, q).collect()] == [tuple(r) for r in retrieval.retrieve(units, q).collect()]
    assert retrieval.diagnostics(index, retrieval.Query("aaa", 3))["candidate_count_before_limit"] == sum("aaa" in " ".join(r[3:7]) for r in rows)
    plan = index.holding(["logitech"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "part#" in plan.split("PartitionFilters: [")[1]
    assert retrieval.Backend(index).retrieve(retrieval.Query("vulkan", 2)).count() == 2
    with pytest.raises(ValueError):
        retrieval.best_by_bm25(index, retrieval.Query("ab"))


def test_hydration_of_unknown_assets(spark):
    units = spark.createDataFrame([(1, "x", "claim", "vulkan is fast", "e", "t", "none", "not_checked", 0.5)], "unit_rowid long, canonical_id string, unit_type string, statement string, entity string, topic string, excerpt string, verification_status string, confidence double")
    none = spark.createDataFrame([], "canonical_id string, path string, fingerprint string")
    row = retrieval.hydrated(units, retrieval.Query("vulkan"), none).first()
    assert (row.source_path, row.why_this_hit, row.rank) == (None, "matched query terms in statement", 1)


def test_progress_of_stops(spark):
    fields = "action string, candidate string, history_complete boolean, mode string, request_cursor string, response_cursor string, backfill_cursor string"
    rows = [("stop_terminal", "9", False, "incremental", "0", "1", "5"), ("stop_limit", "9", False, "incremental", "0", "4", None), ("stop_limit", "9", True, "incremental", "0", "4", None), ("stop_terminal", "9", False, "backfill", "7", "1", None), ("continue", "9", False, "incremental", "0", "4", "5")]
    got = [(r.candidate, r.history_complete, r.backfill_cursor) for r in runs.committed_progress(spark.createDataFrame(rows, fields)).collect()]
    assert got == [("9", True, None), (None, False, "4"), (None, True, None), (None, True, None), ("9", False, "5")]


def test_attempts_and_redaction(spark):
    fields = "task_id long, attempt_number int, subreason string"
    log = queue.recorded(spark.createDataFrame([(1, 1, "a")], fields), spark.createDataFrame([(1, 2, "token=abc")], fields))
    assert [r.subreason for r in log.orderBy("attempt_number").collect()] == ["a", "token=[REDACTED]"]
    frame = spark.createDataFrame([("msToken=ab/c=; x Bearer q.w",), (None,)], "t string")
    assert [r[0] for r in frame.select(scalars.redacted(F.col("t"))).collect()] == ["msToken=[REDACTED]; x Bearer [REDACTED]", None]
    assert [r[0] for r in frame.select(runs.sanitised(F.concat(F.lit("Token="), F.col("t")))).collect()] == [runs.SANITISED, ""]


def test_retry_after_in_any_time_zone(spark):
    frame = spark.createDataFrame([("Wed, 21 Oct 2026 07:28:00 GMT",), ("soon",), (None,), ("nan",), ("1e9",)], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            now = F.to_timestamp(F.lit("2026-10-21T07:27:00Z"))
            assert [r[0] for r in frame.select(scalars.retry_after(F.col("t"), now)).collect()] == [60.0, 60.0, 60.0, 60.0, 300.0]
            later = F.to_timestamp(F.lit("2026-10-21T07:27:30Z"))
            assert frame.limit(1).select(scalars.retry_after(F.col("t"), later)).first()[0] == 30.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stages_and_loops(spark):
    states = spark.createDataFrame([("a", "asr", "completed"), ("a", "visual", "failed"), ("b", "asr", "completed"), ("b", "visual", "skipped"), ("c", "asr", "running")], "asset string, stage string, status string")
    assert {r.asset: r.status for r in stages.overall(states).collect()} == {"a": "FAILED", "b": "COMPLETED", "c": "PROCESSING"}
    left = [3, 2, 0, 9]
    assert stages.until_idle(lambda n: left[n]) == 2 and stages.until_idle(lambda n: 1, most=4) == 4


def test_preflight_without_signals(spark):
    fields = "challenge_visible boolean, login_modal boolean, identity_present boolean, url string, title string, scope_id string, challenge_hint boolean, http_status int, platform_status int, error_code string, error_message string, shape_valid boolean, items_readable boolean, collection_empty boolean"
    row = legacy.preflight(spark.createDataFrame([(None,) * 14], fields)).first()
    assert (row.rule, row.auth_state, row.can_sync) == ("nobody", "AUTH_UNCERTAIN", False)


def test_names_and_replies(spark):
    frame = spark.createDataFrame([("x.tar.GZ",), ("dir.a/none",), (".mp4",)], "n string")
    assert [r[0] for r in frame.select(asset_ops.extension_of(F.col("n"))).collect()] == [".gz", "", ""]
    replies = spark.createDataFrame([("```json\n{\"a\": 1}\n```",), ("  {\"a\": 2} ",), ("[1]",), ("```\n{broken\n```",), (None,)], "t string")
    assert [r[0] for r in replies.select(visual.json_object(F.col("t"))).collect()] == ['{"a": 1}', '{"a": 2}', None, None, None]


def test_names_likeness_by_literal_rows(spark):
    """Pairs told apart by their names alone, as Python's own ratio has it."""
    fields = "id long, name string, duration double, modified double"
    videos = spark.createDataFrame([(1, "holiday film.mp4", 60.0, 0.0), (2, "talk.mp4", 600.0, 0.0)], fields)
    audios = spark.createDataFrame([(11, "holiday film_2.m4a", 60.0, 0.0), (12, "zzz.m4a", 60.0, 0.0), (21, "talk.m4a", 600.0, 0.0), (22, "talks.m4a", 600.0, 0.0)], fields)
    got = {r.video_id: (r.decision, r.audio_id, r.score) for r in asset_ops.pair_streams(videos, audios).collect()}
    assert got == {1: ("pair_found", 11, 1.0), 2: ("pair_ambiguous", None, None)}


def test_surface_forms_by_literal_rows(spark):
    from sheafwork.functions.pytext import surface

    frame = spark.createDataFrame([("Straße  ＡＢ",), ("ﬁn　İ",), ("",), (None,)], "t string")
    assert [r[0] for r in frame.select(surface(F.col("t"))).collect()] == ["strasse ab", "fin i̇", "", None]


def test_rounding_as_python_does(spark):
    from sheafwork.functions.pytext import rounded

    frame = spark.createDataFrame([(2.675, 0.0625), (None, 1.0005)], "a double, b double")
    assert [(r[0], r[1]) for r in frame.select(rounded(F.col("a"), 2), rounded(F.col("b"), 3)).collect()] == [(round(2.675, 2), round(0.0625, 3)), (None, round(1.0005, 3))]


def test_albums_raw_references_and_older_forms(spark):
    from sheafwork.operators import collection

    frame = spark.createDataFrame([(["a", "b"], [0.5, 0.25], 3, "7", "", "d" * 40, "2020"), (["a", "b"], [0.9, 0.25], 4, "8", "T", "", "2021"), ([], [], 5, "9", None, None, None)], "t array<string>, s array<double>, n int, id string, title string, text string, seen string")
    assert [r[0] for r in frame.select(collection.album_confidence(F.col("t"), F.col("s"))).collect()] == [0.375, 0.9, 0.0]
    kept = F.when(F.col("n") == 4, F.struct(F.lit("x").alias("platform_raw_type"), F.lit("f").alias("archive_file"), F.lit("d").alias("sha256"), F.lit(1).alias("item_index")))
    assert [(r[0].archive_file, r[0].item_index) for r in frame.select(collection.raw_reference(kept, F.col("n"))).collect()] == [("unarchived/inline.json", 3), ("f", 1), ("unarchived/inline.json", 5)]
    author = F.struct(F.lit("N").alias("display_name"), F.when(F.col("n") == 3, "S").otherwise("").alias("sec_uid"), F.lit("P").alias("platform_author_id"))
    got = [r[0] for r in frame.select(collection.older_projection(F.col("id"), F.col("title"), F.col("text"), F.col("seen"), author)).collect()]
    assert [(r.title, r.author_id, r.original_filename) for r in got] == [("d" * 30, "S", "7.mp4"), ("T", "P", "8.mp4"), (None, "P", "9.mp4")]


def test_orders_of_a_run(spark):
    staging = spark.createDataFrame([("r", "b", 2), ("r", "a", 2), ("r", "c", 1), ("q", "x", 0)], "run_id string, content_id string, staged_at long")
    assert [r.content_id for r in runs.staged_of(staging, "r").collect()] == ["c", "a", "b"]
    items = spark.createDataFrame([("a", 5), ("b", 9), ("c", 9), ("x", 99)], "content_id string, last_seen long")
    assert [r.content_id for r in runs.committed_of(items, staging.unionByName(staging), "r").collect()] == ["b", "c", "a"]


def test_texts_of_evidence_and_audits(spark):
    from sheafwork.operators import evidence
    from sheafwork.sources import documents

    rows = spark.createDataFrame([(1, 0.0, 2.0, "s1"), (1, 7.0, 9.0, "s2"), (1, 30.0, 3661.0, "s3")], "v long, start double, end double, segment_id string")
    assert evidence.spans_text(rows, "v").first().text == "00:00:00–00:00:09 (s1, s2); 00:00:30–01:01:01 (s3)"
    lines = rows.select(evidence.visual_line(F.when(F.col("start") == 0, "visual_ocr").otherwise("x"), F.col("start"), F.col("end"), F.col("segment_id"), F.when(F.col("start") < 10, "t")).alias("l"))
    assert [r.l for r in lines.collect()] == ["- [OCR] 00:00:00–00:00:02 [s1]: t", "- [Visual] 00:00:07–00:00:09 [s2]: t", None]
    units = spark.createDataFrame([("c", "v1", "now", "claim", "verified"), ("c", "v1", "now", "claim", "contested")], "canonical_id string, schema_version string, generated_at string, unit_type string, verification_status string")
    text = documents.audit(units).first().text
    assert text.startswith("# Knowledge Audit\n\n## Asset\n\n- canonical_id: c\n- schema version: v1\n- generated_at: now\n- unit count: 2\n\n## Summary\n\n- claim count: 2\n- opinion count: 0") and text.endswith("- verified: 1\n- contested: 1\n- unsupported: 0")
    album = spark.createDataFrame([("c", 2, "b.jpg", " ", "D"), ("c", 1, "a.jpg", "O", None)], "canonical_id string, sequence_index int, file_name string, ocr_text string, description string")
    assert documents.album_text(album).first().text == "## 1 a.jpg\nOCR: O\n\n## 2 b.jpg\nVLM: D"
    chunks = evidence.numbered_chunks(rows, "v", "start").collect()
    assert [r.chunk_id for r in chunks] == ["chk_000001", "chk_000002", "chk_000003"]
    frame = spark.createDataFrame([("jp-g",), (".png",), ("",), ("a" * 12,)], "e string")
    assert [r[0] for r in frame.select(scalars.extension_changed(F.col("e"))).collect()] == [True, False, False, True]
