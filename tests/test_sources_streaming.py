"""Files in, streams folded, replays without effect."""

import json

import pytest

from sheafwork.operators import sync
from sheafwork.sources import documents
from sheafwork.streaming.observations import DivergentReplay, ItemStore


def unit(**changed):
    return {"knowledge_unit_id": "ku_0123456789abcdef", "canonical_id": "v1", "unit_type": "claim", "statement": "S", "evidence_refs": [{"evidence_id": "e1", "source_excerpt": "x"}], "extraction_confidence": 0.5, "verification_status": "not_checked", "entities": [{"entity_name": "E", "category": "model"}], "topics": ["t", "u"], **changed}


def put(root, name, units, **changed):
    folder = root / name / "knowledge"
    folder.mkdir(parents=True)
    (folder / "knowledge_units.json").write_text(json.dumps({"schema_version": "knowledge-units-v1", "canonical_id": "v1", "unit_count": len(units), "units": units, **changed}, indent=1))
    (folder / "merged.json").write_text("{")


def test_units_documents(spark, tmp_path):
    put(tmp_path, "a", [unit()])
    put(tmp_path, "b", [unit(statement=" ")])
    put(tmp_path, "c", [unit()], unit_count=2)
    put(tmp_path, "d", [unit(knowledge_unit_id="ku_1")])
    put(tmp_path, "e", [unit()], schema_version="v0")
    docs = documents.units_documents(spark, str(tmp_path))
    assert {r.file.split("/")[-3]: r.fault for r in documents.document_faults(docs).collect()} == {"b": "statement", "c": "unit_count", "d": "knowledge_unit_id", "e": "schema_version"}
    with pytest.raises(Exception, match="breaks"):
        documents.sound_documents(docs).collect()
    assert documents.sound_documents(docs.where("file like '%/a/knowledge/%'")).count() == 1
    row = documents.unit_rows(docs).first()
    assert (row.excerpt, row.entity, row.topic) == ("x", "E", "t u")
    put(tmp_path, "f", [])
    (tmp_path / "f/knowledge/knowledge_units.json").write_text("{broken")
    with pytest.raises(Exception, match="(?i)malformed"):
        documents.units_documents(spark, str(tmp_path)).collect()


def test_transcripts_and_pages(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"video_id": "v", "language": "zh", "segments": [{"id": "a", "start": 1.23456, "end": 2, "text": " x "}, {"id": "b", "start": 3, "end": 2, "text": "y"}, {"id": "c", "start": 3, "end": 4, "text": " "}]}))
    assert [(r.start, r.text) for r in documents.transcripts(spark, str(tmp_path / "t.json")).collect()] == [(1.235, "x")]
    page = documents.raw_pages(spark, str(tmp_path / "t.json")).first()
    assert page.length == len(page.content) and len(page.sha256) == 64
    fields = "run_id string, page_number int, sha256 string"
    stored, incoming = spark.createDataFrame([("r", 1, "a"), ("r", 2, "b")], fields), spark.createDataFrame([("r", 1, "a"), ("r", 2, "c"), ("r", 3, "d")], fields)
    assert [r.page_number for r in documents.page_conflicts(stored, incoming).collect()] == [2]
    assert [r.page_number for r in documents.new_pages(stored, incoming).collect()] == [3]


def test_stream_equals_batch_and_replays_do_nothing(spark, tmp_path):
    rows = [(k % 3, k * 7 % 11, k) for k in range(200)]
    fields = "scope_id long, content_id long, position long"
    source = tmp_path / "in"
    for n in range(4):
        spark.createDataFrame(rows[n * 50 : n * 50 + 50], fields).coalesce(1).write.mode("append").parquet(str(source))
        store = ItemStore(spark, str(tmp_path / "items"))
        store.follow(spark.readStream.schema(fields).parquet(str(source)), str(tmp_path / "checkpoint")).awaitTermination()
    got = {tuple(r) for r in store.items().collect()}
    want = {tuple(r) for r in sync.current_items(spark.createDataFrame(rows, fields), ["scope_id", "content_id"], "position", 20).collect()}
    assert got == want
    last = spark.createDataFrame(rows[150:], fields)
    store.apply(last.repartition(3), store.committed())
    assert {tuple(r) for r in store.items().collect()} == got
    with pytest.raises(DivergentReplay):
        store.apply(last.limit(5), store.committed())
    assert {tuple(r) for r in store.items().collect()} == got and len(list((tmp_path / "items").glob("batch=*"))) == 2
    spark.createDataFrame([(99, "", "items-v9")], "batch long, digest string, version string").write.json(str(tmp_path / "other/pointer"))
    with pytest.raises(ValueError, match="items-v9"):
        ItemStore(spark, str(tmp_path / "other"))
