"""The corpus pipeline: stages keep the columns of documents, and their decisions are the operators'."""

import random

import numpy as np
import pytest

import corpus_pipeline
from sheafwork.llm import jaccard, simhash


def test_stages(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.01"
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near duplicates", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs, previous = spark.read.parquet(str(tmp_path / name)), docs
        if name != "packing":
            assert docs.columns == before.columns and docs.join(previous, "doc_id", "left_anti").count() == 0
        if name == "near duplicates":
            assert docs.groupBy("text").count().where("count > 1").count() == 0
            own = simhash.near_duplicates(previous, simhash.WIDE)
            assert docs.count() == own.select("component_id").distinct().count()
    assert docs.select("doc_id").distinct().count() == previous.count()


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, empty texts, a very long text, repeated rows, clashing columns, and an empty table."""
    g = random.Random(2)
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]
    text = lambda n: " ".join(g.choice(words) for _ in range(n))
    rows = [(k, text(40), g.choice(["en", "de"]), g.choice(["a", "b"]), 1, "z", "z") for k in range(120)]
    rows += [(200, None, "en", "a", 1, "z", "z"), (201, "", None, None, None, None, None), (202, " 12 !", "en", "a", 1, "z", "z"), (203, text(30_000), "en", "b", 1, "z", "z"), (None, text(40), "en", "a", 1, "z", "z"), rows[5], rows[5], (300, rows[7][1], "en", "b", 1, "z", "z")]
    fields = "doc_id long, text string, lang string, source string, n_chars long, rank string, own_topic string"
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(0, 40)], "doc_id long, quality int, toxic int")
    for name, made in (("odd", rows), ("empty", [])):
        folder = tmp_path / name
        spark.createDataFrame(made, fields).repartition(3).write.parquet(str(folder / "documents.parquet"))
        (labels if made else labels.where("false")).write.parquet(str(folder / "labels.parquet"))
        docs = spark.read.parquet(str(folder / "documents.parquet"))
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            stage(spark, docs, str(folder)).write.parquet(str(folder / str(number)))
            docs = spark.read.parquet(str(folder / str(number)))
            assert docs.columns == [f.split()[0] for f in fields.split(", ")]
            if number == 0 and made:
                assert sorted(r.doc_id for r in docs.collect() if r.doc_id is not None and r.doc_id >= 200) == [203, 300]
            if number == 2:
                assert docs.groupBy("text").count().where("count > 1").count() == 0
        packed = corpus_pipeline.packed(spark, docs, str(folder))
        assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
        assert corpus_pipeline.run(spark, str(folder)).count() == packed.count()


def test_near_copies_are_caught(spark):
    """Recall against exact shingle similarity of 0.8 or more, over copies of all lengths that differ at any place."""
    g = random.Random(6)
    texts, linked = {}, 0
    for k in range(300):
        words = [f"w{g.randrange(10**6)}" for _ in range(g.choice([12, 30, 60, 150, 400, 900]))]
        copy = list(words)
        for _ in range(g.choice([1, 1, 2, max(1, len(words) // 60)])):
            at = g.randrange(len(copy))
            copy[at : at + 1] = g.choice([[], ["new"], ["new", copy[at]]])
        texts[2 * k], texts[2 * k + 1] = " ".join(words), " ".join(copy)
    want = {}
    for k in range(300):
        a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (texts[2 * k].split(), texts[2 * k + 1].split()))
        want[k] = 5 * len(a & b) >= 4 * len(a | b)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    kept = {r.doc_id for r in corpus_pipeline.unique(spark, frame, "").collect()}
    caught = [2 * k + 1 not in kept for k in range(300) if want[k]]
    assert len(caught) > 100 and sum(caught) / len(caught) >= 0.99
    assert all(2 * k + 1 in kept for k in range(300) if not want[k]) and all(2 * k in kept for k in range(300))


def test_near_copies_come_by_fingerprints(spark, monkeypatch):
    """Without a key of MinHash, the trees over fingerprints alone find the copies within four bits; shingles still decide."""
    monkeypatch.setattr(jaccard, "_ties", lambda classes: classes.select(jaccard.F.col("node").alias("a"), jaccard.F.col("node").alias("b")).where("false"))
    g = random.Random(8)
    texts = {}
    for k in range(60):
        words = [f"w{g.randrange(10**6)}" for _ in range(900)]
        texts[2 * k], texts[2 * k + 1] = " ".join(words), " ".join([*words, "new"])
    prints = {k: int.from_bytes(simhash.fingerprint(t)) for k, t in texts.items()}
    assert all((prints[2 * k] ^ prints[2 * k + 1]).bit_count() <= 4 for k in range(60))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert sorted(r.doc_id for r in corpus_pipeline.unique(spark, frame, "").collect()) == list(range(0, 120, 2))


def test_registered(spark):
    from sheafwork.llm.registry import QUERIES

    assert len([q for q in QUERIES if q.startswith("op")]) == 10 and "pipeline" in QUERIES


def brute_groups(texts: dict) -> dict:
    """The least id of each text's component over links of an exact five-word-shingle similarity of 0.8 or more."""
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for k, t in texts.items() if (w := t.lower().split()) or True}
    least = {k: k for k in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    changed = True
    return least


@pytest.mark.parametrize("chunk", [2, 100])
def test_links_are_those_of_exact_shingle_sets(spark, chunk, monkeypatch):
    """Pairs between 0.7 and 0.85, at 0.8 itself, of ten words (5 of 6 shingles shared is 5/7), and chains."""
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    g = random.Random(5)
    texts, similarities = {}, []
    for length in (9, 10, 22, 49, 94, 400):
        for _ in range(20):
            base = [f"w{g.randrange(10**6)}" for _ in range(length)]
            shingles = length - 4
            similarity = g.choice([0.7, 0.75, 0.78, 0.8, 0.8, 0.82, 0.85])
            cut = round(shingles * (1 - similarity) / (1 + similarity))  # shingles that differ, at the end
            other = base[: length - cut] + [f"v{g.randrange(10**6)}" for _ in range(cut)]
            third = other[min(cut, 3) :]
            similarities.append((shingles - cut) / (shingles + cut))
            for words in (base, other, third):
                texts[len(texts)] = " ".join(words)
    for k in range(12):  # 36 of 45 shingles: 0.8 exactly
        base = [f"x{k}_{i}" for i in range(49)]
        texts[len(texts)], texts[len(texts) + 1] = " ".join(base), " ".join(base[:40])
    assert any(s < 0.8 for s in similarities) and any(0.8 <= s < 0.85 for s in similarities)
    want = brute_groups(texts)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame, simhash.WIDE).collect()}
    assert got == want
    assert sorted(r.doc_id for r in corpus_pipeline.unique(spark, frame, "").collect()) == sorted(set(want.values()))


def test_similar_sets_by_brute_force():
    g = np.random.default_rng(3)
    base = g.integers(0, 1000, (6, 40)).astype(np.uint64)
    sets = [np.unique(np.where(g.random(40) < g.choice([0.02, 0.1, 0.15]), g.integers(0, 1000, 40).astype(np.uint64), base[k % 6])) for k in range(90)] + [np.zeros(0, np.uint64)]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a]) and 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b])):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    assert jaccard.similar(sets, (4, 5)).tolist() == root
