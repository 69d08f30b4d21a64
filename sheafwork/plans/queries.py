"""Registered queries over the driver's tables and, where SQL can say the same, their DuckDB SQL.

Every query reads its whole tables. Numbers that a sum's order could change in their last digits are rounded to nine
places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheafwork.functions import scalars
from sheafwork.operators import assets, collection, evaluation, evidence, knowledge, quality, queue, retrieval, store, sync
from sheafwork.plans.views import JOBS, OBSERVATIONS, RICH, SEGMENTS, UNITS, jobs, observations, rich_units, segments, table, unit_index, units

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


# Retrieval ---------------------------------------------------------------------------------------------------------


def _has(field: str, term: str) -> str:
    return f"contains(lower(coalesce({field}, '')), '{term}')"


def _any(term: str) -> str:
    return "(" + " OR ".join(_has(f, term) for f in retrieval.FIELDS) + ")"


def retrieval_sql(q: retrieval.Query, select: str | None = None, cte: str = UNITS, source: str = "units", more: str = "") -> str:
    """The same ranking in SQL. Occurrences are counted by removal, so terms must not overlap themselves."""
    size = " + ".join(f"greatest(0, length(coalesce({f}, '')) - 2)" for f in retrieval.FIELDS)
    own = lambda name, values: f"len(list_intersect({name}, {list(values)})) > 0" if name in ("topics", "entities") else f"{name} IN ({', '.join(repr(v) for v in values)})"
    where = [_any(t) for t in q.terms] + [own(name, values) for name, values in q.filters.items()]
    if q.long:
        stats = ", ".join(f"count(*) FILTER (WHERE {_any(t)}) AS n{k}" for k, t in enumerate(q.long))
        parts = []
        for k, t in enumerate(q.long):
            f = " + ".join(f"{retrieval.WEIGHTS[x]} * ((length(coalesce({x}, '')) - length(replace(lower(coalesce({x}, '')), '{t}', ''))) // {len(t)})" for x in retrieval.FIELDS)
            idf = f"(CASE WHEN ln((s.rows_ - s.n{k} + 0.5) / (s.n{k} + 0.5)) > 0 THEN ln((s.rows_ - s.n{k} + 0.5) / (s.n{k} + 0.5)) ELSE 1e-6 END)"
            parts.append(f"{idf} * CAST({f} AS DOUBLE) * 2.2 / (({f}) + 1.2 * (0.25 + 0.75 * ({size}) / s.mean_))")
        score = f"round(-({' + '.join(parts)}), 9)"
        order = "evidence_only::INT, (NOT exact)::INT, (NOT statement_match)::INT, (NOT entity_match)::INT, (NOT topic_match)::INT, term_coverage DESC, score, unit_rowid"
    else:
        stats = "1 AS one"
        score = "round(CAST(" + " + ".join(f"CASE WHEN {_has(x, t)} THEN {retrieval.WEIGHTS[x]} ELSE 0 END" for t in q.short for x in retrieval.FIELDS) + " AS DOUBLE), 9)"
        order = "score DESC, (NOT exact)::INT, term_coverage DESC, unit_rowid"
    flags = ", ".join(f"({' OR '.join(_has(f, t) for t in q.terms)}) AS {f}_match" for f in retrieval.FIELDS)
    matched = " + ".join(f"{_any(t)}::INT" for t in q.terms)
    why = "concat_ws(' and ', " + ", ".join(f"CASE WHEN {f}_match THEN '{f}' END" for f in retrieval.FIELDS) + ")"
    shown = select or f"unit_rowid, canonical_id, unit_type, score, term_coverage, evidence_only, {why} AS matched_on, '{q.path}' AS path"
    return f"""
WITH {cte},
s AS (SELECT count(*) AS rows_, avg({size}) AS mean_, {stats} FROM {source}),
c AS (SELECT {source}.*, {score} AS score, {flags}, {_has("statement", retrieval.normalise(q.text).lower())} AS exact, CAST({matched} AS DOUBLE) / {len(q.terms)} AS term_coverage
  FROM {source}, s WHERE {" AND ".join(where)}),
e AS (SELECT *, (excerpt_match AND NOT (statement_match OR entity_match OR topic_match)) AS evidence_only FROM c){more}
SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, {shown}
FROM e QUALIFY row_number() OVER (ORDER BY {order}) <= {q.top_k}
"""


RETRIEVALS = {
    "retrieve_fts_topk": retrieval.Query("thwhre tion", 20),
    "retrieve_fts_multi_and": retrieval.Query("nthat ering", 10),
    "retrieve_short_topk": retrieval.Query("de la", 20),
    "retrieve_mixed_topk": retrieval.Query("tion en", 20),
    "retrieve_filtered": retrieval.Query("ering", 15, {"topic": ("en", "de"), "verification_status": ("contested",), "unit_type": ("claim", "observation", "opinion")}),
    "retrieve_no_hits": retrieval.Query("zzzqqq", 5),
}
for _name, _query in RETRIEVALS.items():
    QUERIES[_name] = lambda spark, sf_dir, q=_query: retrieval.retrieve(unit_index(spark, sf_dir), q)
    ORACLE_SQL[_name] = retrieval_sql(_query)

_STATS = retrieval.Query("the ering of")


@query(f"""
WITH {UNITS}
SELECT unit_rowid, {", ".join(f"({' OR '.join(_has(f, t) for t in _STATS.terms)}) AS {f}_match, {_has(f, 'the ering of')} AS exact_{f}_phrase" for f in retrieval.FIELDS)},
  CAST({" + ".join(f"{_any(t)}::INT" for t in _STATS.terms)} AS INTEGER) AS matched_terms
FROM units
""")
def retrieve_field_stats(spark, sf_dir):
    return retrieval.with_match_statistics(units(spark, sf_dir), _STATS).select("unit_rowid", *[c for f in retrieval.FIELDS for c in (f"{f}_match", f"exact_{f}_phrase")], "matched_terms")


@query(f"WITH {RICH} SELECT unit_rowid, statement, entity AS entities, topic AS topics, excerpt AS excerpts FROM rich")
def fts_projection(spark, sf_dir):
    return store.text_projection(rich_units(spark, sf_dir))


_ARRAYS = retrieval.Query("ering", 25, {"topics": ("t2", "de"), "entities": ("e1", "e3", "src4"), "unit_type": ("claim", "observation", "opinion")})


@query(retrieval_sql(_ARRAYS, "unit_rowid, canonical_id, array_to_string(topics, ',') AS topics, array_to_string(entities, ',') AS entities, score", RICH, "rich"))
def retrieve_array_filters(spark, sf_dir):
    """Filters over several topics and entities a unit: any of the values, all of the fields."""
    found = retrieval.candidates(rich_units(spark, sf_dir), _ARRAYS)
    top = retrieval.top_ranked(found, _ARRAYS, retrieval.ranking(_ARRAYS))
    return top.select("rank", "unit_rowid", "canonical_id", F.array_join("topics", ",").alias("topics"), F.array_join("entities", ",").alias("entities"), "score")


_HYDRATED = retrieval.Query("thwhre tion", 12)


def _assets(spark, sf_dir):
    """Assets by source; src7 is unknown."""
    return units(spark, sf_dir).where("canonical_id <> 'src7'").groupBy("canonical_id").agg(F.count(F.lit(1)).alias("unit_count")).select(
        "canonical_id", F.concat(F.lit("assets/"), "canonical_id", F.lit("/units.json")).alias("path"), F.sha2("canonical_id", 256).alias("fingerprint"), "unit_count"
    )


@query(
    retrieval_sql(
        _HYDRATED,
        "unit_rowid, canonical_id, knowledge_unit_id, statement, CAST(len(lines) AS INTEGER) AS evidence, array_to_string(entities, ',') AS entities, CASE WHEN canonical_id <> 'src7' THEN 'assets/' || canonical_id || '/units.json' END AS source_path, "
        "CASE WHEN canonical_id <> 'src7' THEN sha256(canonical_id) END AS source_fingerprint, 'matched query terms in ' || concat_ws(' and ', CASE WHEN statement_match THEN 'statement' END, CASE WHEN entity_match THEN 'entities' END, "
        "CASE WHEN topic_match THEN 'topics' END, CASE WHEN excerpt_match THEN 'evidence' END) AS why_this_hit, (SELECT count(*) FROM e) AS candidate_count",
        RICH,
        "rich",
    )
)
def retrieve_hydrated(spark, sf_dir):
    """Hits with their unit's evidence and entities, their asset, the reason, and the number of candidates before the limit."""
    rich = rich_units(spark, sf_dir)
    found = retrieval.hydrated(rich, _HYDRATED, _assets(spark, sf_dir))
    n = retrieval.diagnostics(rich, _HYDRATED)["candidate_count_before_limit"]
    return found.select(
        "rank", "unit_rowid", "canonical_id", "knowledge_unit_id", "statement", F.size("evidence_refs").alias("evidence"), F.array_join("entities", ",").alias("entities"), "source_path", "source_fingerprint", "why_this_hit", F.lit(n).cast("bigint").alias("candidate_count")
    )


_LOW = retrieval.Query("nthat ering", 15)


@query(f"SELECT CAST(row_number() OVER (ORDER BY score, unit_rowid) AS INTEGER) AS rank, unit_rowid, score FROM ({retrieval_sql(retrieval.Query('nthat ering', 100)).replace('<= 100', '<= 1000000000')}) x QUALIFY row_number() OVER (ORDER BY score, unit_rowid) <= 15")
def fts_bm25_topk(spark, sf_dir):
    return retrieval.best_by_bm25(unit_index(spark, sf_dir), _LOW)


@query(f"""
WITH {UNITS}, g AS (SELECT unit_rowid, unnest(list_transform(range(1, greatest(1, length(statement) - 2) + 1), lambda i: substr(lower(statement), i, 3))) AS trigram FROM units)
SELECT trigram, count(*) AS occurrences, count(DISTINCT unit_rowid) AS rows_with FROM g WHERE length(trigram) = 3 GROUP BY trigram
""")
def fts_postings_statement(spark, sf_dir):
    found = retrieval.postings(units(spark, sf_dir).select("unit_rowid", "statement", *[F.lit("").alias(f) for f in retrieval.FIELDS[1:]]))
    return found.groupBy("trigram").agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("rows_with"))


# Evaluation --------------------------------------------------------------------------------------------------------

_GOLDEN = {"g1": (RETRIEVALS["retrieve_fts_topk"], "exhaustive"), "g2": (RETRIEVALS["retrieve_fts_multi_and"], "exhaustive"), "g3": (RETRIEVALS["retrieve_mixed_topk"], "partial"), "g4": (RETRIEVALS["retrieve_no_hits"], "exhaustive")}


def _golden(spark):
    return spark.createDataFrame([(name, q.top_k, judgment) for name, (q, judgment) in _GOLDEN.items()], "query_id string, top_k int, judgment string")


def _evaluated(spark, sf_dir):
    hits, every = retrieval.retrieve_many(unit_index(spark, sf_dir), {name: q for name, (q, _) in _GOLDEN.items()})
    # The relevant units of a golden query: those that match it and have a confidence of 0.5 or more.
    return evaluation.evaluate(_golden(spark), every.where("confidence >= 0.5"), hits)


def _evaluated_sql() -> str:
    parts = []
    for name, (q, judgment) in _GOLDEN.items():
        where = " AND ".join(_any(t) for t in q.terms)
        parts.append(
            f"SELECT '{name}' AS query_id, {q.top_k} AS top_k, '{judgment}' AS judgment, h.rank, h.good, (SELECT count(*) FROM units WHERE confidence >= 0.5 AND {where}) AS n_relevant FROM (SELECT 1) one LEFT JOIN "
            f"(SELECT r.rank, u.confidence >= 0.5 AS good FROM ({retrieval_sql(q)}) r JOIN units u USING (unit_rowid)) h ON true"
        )
    return f"""
WITH {UNITS}, h AS ({" UNION ALL ".join(parts)}),
a AS (SELECT query_id, any_value(top_k) AS k, any_value(judgment) AS judgment, any_value(n_relevant) AS n_relevant, count(rank) AS returned, count(*) FILTER (WHERE good) AS good, min(rank) FILTER (WHERE good) AS first_relevant_rank FROM h GROUP BY query_id),
m AS (SELECT query_id, returned, good, first_relevant_rank, CASE WHEN good > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hit_at_k, coalesce(1.0::DOUBLE / first_relevant_rank, 0) AS mrr,
  CASE WHEN judgment = 'exhaustive' AND n_relevant > 0 THEN good::DOUBLE / k END AS p, CASE WHEN judgment = 'exhaustive' AND n_relevant > 0 THEN good::DOUBLE / n_relevant END AS r FROM a),
f AS (SELECT query_id, returned, good, first_relevant_rank, hit_at_k, round(mrr, 9) AS mrr, round(p, 9) AS precision_at_k, round(r, 9) AS recall_at_k, round(CASE WHEN p IS NULL THEN NULL WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9) AS f1_at_k FROM m)
"""


@query(_evaluated_sql() + "SELECT * FROM f")
def eval_metrics(spark, sf_dir):
    return _evaluated(spark, sf_dir)


@query(_evaluated_sql() + "SELECT count(*) AS queries, " + ", ".join(f"round(avg({c}), 9) AS mean_{c}" for c in ("hit_at_k", "mrr", "precision_at_k", "recall_at_k", "f1_at_k")) + " FROM f")
def eval_summary(spark, sf_dir):
    return evaluation.summarise(_evaluated(spark, sf_dir))


# Identity, merging, validation -------------------------------------------------------------------------------------

_KU = "'ku_' || substr(sha256('knowledge-units-v1|' || canonical_id || '|' || unit_type || '|' || topic || ',' || entity || '|' || trim(regexp_replace(statement, '\\s+', ' ', 'g'))), 1, 16)"


def _identified(spark, sf_dir):
    return units(spark, sf_dir).withColumn("ku_id", scalars.unit_id(F.col("canonical_id"), F.col("unit_type"), F.array("topic", "entity"), F.col("statement")))


@query(f"WITH {UNITS} SELECT unit_rowid, {_KU} AS ku_id FROM units")
def ku_ids(spark, sf_dir):
    return _identified(spark, sf_dir).select("unit_rowid", "ku_id")


@query("SELECT event_id, 'dl_' || event_type || '_' || event_id || '_' || substr(sha256(event_type || '|' || user_id || '|' || event_id || '|video|v1'), 1, 16) AS task_id FROM events")
def task_ids(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", scalars.task_id(F.col("event_type"), F.col("user_id").cast("string"), F.col("event_id").cast("string"), F.lit("video")).alias("task_id"))


_MERGE = f"""
WITH {UNITS}, k AS (SELECT *, sha256(statement) AS key FROM units),
m AS (SELECT key, min(unit_rowid) AS first_position, {", ".join(f"arg_min({c}, unit_rowid) AS {c}" for c in knowledge.SEMANTIC)}, max(confidence) AS confidence, count(*) AS merged,
  string_agg(canonical_id, ',' ORDER BY unit_rowid) AS assets, concat_ws(',', {", ".join(f"CASE WHEN min({c}) <> max({c}) THEN '{c}' END" for c in knowledge.SEMANTIC)}) AS conflicts,
  list(canonical_id ORDER BY unit_rowid) AS l FROM k GROUP BY key),
d AS (SELECT * EXCLUDE (l, assets), array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS lineage FROM m)
"""


def _merge(spark, sf_dir, which):
    own = units(spark, sf_dir).withColumn("key", F.sha2("statement", 256))
    return which(own, "key", "unit_rowid", "canonical_id").withColumn("lineage", F.array_join("lineage", ",")).withColumn("conflicts", F.array_join("conflicts", ","))


@query(_MERGE + "SELECT * FROM d WHERE conflicts = ''")
def merge_exact_dedup(spark, sf_dir):
    return _merge(spark, sf_dir, knowledge.merged)


@query(_MERGE + "SELECT * FROM d WHERE conflicts <> ''")
def merge_conflicts(spark, sf_dir):
    return _merge(spark, sf_dir, knowledge.conflicts)


@query(f"WITH {UNITS} SELECT canonical_id, " + ", ".join(f"count(*) FILTER (WHERE unit_type = '{t}') AS {t}" for t in knowledge.UNIT_TYPES) + " FROM units GROUP BY canonical_id")
def unit_histogram(spark, sf_dir):
    return knowledge.histogram(units(spark, sf_dir))


@query(f"""
WITH {SEGMENTS}, e AS (SELECT conv_id || ':' || segment_id AS evidence_id, conv_id AS chunk_id, modality, CASE WHEN turn % 7 = 6 THEN '' ELSE text END AS excerpt, turn AS position FROM segments),
{UNITS}, c AS (SELECT unit_rowid AS candidate_id, unit_rowid % 90 AS chunk_id, CASE WHEN unit_rowid % 31 = 0 THEN 'guess' ELSE unit_type END AS unit_type, CASE WHEN unit_rowid % 29 = 0 THEN ' ' ELSE statement END AS statement,
  CASE WHEN unit_rowid % 37 = 0 THEN 1.5 ELSE confidence END AS confidence,
  CASE WHEN unit_rowid % 41 = 0 THEN CAST([] AS VARCHAR[]) ELSE [(unit_rowid % 90) || ':seg_' || lpad(CAST(unit_rowid % 5 + 1 AS VARCHAR), 6, '0'), ((unit_rowid + (unit_rowid % 11 = 0)::INT) % 90) || ':seg_000001'] END AS evidence_ids FROM units),
x AS (SELECT candidate_id, chunk_id, unnest(evidence_ids) AS evidence_id FROM c),
f AS (SELECT x.candidate_id, count(*) FILTER (WHERE e.chunk_id IS NULL) AS unknown, count(*) FILTER (WHERE e.chunk_id <> x.chunk_id) AS outside, count(*) FILTER (WHERE trim(coalesce(e.excerpt, '')) = '') AS unusable,
  count(*) FILTER (WHERE e.modality = 'speech') AS spoken, list(DISTINCT evidence_id) AS ids, string_agg(DISTINCT lpad(CAST(e.position AS VARCHAR), 9, '0') || evidence_id, ',' ORDER BY lpad(CAST(e.position AS VARCHAR), 9, '0') || evidence_id) AS o FROM x LEFT JOIN e USING (evidence_id) GROUP BY x.candidate_id),
r AS (SELECT c.candidate_id, CASE WHEN trim(statement) = '' THEN 'empty_statement' WHEN unit_type NOT IN ('claim', 'opinion', 'observation', 'procedure_step', 'verification_question') THEN 'invalid_unit_type'
  WHEN NOT confidence BETWEEN 0 AND 1 THEN 'invalid_confidence' WHEN len(evidence_ids) < 1 THEN 'empty_evidence_ids' WHEN unknown > 0 THEN 'unknown_evidence_id' WHEN outside > 0 THEN 'evidence_outside_chunk'
  WHEN unusable > 0 THEN 'evidence_has_no_usable_semantic_payload' WHEN unit_type = 'observation' AND spoken > 0 THEN 'observation_without_perceptual_evidence' END AS reason, o, unit_type, spoken, len(evidence_ids) AS n
  FROM c LEFT JOIN f USING (candidate_id))
SELECT candidate_id, reason, CASE WHEN reason IS NULL THEN regexp_replace(o, '(^|,)[0-9]{{9}}', '\\1', 'g') END AS evidence,
  CASE WHEN reason IS NULL THEN CASE WHEN unit_type = 'verification_question' THEN 'system_derived' WHEN spoken < n THEN 'visual_media' ELSE 'unverified_speaker' END END AS attribution FROM r
""")
def candidate_validation(spark, sf_dir):
    s = segments(spark, sf_dir)
    ev = s.select(F.concat_ws(":", F.col("conv_id").cast("string"), "segment_id").alias("evidence_id"), F.col("conv_id").alias("chunk_id"), "modality", F.when(F.col("turn") % 7 == 6, "").otherwise(F.col("text")).alias("excerpt"), F.col("turn").alias("position"))
    n = F.col("unit_rowid")
    home = (n % 90).cast("string")
    other = ((n + F.when(n % 11 == 0, 1).otherwise(0)) % 90).cast("string")
    ids = F.array(F.concat(home, F.format_string(":seg_%06d", n % 5 + 1)), F.concat(other, F.lit(":seg_000001")))
    c = units(spark, sf_dir).select(
        n.alias("candidate_id"), (n % 90).alias("chunk_id"), F.when(n % 31 == 0, "guess").otherwise(F.col("unit_type")).alias("unit_type"), F.when(n % 29 == 0, " ").otherwise(F.col("statement")).alias("statement"),
        F.when(n % 37 == 0, 1.5).otherwise(F.col("confidence")).alias("confidence"), F.when(n % 41 == 0, F.array().cast("array<string>")).otherwise(ids).alias("evidence_ids"),
    )
    return knowledge.validate_candidates(c, ev)


@query(f"""
WITH {UNITS}, p AS (SELECT unit_rowid AS input_ref, CASE WHEN unit_rowid % 4 = 0 THEN split_part(statement, ' ', 2) ELSE 'Nowhere' END AS entity_name, [topic, topic, 'x', 'source  ' || canonical_id, 'two' || chr(10) || 'lines'] AS topics FROM units WHERE unit_rowid % 3 <> 2),
d AS (SELECT * FROM p UNION ALL SELECT * FROM p WHERE input_ref % 10 = 0),
n AS (SELECT input_ref, count(*) AS n, min(entity_name) AS entity_name, min(topics) AS topics FROM d GROUP BY input_ref),
j AS (SELECT u.unit_rowid AS ref, n.n, CASE WHEN n.n = 1 AND entity_name <> '' AND (contains(lower(trim(regexp_replace(statement, '\\s+', ' ', 'g'))), lower(entity_name)) OR contains(lower(trim(regexp_replace(excerpt, '\\s+', ' ', 'g'))), lower(entity_name))) THEN entity_name END AS entity_ok,
  CASE WHEN n.n = 1 THEN topic || ',source ' || canonical_id END AS topics_ok FROM units u LEFT JOIN n ON u.unit_rowid = n.input_ref)
SELECT ref, CASE WHEN n IS NULL THEN 'unchanged' WHEN n > 1 THEN 'failed' ELSE 'enriched' END AS status, entity_ok, topics_ok FROM j
""")
def enrichment_validation(spark, sf_dir):
    u = units(spark, sf_dir)
    n = F.col("unit_rowid")
    topics = F.array("topic", "topic", F.lit("x"), F.concat(F.lit("source  "), "canonical_id"), F.lit("two\nlines"))
    p = u.where(n % 3 != 2).select(n.alias("input_ref"), F.when(n % 4 == 0, F.split_part("statement", F.lit(" "), F.lit(2))).otherwise("Nowhere").alias("entity_name"), topics.alias("topics"))
    return knowledge.validate_enrichment(u.select(n.alias("ref"), "statement", "excerpt"), p.unionByName(p.where(F.col("input_ref") % 10 == 0)))


@query(f"""
WITH {UNITS}, b AS (SELECT * FROM units WHERE unit_rowid % 13 <> 0), a AS (SELECT unit_rowid, CASE WHEN unit_rowid % 17 = 0 THEN 'verified' ELSE verification_status END AS verification_status, CASE WHEN unit_rowid % 19 = 0 THEN NULL ELSE topic END AS topic, entity FROM units WHERE unit_rowid % 11 <> 0),
j AS (SELECT coalesce(b.unit_rowid, a.unit_rowid) AS unit_rowid, b.unit_rowid IS NULL AS added, a.unit_rowid IS NULL AS removed, concat_ws(',', CASE WHEN a.verification_status IS DISTINCT FROM b.verification_status THEN 'verification_status' END, CASE WHEN a.topic IS DISTINCT FROM b.topic THEN 'topic' END, CASE WHEN a.entity IS DISTINCT FROM b.entity THEN 'entity' END) AS fields
  FROM b FULL JOIN a ON a.unit_rowid = b.unit_rowid)
SELECT unit_rowid, CASE WHEN removed THEN 'removed' WHEN added THEN 'added' ELSE 'changed' END AS kind, CASE WHEN NOT removed AND NOT added THEN fields END AS fields FROM j WHERE removed OR added OR fields <> ''
""")
def identity_audit(spark, sf_dir):
    u = units(spark, sf_dir)
    n = F.col("unit_rowid")
    after = u.where(n % 11 != 0).select(n, F.when(n % 17 == 0, "verified").otherwise(F.col("verification_status")).alias("verification_status"), F.when(n % 19 != 0, F.col("topic")).alias("topic"), "entity")
    return knowledge.identity_audit(u.where(n % 13 != 0), after, "unit_rowid", ("verification_status", "topic", "entity"))


@query(f"""
WITH {UNITS}, x AS (SELECT lower(split_part(statement, ' ', 1)) AS first_word, list(canonical_id ORDER BY unit_rowid) AS l FROM units GROUP BY 1)
SELECT first_word, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS lineage FROM x
""")
def lineage_ordered_union(spark, sf_dir):
    words = units(spark, sf_dir).select(F.lower(F.split_part("statement", F.lit(" "), F.lit(1))).alias("first_word"), "unit_rowid", "canonical_id")
    return knowledge.ordered_union(words, "first_word", "unit_rowid", "canonical_id").withColumn("lineage", F.array_join("lineage", ","))


# Store -------------------------------------------------------------------------------------------------------------

_PRINTS = (
    "SELECT canonical_id, CAST(sum(n) AS BIGINT) AS unit_count, sha256(string_agg(d, '' ORDER BY span)) AS fingerprint FROM (SELECT canonical_id, unit_rowid // 4096 AS span, count(*) AS n, "
    "sha256(string_agg(sha256(unit_type || '|' || statement || '|' || excerpt || '|' || verification_status), '' ORDER BY unit_rowid)) AS d FROM {} GROUP BY canonical_id, unit_rowid // 4096) spans GROUP BY canonical_id"
)


@query(f"WITH {UNITS} " + _PRINTS.format("units"))
def asset_fingerprints(spark, sf_dir):
    return store.asset_fingerprints(units(spark, sf_dir))


@query(f"""
WITH {UNITS}, s AS ({_PRINTS.format("(SELECT * FROM units WHERE canonical_id <> 'src3') o")}), i AS ({_PRINTS.format("(SELECT * FROM units WHERE canonical_id <> 'src5' AND unit_rowid <> 7) n")})
SELECT coalesce(s.canonical_id, i.canonical_id) AS canonical_id, CASE WHEN s.fingerprint IS NULL THEN 'inserted' WHEN i.fingerprint IS NULL THEN 'kept' WHEN s.fingerprint = i.fingerprint THEN 'unchanged' ELSE 'replaced' END AS status
FROM s FULL JOIN i ON s.canonical_id = i.canonical_id
""")
def ingest_status_diff(spark, sf_dir):
    u = units(spark, sf_dir)
    return store.ingest_status(store.asset_fingerprints(u.where("canonical_id <> 'src3'")), store.asset_fingerprints(u.where("canonical_id <> 'src5' and unit_rowid <> 7")))


@query(f"WITH {UNITS} SELECT canonical_id, count(*) AS n, min(unit_rowid) AS low FROM units WHERE canonical_id <> 'src4' GROUP BY canonical_id")
def store_ingest_remove(spark, sf_dir):
    u = units(spark, sf_dir)
    kept = store.remove(store.ingest(u.where("canonical_id <> 'src3'"), u.where("canonical_id in ('src3', 'src6')")), u.where("canonical_id = 'src4'"))
    return kept.groupBy("canonical_id").agg(F.count(F.lit(1)).alias("n"), F.min("unit_rowid").alias("low"))


@query(f"""WITH {UNITS}, p AS ({_PRINTS.format("units")}) SELECT sha256('[' || string_agg('["' || canonical_id || '","' || fingerprint || '"]', ',' ORDER BY canonical_id) || ']') AS revision, count(*) AS assets FROM p""")
def store_revision(spark, sf_dir):
    return store.revision(store.asset_fingerprints(units(spark, sf_dir)))


@query(f"WITH {UNITS} SELECT unit_rowid, CAST(unnest(range(len(string_split(statement, ' ')))) AS INTEGER) AS ordinal, unnest(string_split(statement, ' ')) AS value FROM units")
def store_children(spark, sf_dir):
    return store.children(units(spark, sf_dir).withColumn("words", F.split("statement", " ")), "unit_rowid", "words")


@query(f"""WITH {UNITS}, a AS (SELECT canonical_id, count(*) + CASE WHEN canonical_id LIKE '%7' THEN 1 ELSE 0 END AS unit_count FROM units GROUP BY canonical_id), r AS (SELECT canonical_id, count(*) AS actual FROM units GROUP BY canonical_id)
SELECT canonical_id, unit_count, coalesce(actual, 0) AS actual FROM a LEFT JOIN r USING (canonical_id) WHERE unit_count <> coalesce(actual, 0)""")
def store_count_faults(spark, sf_dir):
    u = units(spark, sf_dir)
    declared = u.groupBy("canonical_id").agg((F.count(F.lit(1)) + F.when(F.col("canonical_id").endswith("7"), 1).otherwise(0)).alias("unit_count"))
    return store.count_faults(declared, u)


@query(f"WITH {UNITS} SELECT DISTINCT unit_rowid FROM units WHERE unit_rowid % 23 = 0 AND len(string_split(statement, ' ')) > 1")
def store_ordinal_faults(spark, sf_dir):
    child = store.children(units(spark, sf_dir).withColumn("words", F.split("statement", " ")), "unit_rowid", "words")
    return store.ordinal_faults(child.where(~((F.col("unit_rowid") % 23 == 0) & (F.col("ordinal") == 0))), "unit_rowid")


@query(f"WITH {UNITS} SELECT unit_rowid, canonical_id FROM units WHERE canonical_id IN ('src2', 'src9')")
def orphan_units(spark, sf_dir):
    u = units(spark, sf_dir)
    return store.orphans(u, u.where("canonical_id not in ('src2', 'src9')"), "canonical_id").select("unit_rowid", "canonical_id")


# Evidence ----------------------------------------------------------------------------------------------------------

_TOKENS = """greatest(1, len(regexp_extract_all(text, '[\\x{3400}-\\x{9fff}\\x{f900}-\\x{faff}]'))
  + coalesce(list_sum(list_transform(regexp_extract_all(text, '[A-Za-z0-9_./:+#-]+'), lambda r: (length(r) + 3) // 4)), 0)
  + len(regexp_extract_all(text, '[^\\s\\p{Z}\\p{L}\\p{M}\\p{N}_\\x{3400}-\\x{9fff}\\x{f900}-\\x{faff}]')))"""


@query(f"SELECT doc_id, CAST({_TOKENS} AS INTEGER) AS tokens FROM documents")
def token_estimate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", scalars.estimated_tokens(F.col("text")).cast("int").alias("tokens"))


@query(f'WITH {SEGMENTS} SELECT conv_id, turn, segment_id, round(start, 9) AS start, round("end", 9) AS "end", modality FROM segments')
def segment_ids(spark, sf_dir):
    return segments(spark, sf_dir).select("conv_id", "turn", "segment_id", F.round("start", 9).alias("start"), F.round("end", 9).alias("end"), "modality")


@query(f"WITH {SEGMENTS} SELECT modality, count(*) AS n, count(DISTINCT conv_id) AS assets, count(*) FILTER (WHERE length(text) > 200) AS long_items FROM segments GROUP BY modality")
def modality_counts(spark, sf_dir):
    return segments(spark, sf_dir).groupBy("modality").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("conv_id").alias("assets"), F.count_if(F.length("text") > 200).alias("long_items"))


@query("""
WITH e AS (SELECT user_id, event_id, epoch(date_trunc('second', ts)) AS s, epoch(date_trunc('second', ts)) + CAST(floor(value) AS BIGINT) * 60 AS e FROM events),
w AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
r AS (SELECT *, sum(CASE WHEN reach IS NULL OR s - reach > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e, event_id ROWS UNBOUNDED PRECEDING) AS run FROM w)
SELECT user_id, CAST(run AS BIGINT) AS run, CAST(min(s) AS BIGINT) AS start, CAST(max(e) AS BIGINT) AS "end", count(*) AS members FROM r GROUP BY user_id, run
""")
def gap_merge_sessions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    s = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', date_trunc('second', ts))").cast("bigint")
    e = e.withColumn("s", s).withColumn("e", F.col("s") + F.floor("value").cast("bigint") * 60)
    return evidence.gap_merge(e, "user_id", "s", "e", 3600, ["event_id"]).select("user_id", F.col("run").cast("bigint").alias("run"), "start", "end", "members")


@query(f"""
WITH {SEGMENTS}, d AS (SELECT conv_id, turn, dense_rank() OVER (PARTITION BY conv_id ORDER BY turn // 2) AS n FROM segments) SELECT conv_id, turn, CAST((n - 1) // 5 AS INTEGER) AS batch FROM d
""")
def album_batches(spark, sf_dir):
    s = segments(spark, sf_dir).withColumn("image", F.floor(F.col("turn") / 2))
    return evidence.image_batches(s, "conv_id", "image").select("conv_id", "turn", "batch")


@query(f"WITH {UNITS}, n AS (SELECT unit_rowid, row_number() OVER (PARTITION BY canonical_id ORDER BY unit_rowid) AS n FROM units) SELECT unit_rowid, 'u' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS input_ref, CAST((n - 1) // 10 AS INTEGER) AS batch FROM n")
def enrich_batches(spark, sf_dir):
    return knowledge.batches(units(spark, sf_dir), "canonical_id", "unit_rowid", 10).select("unit_rowid", "input_ref", "batch")


_WALK = f"""
WITH RECURSIVE {SEGMENTS}, t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY start, segment_id) AS i, count(*) OVER (PARTITION BY conv_id) AS total, segment_id, start AS b, "end" AS e, CAST({_TOKENS} AS INTEGER) AS tokens FROM segments),
"""


@query(
    _WALK
    + """
p AS (SELECT a.conv_id, a.i AS first, max(z.i) AS last, a.total FROM t a JOIN t z ON a.conv_id = z.conv_id AND z.i >= a.i
  AND (z.i = a.i OR (z.e - a.b <= 60 AND z.i - a.i < 4 AND (SELECT sum(m.tokens) FROM t m WHERE m.conv_id = a.conv_id AND m.i BETWEEN a.i AND z.i) <= 400)) GROUP BY a.conv_id, a.i, a.total),
w AS (SELECT conv_id, 1 AS chunk, first, last, total, 0 AS carried FROM p WHERE first = 1
  UNION ALL SELECT p.conv_id, w.chunk + 1, p.first, p.last, p.total, least(1, w.last - w.first) FROM w JOIN p ON p.conv_id = w.conv_id AND p.first = greatest(w.last + 1 - least(1, w.last - w.first), w.first + 1) WHERE w.last < w.total)
SELECT w.conv_id AS asset, CAST(w.chunk AS INTEGER) AS chunk, a.segment_id AS first_segment, z.segment_id AS last_segment, CAST(w.last - w.first + 1 AS INTEGER) AS n_segments, CAST(w.carried AS INTEGER) AS n_overlap,
  CAST((SELECT sum(m.tokens) FROM t m WHERE m.conv_id = w.conv_id AND m.i BETWEEN w.first AND w.last) AS INTEGER) AS tokens
FROM w JOIN t a ON a.conv_id = w.conv_id AND a.i = w.first JOIN t z ON z.conv_id = w.conv_id AND z.i = w.last
"""
)
def speech_chunks(spark, sf_dir):
    return evidence.speech_chunks(segments(spark, sf_dir), "conv_id", seconds=60, tokens=400, most=4, overlap=1)


@query(f"""
WITH {SEGMENTS} SELECT conv_id, turn, lead(turn) OVER w AS next_turn, coalesce(lead(start) OVER w - "end" <= 1.0, false) AS adjacent FROM segments WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
""")
def adjacent_segments(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return segments(spark, sf_dir).select("conv_id", "turn", F.lead("turn").over(w).alias("next_turn"), F.coalesce(F.lead("start").over(w) - F.col("end") <= 1.0, F.lit(False)).alias("adjacent"))


# Sync, outbox, queue -----------------------------------------------------------------------------------------------


@query(f"""
WITH {OBSERVATIONS}, b AS (SELECT *, lag(rank) OVER (PARTITION BY scope_id, content_id ORDER BY rank) AS before FROM observations)
SELECT scope_id, content_id, min(rank) AS first_seen, max(rank) AS last_seen, count(*) AS observed_count, count(*) FILTER (WHERE rank - before > 20) AS reappearances, max(rank) FILTER (WHERE rank - before > 20) AS reappeared_at FROM b GROUP BY scope_id, content_id
""")
def sync_items_upsert(spark, sf_dir):
    return sync.current_items(observations(spark, sf_dir), ["scope_id", "content_id"], "rank", 20)


@query(f"WITH {OBSERVATIONS} SELECT scope_id, content_id, event_id, page_number FROM observations QUALIFY row_number() OVER (PARTITION BY scope_id, content_id ORDER BY rank) = 1")
def sync_observation_dedup(spark, sf_dir):
    return sync.first_sightings(observations(spark, sf_dir), ["scope_id", "content_id"], ["rank"]).select("scope_id", "content_id", "event_id", "page_number")


@query("SELECT user_id, event_type, count(*) AS rows, count(DISTINCT props) AS payloads FROM events GROUP BY user_id, event_type HAVING count(DISTINCT props) > 1")
def sync_conflicts(spark, sf_dir):
    return sync.conflicts(table(spark, sf_dir, "events"), ["user_id", "event_type"], "props")


_PAGES = f"""
WITH {OBSERVATIONS}, f AS (SELECT *, row_number() OVER (PARTITION BY scope_id, content_id ORDER BY rank) = 1 AS fresh FROM observations),
g AS (SELECT scope_id, page_number, count(*) AS items, count(*) FILTER (WHERE fresh) AS new_items, max(cursor) AS response_cursor FROM f GROUP BY scope_id, page_number),
pages AS (SELECT *, coalesce(lag(response_cursor) OVER w, '0') AS request_cursor, CASE WHEN lead(page_number) OVER w IS NULL THEN 0 ELSE 1 END AS has_more FROM g WINDOW w AS (PARTITION BY scope_id ORDER BY page_number))
"""


@query(_PAGES + "SELECT scope_id, count(*) AS pages, CAST(sum(items) AS BIGINT) AS seen, CAST(sum(new_items) AS BIGINT) AS new_items, CAST(sum(items - new_items) AS BIGINT) AS known_items FROM pages GROUP BY scope_id")
def sync_run_metrics(spark, sf_dir):
    pages = sync.page_facts(observations(spark, sf_dir), "scope_id", "content_id", "page_number", "cursor")
    return pages.groupBy("scope_id").agg(F.count(F.lit(1)).alias("pages"), F.sum("items").alias("seen"), F.sum("new_items").alias("new_items"), F.sum(F.col("items") - F.col("new_items")).alias("known_items"))


@query(
    _PAGES
    + """, r AS (SELECT *, max(CASE WHEN page_number = 1 AND items > 0 AND request_cursor = '0' AND response_cursor NOT IN ('', '0') THEN response_cursor END) OVER w AS candidate, CAST(sum(items) OVER w AS BIGINT) AS accumulated FROM pages WINDOW w AS (PARTITION BY scope_id ORDER BY page_number ROWS UNBOUNDED PRECEDING)),
d AS (SELECT *, CASE WHEN page_number > 1 AND response_cursor = request_cursor AND response_cursor <> '0' AND has_more = 1 THEN 'loop_detected' WHEN page_number = 1 AND items = 0 THEN 'empty_collection'
  WHEN has_more = 0 OR response_cursor = '0' OR items = 0 THEN 'end_of_collection' WHEN CAST(response_cursor AS HUGEINT) <= 20240103000000000000 THEN 'watermark_reached' WHEN page_number >= 5 THEN 'max_pages_reached' ELSE 'has_more' END AS reason FROM r)
SELECT scope_id, page_number, items, accumulated, reason, CASE reason WHEN 'loop_detected' THEN 'stop_error' WHEN 'empty_collection' THEN 'stop_terminal' WHEN 'end_of_collection' THEN 'stop_terminal' WHEN 'watermark_reached' THEN 'stop_safe_boundary' WHEN 'max_pages_reached' THEN 'stop_limit' ELSE 'continue' END AS action,
  CASE WHEN reason IN ('end_of_collection', 'watermark_reached', 'has_more') THEN candidate END AS watermark FROM d
"""
)
def sync_stop_decision(spark, sf_dir):
    pages = sync.page_facts(observations(spark, sf_dir), "scope_id", "content_id", "page_number", "cursor")
    return sync.stop_decisions(pages, "scope_id", "page_number", committed="20240103000000000000", max_pages=5)


@query(f"""
WITH {OBSERVATIONS}, i AS (SELECT scope_id, content_id, content_id % 5 <> 0 AS active, content_id % 3 = 0 AS has_asset, count(*) > 3 AS reappeared, count(*) > 1 AS known FROM observations GROUP BY scope_id, content_id),
r AS (SELECT *, CASE WHEN NOT active OR has_asset THEN NULL WHEN reappeared THEN 'REAPPEARANCE_ASSET_MISSING' WHEN known THEN 'ASSET_MISSING_REPAIR' ELSE 'NEW_COLLECTION_ITEM' END AS reason FROM i)
SELECT scope_id, content_id, reason IS NOT NULL AS eligible, reason, CASE WHEN reason IS NULL THEN 0 WHEN reason = 'NEW_COLLECTION_ITEM' THEN 10 ELSE 5 END AS priority FROM r
""")
def outbox_eligibility(spark, sf_dir):
    c = F.col("content_id")
    i = observations(spark, sf_dir).groupBy("scope_id", "content_id").agg(F.count(F.lit(1)).alias("n")).select("scope_id", c, (c % 5 != 0).alias("active"), (c % 3 == 0).alias("has_asset"), (F.col("n") > 3).alias("reappeared"), (F.col("n") > 1).alias("known"))
    return sync.eligibility(i).select("scope_id", "content_id", "eligible", "reason", "priority")


@query(f"WITH {JOBS} SELECT task_id, scope_id FROM jobs WHERE state = 'READY' AND next_attempt_at <= TIMESTAMP '1996-01-01' AND scope_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def outbox_pending(spark, sf_dir):
    own = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("scope_id"))
    return jobs(spark, sf_dir).where("state = 'READY' and next_attempt_at <= timestamp_ntz'1996-01-01 00:00:00'").join(own, "scope_id", "left_semi").select("task_id", "scope_id")


@query("SELECT l_orderkey, l_linenumber, CAST(l_linenumber + 1 AS INTEGER) AS attempts, CASE WHEN l_linenumber + 1 >= 5 THEN 'FAILED' ELSE 'PENDING' END AS status, CASE WHEN l_linenumber + 1 < 5 THEN round(30 * power(2.0::DOUBLE, l_linenumber), 3) END AS delay FROM lineitem")
def outbox_backoff(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("attempts"))
    return sync.after_failure(rows, 5, 30.0).withColumn("attempts", F.col("attempts").cast("int"))


_CLAIMABLE = f"""WITH {JOBS}, pauses AS (SELECT c_custkey AS scope_id, CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2030-01-01' ELSE TIMESTAMP '1990-01-01' END AS pause_until FROM customer WHERE c_custkey % 3 = 0),
c AS (SELECT jobs.* FROM jobs LEFT JOIN pauses USING (scope_id) WHERE (state = 'READY' OR (state = 'RETRY_WAIT' AND next_attempt_at <= TIMESTAMP '1997-06-01')) AND (pause_until IS NULL OR pause_until <= TIMESTAMP '1997-06-01'))
"""


def _claimable(spark, sf_dir):
    pauses = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("scope_id"), F.expr("if(c_acctbal < 0, timestamp_ntz'2030-01-01 00:00:00', timestamp_ntz'1990-01-01 00:00:00')").alias("pause_until"))
    return queue.claimable(jobs(spark, sf_dir), pauses, F.expr("timestamp_ntz'1997-06-01 00:00:00'"))


@query(_CLAIMABLE + "SELECT CAST(row_number() OVER (ORDER BY priority DESC, next_attempt_at, task_id) AS INTEGER) AS place, task_id, priority FROM c QUALIFY place <= 50")
def job_claim_order(spark, sf_dir):
    w = Window.orderBy(F.desc("priority"), "next_attempt_at", "task_id")  # over the 50 claimed rows
    return queue.claim_order(_claimable(spark, sf_dir), 50).select(F.row_number().over(w).alias("place"), "task_id", F.col("priority").cast("int").alias("priority"))


@query(_CLAIMABLE + "SELECT state, count(*) AS n, count(DISTINCT scope_id) AS scopes FROM c GROUP BY state")
def job_claimable_counts(spark, sf_dir):
    return _claimable(spark, sf_dir).groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("scope_id").alias("scopes"))


@query(f"WITH {JOBS} SELECT state, count(*) AS n FROM jobs GROUP BY state")
def job_state_counts(spark, sf_dir):
    return jobs(spark, sf_dir).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


_CODES = ("NETWORK", "NOT_FOUND", "AUTH_REQUIRED", "RATE_LIMITED", "MEDIA_INCOMPLETE", "VALIDATION_FAILED", "TOOL_ERROR", "ODD")


@query(f"""
WITH a AS (SELECT l_orderkey, l_linenumber, {list(_CODES)}[CAST(l_partkey % 8 AS INTEGER) + 1] AS code, CASE WHEN l_suppkey % 3 = 0 THEN 'CDN_EXPIRED' WHEN l_suppkey % 3 = 1 THEN 'NAME_CONFLICT' ELSE NULL END AS sub, l_linenumber AS n, CASE WHEN l_returnflag = 'A' THEN '500' WHEN l_returnflag = 'N' THEN 'soon' ELSE '7.5' END AS after FROM lineitem),
b AS (SELECT *, code = 'NOT_FOUND' AND coalesce(sub, '') = 'CDN_EXPIRED' AS volatile, coalesce(sub, '') = 'NAME_CONFLICT' AND code IN ('VALIDATION_FAILED', 'TOOL_ERROR', 'ODD') AS conflict FROM a),
c AS (SELECT *, CASE WHEN volatile THEN CASE WHEN n < 2 THEN 'RETRY_AFTER_RERESOLVE' ELSE 'TERMINAL' END WHEN code = 'AUTH_REQUIRED' THEN 'BLOCKED_AUTH' WHEN code = 'RATE_LIMITED' THEN 'WAIT_AND_RETRY' WHEN conflict THEN 'TERMINAL'
  WHEN code = 'NETWORK' AND n < 3 THEN 'RETRY' WHEN code IN ('MEDIA_INCOMPLETE', 'VALIDATION_FAILED') AND n < 2 THEN 'RETRY_AFTER_RERESOLVE' WHEN code = 'ODD' AND n < 2 THEN 'RETRY' ELSE 'TERMINAL' END AS action FROM b)
SELECT l_orderkey, l_linenumber, action, CAST(CASE WHEN volatile THEN 2 WHEN code IN ('AUTH_REQUIRED', 'RATE_LIMITED') THEN NULL WHEN conflict THEN 1 ELSE CASE code WHEN 'NETWORK' THEN 3 WHEN 'MEDIA_INCOMPLETE' THEN 2 WHEN 'VALIDATION_FAILED' THEN 2 WHEN 'ODD' THEN 2 ELSE 1 END END AS INTEGER) AS budget,
  CAST(CASE WHEN action = 'WAIT_AND_RETRY' THEN least(300, greatest(1, coalesce(TRY_CAST(after AS DOUBLE), 60))) WHEN action LIKE 'RETRY%' THEN least(60, 2 * power(2.0::DOUBLE, n - 1)) ELSE 0 END AS DOUBLE) AS delay,
  CASE WHEN code IN ('AUTH_REQUIRED', 'RATE_LIMITED') THEN 'PAUSE_SCOPE' WHEN code = 'TOOL_ERROR' AND NOT conflict THEN 'WORKER_UNHEALTHY' ELSE 'HEALTHY' END AS worker FROM c
""")
def retry_decision(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.get(F.array(*[F.lit(c) for c in _CODES]), (F.col("l_partkey") % 8).cast("int")).alias("error_code"), F.expr("case l_suppkey % 3 when 0 then 'CDN_EXPIRED' when 1 then 'NAME_CONFLICT' end").alias("subreason"),
        F.col("l_linenumber").alias("attempt"), F.expr("case l_returnflag when 'A' then '500' when 'N' then 'soon' else '7.5' end").alias("retry_after"),
    )
    return queue.retry_decisions(rows).select("l_orderkey", "l_linenumber", "action", "budget", "delay", "worker")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1)")
def committed_items_semi(spark, sf_dir):
    seen = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(seen, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey")


# Assets and scalars ------------------------------------------------------------------------------------------------

_STREAMS = {"video": "SELECT p_partkey AS id, p_name AS name, p_retailprice / 10 AS duration, CAST(p_partkey * 7 % 5000 AS DOUBLE) AS modified FROM part WHERE p_partkey % 2 = 0", "audio": "SELECT p_partkey AS id, p_name AS name, p_retailprice / 10 AS duration, CAST(p_partkey * 7 % 5000 AS DOUBLE) AS modified FROM part WHERE p_partkey % 2 = 1"}


def _streams(spark, sf_dir, odd):
    p = table(spark, sf_dir, "part").where(F.col("p_partkey") % 2 == odd)
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), (F.col("p_retailprice") / 10).alias("duration"), (F.col("p_partkey") * 7 % 5000).cast("double").alias("modified"))


@query(f"""
WITH v AS ({_STREAMS["video"]}), a AS ({_STREAMS["audio"]}),
m AS (SELECT v.id AS video_id, a.id AS audio_id, round(0.50::DOUBLE * (1 - abs(v.duration - a.duration) / greatest(1.0, v.duration * 0.002)) + 0.35::DOUBLE * greatest(0, 1 - abs(v.modified - a.modified) / 900) + 0.15::DOUBLE * 1, 5) AS score
  FROM v JOIN a ON abs(v.duration - a.duration) <= greatest(1.0, v.duration * 0.002)),
r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY score DESC, audio_id) AS n FROM m),
b AS (SELECT video_id, max(audio_id) FILTER (WHERE n = 1) AS audio_id, max(score) FILTER (WHERE n = 1) AS score, max(score) FILTER (WHERE n = 2) AS second FROM r WHERE n <= 2 GROUP BY video_id),
d AS (SELECT v.id AS video_id, audio_id, score, CASE WHEN score IS NULL THEN 'missing_audio' WHEN score - second <= 0.04 THEN 'pair_ambiguous' ELSE 'pair_found' END AS decision FROM v LEFT JOIN b ON v.id = b.video_id)
SELECT video_id, decision, CASE WHEN decision = 'pair_found' THEN audio_id END AS audio_id, CASE WHEN decision = 'pair_found' THEN score END AS score FROM d
""")
def stream_pairing(spark, sf_dir):
    """Names aside: the likeness is fixed, as SQL has none of that kind."""
    return assets.pair_streams(_streams(spark, sf_dir, 0), _streams(spark, sf_dir, 1), likeness=lambda a, b: 1.0)


@query()
def stream_pairing_by_name(spark, sf_dir):
    return assets.pair_streams(_streams(spark, sf_dir, 0), _streams(spark, sf_dir, 1))


_ROLES = ("primary_video", "album_image", "album_image", "bgm_audio", "cover_image")


@query(f"""
WITH a AS (SELECT l_orderkey AS task_id, CASE WHEN l_orderkey % 2 = 0 THEN 'album' ELSE 'video' END AS mode, {list(_ROLES)}[CAST((l_partkey + l_orderkey) % 5 AS INTEGER) + 1] AS role, l_linenumber - (l_suppkey % 7 = 0)::INT AS sequence FROM lineitem),
f AS (SELECT task_id, mode, count(*) FILTER (WHERE role = 'primary_video') AS videos, count(*) FILTER (WHERE role = 'album_image') AS images, count(*) FILTER (WHERE role = 'bgm_audio') AS audios, count(*) FILTER (WHERE role = 'album_image' AND coalesce(sequence, 0) <= 0) AS unnumbered,
  count(DISTINCT sequence) FILTER (WHERE role = 'album_image') AS numbers, max(sequence) FILTER (WHERE role = 'album_image') AS highest FROM a GROUP BY task_id, mode)
SELECT task_id, mode, videos, images, audios, CASE WHEN videos > 0 AND images > 0 THEN 'mixed_primaries' WHEN mode = 'video' AND images > 0 THEN 'route_mismatch' WHEN mode = 'video' AND videos = 0 THEN 'missing_video' WHEN mode = 'video' AND videos > 1 THEN 'multiple_videos'
  WHEN mode = 'album' AND videos > 0 THEN 'route_mismatch' WHEN mode = 'album' AND images = 0 THEN 'missing_images' WHEN mode = 'album' AND unnumbered > 0 THEN 'invalid_sequence' WHEN mode = 'album' AND numbers < images THEN 'duplicate_sequence' WHEN mode = 'album' AND highest <> images THEN 'sequence_gap' END AS fault FROM f
""")
def artifact_conformity(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("task_id"), F.when(F.col("l_orderkey") % 2 == 0, "album").otherwise("video").alias("mode"), F.get(F.array(*[F.lit(r) for r in _ROLES]), ((F.col("l_partkey") + F.col("l_orderkey")) % 5).cast("int")).alias("role"),
        (F.col("l_linenumber") - F.when(F.col("l_suppkey") % 7 == 0, 1).otherwise(0)).alias("sequence"),
    )
    return assets.conformity(rows)


@query("""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN s || '_img_' || lpad(CAST(page_id % 20 AS VARCHAR), 3, '0') || e WHEN 1 THEN s || '_bgm' || e WHEN 2 THEN s || '_cover' || e ELSE s || e END AS name
FROM (SELECT page_id, regexp_replace(regexp_replace(url, '[<>:"/\\\\|?*]', '_', 'g'), '^[. ]+|[. ]+$', '', 'g') AS s, '.' || ['jpg', 'mp4', 'mp3', 'png'][CAST(page_id % 4 AS INTEGER) + 1] AS e FROM pages) x
""")
def artifact_names(spark, sf_dir):
    n = F.col("page_id")
    role = F.get(F.array(F.lit("album_image"), F.lit("bgm_audio"), F.lit("cover_image"), F.lit("primary_video")), (n % 4).cast("int"))
    ext = scalars.safe_extension(F.get(F.array(F.lit(".JPG"), F.lit(" mp4"), F.lit("m-p-3"), F.lit("png")), (n % 4).cast("int")))
    return table(spark, sf_dir, "pages").select(n, scalars.artifact_name(F.col("url"), role, n % 20, ext).alias("name"))


@query("""SELECT doc_id, md5(regexp_replace(regexp_replace('msToken=' || substr(text, 1, 9) || ' token=' || doc_id || ' ' || text, '(?i)(msToken=)[a-zA-Z0-9%_\\./+-]+', '\\1[REDACTED]', 'g'), '(?i)((?:bearer|token|access_token)=)[a-zA-Z0-9%_-]+', '\\1[REDACTED]', 'g')) AS scrubbed FROM documents""")
def secret_scrub(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(scalars.without_secrets(F.concat(F.lit("msToken="), F.substring("text", 1, 9), F.lit(" token="), F.col("doc_id").cast("string"), F.lit(" "), "text"))).alias("scrubbed"))


@query("""SELECT page_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS tags FROM (SELECT page_id, regexp_extract_all('#' || split_part(url, '/', 3) || ' #a#b #a ' || url, '#([^\\s#]+)', 1) AS l FROM pages) x""")
def hashtags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(scalars.hashtags(F.concat(F.lit("#"), F.split_part("url", F.lit("/"), F.lit(3)), F.lit(" #a#b #a "), "url")), ",").alias("tags"))


@query("""SELECT event_id, strftime(make_timestamp((1600000000 + event_id * 977) * 1000000), '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 2 = 0 AND event_id % 1000 > 0 THEN '.' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || '000' ELSE '' END || '+00:00' AS published FROM events""")
def published_at(spark, sf_dir):
    n = F.col("event_id")
    epoch = F.when(n % 2 == 0, (1600000000 + n * 977) * 1000 + n % 1000).otherwise(1600000000 + n * 977)
    return table(spark, sf_dir, "events").select(n, scalars.published_at(epoch).alias("published"))


@query("""
WITH p AS (SELECT p_partkey, CAST(p_size % 3 AS INTEGER) AS k, CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_retailprice END AS d, CASE WHEN p_size % 2 = 0 THEN p_brand END AS b FROM part)
SELECT p_partkey, CASE WHEN NOT d > 0 THEN 'invalid' WHEN k = 0 THEN 'audio_video' WHEN k = 1 THEN 'video_only' ELSE 'audio_only' END AS media_type, CASE WHEN b IN ('Brand#1', 'Brand#2') THEN b ELSE 'other' END AS platform FROM p
""")
def media_types(spark, sf_dir):
    k = F.col("p_size") % 3
    duration = F.when(F.col("p_size") % 10 == 0, 0.0).otherwise(F.col("p_retailprice"))
    brand = F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", collection.media_type(duration, k <= 1, k != 1).alias("media_type"), collection.platform(brand, ("Brand#1", "Brand#2")).alias("platform"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS content_id, CASE WHEN event_type = 'click' THEN 'image_album' ELSE 'video' END AS content_type, 'see #' || event_type || ' #x' AS description, event_type || ',x' AS tags, 'u' || user_id AS author, round(CAST(floor(value * 100) AS BIGINT) / 1000, 3) AS seconds FROM events
""")
def canonical_items(spark, sf_dir):
    """Raw items are written as JSON from events, parsed again and brought into canonical form."""
    e = table(spark, sf_dir, "events")
    raw = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("aweme_id"), F.concat(F.lit("see #"), "event_type", F.lit(" #x")).alias("desc"), F.when(F.col("event_type") == "click", 68).otherwise(0).alias("aweme_type"),
            F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("uid")).alias("author"), F.struct(F.floor(F.col("value") * 100).cast("bigint").alias("duration")).alias("video"),
        )
    )
    items = collection.canonical_items(collection.parsed(e.select(raw.alias("raw"))))
    return items.select("content_id", "content_type", "description", F.array_join("tags", ",").alias("tags"), F.col("author.platform_author_id").alias("author"), F.col("media.duration_seconds").alias("seconds"))


@query()
def surface_forms(spark, sf_dir):
    """Units by the folded surface of their statement, as Python folds it."""
    from sheafwork.functions.pytext import surface

    return units(spark, sf_dir).groupBy(surface(F.col("statement")).alias("surface")).agg(F.count(F.lit(1)).alias("n"))


# Quality -----------------------------------------------------------------------------------------------------------


@query(f"""WITH {UNITS} SELECT unit_rowid, 'missing' AS fault FROM units WHERE unit_rowid % 31 = 0 AND unit_rowid % 37 <> 0 UNION ALL SELECT unit_rowid, 'orphan' AS fault FROM units WHERE unit_rowid % 37 = 0 AND unit_rowid % 31 <> 0""")
def projection_faults(spark, sf_dir):
    u = units(spark, sf_dir)
    return quality.projection_faults(u.where("unit_rowid % 37 <> 0"), store.text_projection(rich_units(spark, sf_dir).where("unit_rowid % 31 <> 0")), "unit_rowid")


@query(f"""
WITH {SEGMENTS}, c AS (SELECT conv_id, turn // 3 AS chunk, list(segment_id) AS ids FROM (SELECT conv_id, turn, segment_id FROM segments UNION ALL SELECT conv_id, turn + 1, segment_id FROM segments WHERE turn % 3 = 2) x GROUP BY conv_id, turn // 3)
SELECT conv_id, count(*) AS chunks, CAST(sum(len(ids)) AS BIGINT) AS refs, (SELECT count(DISTINCT segment_id) FROM segments s WHERE s.conv_id = c.conv_id) AS unique_refs FROM c GROUP BY conv_id
""")
def chunk_summary(spark, sf_dir):
    s = segments(spark, sf_dir).select("conv_id", "turn", "segment_id")
    both = s.unionByName(s.where("turn % 3 = 2").withColumn("turn", F.col("turn") + 1))
    chunks = both.groupBy("conv_id", F.floor(F.col("turn") / 3).alias("chunk")).agg(F.collect_list("segment_id").alias("ids"))
    return quality.chunk_summary(chunks, "conv_id")


@query("""
SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'malformed' WHEN event_id % 43 = 0 THEN 'empty' WHEN event_id % 49 = 0 THEN 'secret' WHEN event_id % 53 = 0 THEN 'malformed' WHEN event_id % 47 = 0 THEN 'identity:event_id' END AS fault
FROM events WHERE event_id % 50 = 0 OR event_id % 43 = 0 OR event_id % 49 = 0 OR event_id % 53 = 0 OR event_id % 47 = 0
""")
def outbox_payload_faults(spark, sf_dir):
    n, e = F.col("event_id"), table(spark, sf_dir, "events")
    good = F.format_string('{"id": %d, "props": %s%s}', F.when(n % 47 == 0, n + 1).otherwise(n), "props", F.when(n % 49 == 0, ', "x": {"note": "Cookie = 1"}').otherwise(""))
    payload = F.when(n % 50 == 0, "{").when(n % 43 == 0, " ").when((n % 49 != 0) & (n % 53 == 0), "[1]").otherwise(good)
    return quality.payload_faults(e.select("event_id", payload.alias("payload")), {"event_id": "$.id"}).select("event_id", "fault")


from sheafwork.plans import intake, lifecycle, media  # noqa: E402, F401 (they register the rest)
