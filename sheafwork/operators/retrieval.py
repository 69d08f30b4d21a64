"""Literal retrieval over knowledge units: planner, index, candidates, weighted BM25, lexicographic ranking, top-k.

A query is normalised (NFKC, collapsed white space) and split into terms. Terms of three or more characters form the
full-text path, shorter ones the substring path, both together the mixed one. A full-text term matches a field that
contains it, whatever the case, as a trigram phrase would. Corpus statistics come from the whole index, filters only
narrow the candidates.

An ``Index`` holds the units in partitions by their number, and postings: each trigram with the blocks of ``BLOCK``
neighbouring units that have it, in buckets. A query looks up how frequent its trigrams are, reads the postings of the
rarest ones of each term alone, and verifies the units of the blocks that have them all; partitions without any are
never read. Statistics of a term come from the same units. Without postings, all units are scanned; results are the
same. What reaches the driver is a row a trigram of the query, the numbers of partitions (at most ``PARTS``), and a row
of statistics.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.plans.views import STATUSES, UNIT_TYPES

FIELDS = ("statement", "entity", "topic", "excerpt")
WEIGHTS = {"statement": 5.0, "entity": 2.0, "topic": 2.0, "excerpt": 1.0}
K1, B, TOP_MOST = 1.2, 0.75, 100
FILTERS = ("canonical_id", "unit_type", "verification_status", "topic", "entity", "topics", "entities")
#: Partitions of an index's units at most, buckets of its postings, and trigrams looked up for a term.
PARTS, BUCKETS, RAREST = 4096, 64, 3
#: Neighbouring units that share a posting.
BLOCK = 32


def normalise(text: str) -> str:
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text).strip())


@dataclass(frozen=True)
class Query:
    """A checked query: non-blank text, 1 to 100 hits, filters by field (any of the values; all of the fields)."""

    text: str
    top_k: int = 10
    filters: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not isinstance(self.text, str) or not normalise(self.text):
            raise ValueError("a query needs text")
        if isinstance(self.top_k, bool) or not 1 <= self.top_k <= TOP_MOST:
            raise ValueError(f"top_k must lie between 1 and {TOP_MOST}")
        allowed = {"unit_type": UNIT_TYPES, "verification_status": STATUSES}
        for name, values in self.filters.items():
            if name not in FILTERS or set(values or ()) - set(allowed.get(name, values or ())):
                raise ValueError(f"unknown filter {name}: {values}")

    @property
    def terms(self) -> list[str]:
        return normalise(self.text).lower().split(" ")

    @property
    def long(self) -> list[str]:
        return [t for t in self.terms if len(t) >= 3]

    @property
    def short(self) -> list[str]:
        return [t for t in self.terms if len(t) < 3]

    @property
    def path(self) -> str:
        return "substring_short" if not self.long else "fts_trigram_with_short_filter" if self.short else "fts_trigram"


def _lower(name: str) -> Column:
    return F.lower(F.coalesce(F.col(name), F.lit("")))


def _has(name: str, term: str) -> Column:
    return F.contains(_lower(name), F.lit(term))


def _any_field(term: str) -> Column:
    return reduce(Column.__or__, [_has(f, term) for f in FIELDS])


def filtered(units: DataFrame, filters: dict[str, tuple[str, ...]]) -> DataFrame:
    """Rows with one of the values in every filtered field, which may be an array; empty filters count as unset."""
    kinds = dict(units.dtypes)
    for name, values in filters.items():
        if values:
            own = F.col(name).isin(list(values)) if not kinds[name].startswith("array") else F.arrays_overlap(F.col(name), F.array(*[F.lit(v) for v in values]))
            units = units.where(own)
    return units


def occurrences(name: str, term: str) -> Column:
    """How often a field contains a term, overlaps included."""
    return F.regexp_count(_lower(name), F.lit("(?=" + re.escape(term) + ")"))


def trigrams(names=FIELDS) -> Column:
    """Length of a row in the index: trigrams of all fields."""
    return reduce(Column.__add__, [F.greatest(F.lit(0), F.length(F.coalesce(F.col(f), F.lit(""))) - 2) for f in names])


def grams_of(text: Column) -> Column:
    """Different trigrams of a text, in one pass over it."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(...))"), F.lit(1)))


def term_grams(term: str) -> list[str]:
    return sorted({term[k : k + 3] for k in range(len(term) - 2)})


@dataclass(frozen=True)
class Index:
    """Units and, if they were built, postings (bucket, gram, block, part) and grams (bucket, gram, n) over all their fields."""

    units: DataFrame
    rows: int | None = None
    mean: float | None = None
    buckets: int = BUCKETS
    postings: DataFrame | None = None
    grams: DataFrame | None = None

    def _only(self, table: DataFrame, grams: list[str]) -> DataFrame:
        """Rows of some trigrams: their buckets are pruned, their row groups skipped."""
        return table.where(F.col("bucket").isin(sorted({zlib.crc32(g.encode()) % self.buckets for g in grams})) & F.col("gram").isin(grams))

    def holding(self, terms: list[str]) -> DataFrame:
        """Units that may hold one of the terms, which are still to be verified; all units without terms."""
        per_term = min(RAREST, 62 // max(1, len(terms)))
        if self.postings is None or not terms or not per_term:
            return self.units
        looked = sorted({g for t in terms for g in term_grams(t)})
        counts = {r["gram"]: r["n"] for r in self._only(self.grams, looked).groupBy("gram").agg(F.sum("n").alias("n")).collect()}
        chosen = {t: sorted(term_grams(t), key=lambda g: (counts.get(g, 0), g))[:per_term] for t in terms}
        bits = {g: 1 << k for k, g in enumerate(sorted({g for own in chosen.values() for g in own}))}
        bit = F.create_map(*[F.lit(x) for g, b in bits.items() for x in (g, b)])[F.col("gram")]
        ids = self._only(self.postings, list(bits)).groupBy("part", "block").agg(F.bit_or(bit).alias("has"))
        full = [F.col("has").bitwiseAND(F.lit(sum(bits[g] for g in own))) == sum(bits[g] for g in own) for own in chosen.values()]
        ids = ids.where(reduce(Column.__or__, full)).select("part", "block")
        parts = [r[0] for r in ids.select("part").distinct().collect()]
        return self.units.where(F.col("part").isin(parts)).join(ids, ["part", "block"], "left_semi")


def build_index(units: DataFrame, folder: str, buckets: int = BUCKETS, parts: int = PARTS) -> Index:
    """Writes units and postings below a folder that all executors share, and opens them."""
    facts = units.agg(F.min("unit_rowid").alias("low"), F.max("unit_rowid").alias("high"), F.count(F.lit(1)).alias("rows"), F.avg(trigrams()).alias("mean")).first()
    low = facts["low"] or 0
    width = BLOCK * max(1, -(-((facts["high"] or 0) - low + 1) // (parts * BLOCK)))
    place = F.col("unit_rowid") - low
    own = units.withColumns({"part": F.floor(place / width).cast("int"), "block": F.floor(place / BLOCK).cast("bigint")})
    own.repartitionByRange("unit_rowid").write.partitionBy("part").parquet(f"{folder}/units")
    spark, kept = units.sparkSession, "part int, block bigint, gram string, bucket int"
    stored = spark.read.parquet(f"{folder}/units")
    all_grams = F.array_distinct(F.flatten(F.array(*[grams_of(_lower(f)) for f in FIELDS])))
    # Neighbours lie together, so a block's equal trigrams are one row before the shuffle. A frequent trigram still has a row
    # a block, so a bucket is dealt to several tasks.
    rows = stored.select("part", "block", F.explode(all_grams).alias("gram")).distinct().withColumn("bucket", (F.crc32(F.col("gram").cast("binary")) % buckets).cast("int"))
    rows = rows.repartition("bucket", F.pmod(F.col("block"), F.lit(8))).sortWithinPartitions("bucket", "gram", "block")
    rows.select("part", "block", "gram", "bucket").write.partitionBy("bucket").parquet(f"{folder}/postings")
    counted = spark.read.schema(kept).parquet(f"{folder}/postings").groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
    counted.repartition("bucket").sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(f"{folder}/grams")
    meta = units.sparkSession.createDataFrame([(facts["rows"], facts["mean"] or 1.0, buckets)], "rows bigint, mean double, buckets int")
    meta.coalesce(1).write.json(f"{folder}/meta")
    return open_index(units.sparkSession, folder)


def open_index(spark: SparkSession, folder: str) -> Index:
    meta = spark.read.schema("rows bigint, mean double, buckets int").json(f"{folder}/meta").first()
    postings = spark.read.schema("part int, block bigint, gram string, bucket int").parquet(f"{folder}/postings")
    grams = spark.read.schema("gram string, n bigint, bucket int").parquet(f"{folder}/grams")
    return Index(spark.read.parquet(f"{folder}/units"), meta["rows"], meta["mean"], meta["buckets"], postings, grams)


def as_index(units: DataFrame | Index) -> Index:
    return units if isinstance(units, Index) else Index(units)


def corpus_statistics(units: DataFrame | Index, terms: list[str], held: DataFrame | None = None) -> dict:
    """Rows, mean length, and rows with each term: one row, from the rows that may hold one of the terms (``held``, if they are at hand)."""
    index = as_index(units)
    counts = [F.count_if(_any_field(t)).alias(f"n{k}") for k, t in enumerate(terms)]
    whole = [F.count(F.lit(1)).alias("rows"), F.avg(trigrams()).alias("mean")] if index.rows is None else []
    row = (held if held is not None else index.holding(terms)).agg(*whole, *counts).first() if whole or counts else {}
    return {"rows": row["rows"] if whole else index.rows, "mean": (row["mean"] if whole else index.mean) or 1.0, "hits": {t: row[f"n{k}"] for k, t in enumerate(terms)}}


def bm25(terms: list[str], stats: dict) -> Column:
    """Weighted BM25, lower is better."""
    import math

    out, norm = F.lit(0.0), F.lit(K1) * (F.lit(1 - B) + F.lit(B) * trigrams() / F.lit(float(stats["mean"])))
    for term in terms:
        hits = stats["hits"][term]
        idf = math.log((stats["rows"] - hits + 0.5) / (hits + 0.5))
        f = reduce(Column.__add__, [F.lit(WEIGHTS[name]) * occurrences(name, term) for name in FIELDS])
        out = out + F.lit(idf if idf > 0 else 1e-6) * f * F.lit(K1 + 1) / (f + norm)
    return -out


def short_score(terms: list[str]) -> Column:
    """Sum over terms and fields of the weight of each field that contains the term."""
    return reduce(Column.__add__, [F.when(_has(name, t), WEIGHTS[name]).otherwise(0.0) for t in terms for name in FIELDS])


def with_match_statistics(rows: DataFrame, query: Query) -> DataFrame:
    """Per field whether any term matches, exact phrases, matched terms, coverage, and matches in evidence alone."""
    phrase = normalise(query.text).lower()
    for name in FIELDS:
        rows = rows.withColumn(f"{name}_match", reduce(Column.__or__, [_has(name, t) for t in query.terms])).withColumn(f"exact_{name}_phrase", _has(name, phrase))
    matched = reduce(Column.__add__, [F.when(_any_field(t), 1).otherwise(0) for t in query.terms])
    return (
        rows.withColumn("matched_terms", matched.cast("int"))
        .withColumn("term_coverage", F.col("matched_terms") / F.lit(len(query.terms)))
        .withColumn("evidence_only", F.col("excerpt_match") & ~(F.col("statement_match") | F.col("entity_match") | F.col("topic_match")))
    )


def candidates(units: DataFrame | Index, query: Query, stats: dict | None = None, held: DataFrame | None = None) -> DataFrame:
    """All rows that match, with their score; the whole index gives the statistics, if they aren't given with the rows to look at."""
    index, terms = as_index(units), sorted(set(query.long))
    if held is None:
        held = index.holding(terms)
    found = filtered(held, query.filters)
    for term in query.terms:
        found = found.where(_any_field(term))
    score = bm25(query.long, stats or corpus_statistics(index, terms, held)) if query.long else short_score(query.short)
    return with_match_statistics(found.withColumn("score", F.round(score, 9)), query)


def ranking(query: Query) -> list[Column]:
    """The sort key, ascending; the last part is the row's number, so order is total."""
    flag = lambda name: F.when(F.col(name), 0).otherwise(1)
    if query.long:
        return [F.when(F.col("evidence_only"), 1).otherwise(0), flag("exact_statement_phrase"), flag("statement_match"), flag("entity_match"), flag("topic_match"), F.desc("term_coverage"), F.col("score"), F.col("unit_rowid")]
    return [F.desc("score"), flag("exact_statement_phrase"), F.desc("term_coverage"), F.col("unit_rowid")]


def why(query: Query) -> Column:
    return F.concat_ws(" and ", *[F.when(F.col(f"{f}_match"), f) for f in FIELDS])


def top_ranked(found: DataFrame, query: Query, order: list[Column]) -> DataFrame:
    """The first rows in an order, with their rank."""
    from pyspark.sql import Window

    top = found.orderBy(*order).limit(query.top_k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # at most top_k rows


def retrieve(units: DataFrame | Index, query: Query, stats: dict | None = None) -> DataFrame:
    """The ranked top: rank, path and why each row was hit. Sorting and limit become one TakeOrderedAndProject."""
    ranked = top_ranked(candidates(units, query, stats), query, ranking(query))
    return ranked.select("rank", "unit_rowid", "canonical_id", "unit_type", "score", "term_coverage", "evidence_only", why(query).alias("matched_on"), F.lit(query.path).alias("path"))


def retrieve_many(units: DataFrame | Index, queries: dict[str, Query]) -> tuple[DataFrame, DataFrame]:
    """(hits, all candidates) of several queries, each with its query_id; statistics of all their terms come from one pass."""
    index, terms = as_index(units), sorted({t for q in queries.values() for t in q.long})
    held = index.holding(terms)
    stats = corpus_statistics(index, terms, held)
    found = {name: candidates(index, q, stats, held if q.long else index.units) for name, q in queries.items()}
    hits = [top_ranked(found[name], q, ranking(q)).withColumn("query_id", F.lit(name)).withColumn("path", F.lit(q.path)) for name, q in queries.items()]
    every = [frame.withColumn("query_id", F.lit(name)) for name, frame in found.items()]
    return reduce(DataFrame.unionByName, hits), reduce(DataFrame.unionByName, every)


def best_by_bm25(units: DataFrame | Index, query: Query) -> DataFrame:
    """The low-level top: full-text terms alone, by BM25 and number."""
    if not query.long:
        raise ValueError("a full-text query needs a term of three characters")
    return top_ranked(candidates(units, query), query, [F.col("score"), F.col("unit_rowid")]).select("rank", "unit_rowid", "score")


def hydrated(units: DataFrame | Index, query: Query, assets: DataFrame) -> DataFrame:
    """The ranked top with all of a unit's columns, its match facts, and its asset's path and fingerprint (null if unknown).

    assets: canonical_id, path, fingerprint. One join of at most ``top_k`` rows; a hit without full coverage is an error.
    """
    ranked = top_ranked(candidates(units, query), query, ranking(query))
    sound = F.when(F.col("term_coverage") == 1, F.col("term_coverage")).otherwise(F.raise_error(F.lit("a hit lacks a term")).cast("double"))
    own = assets.select(F.col("canonical_id").alias("a_id"), F.col("path").alias("source_path"), F.col("fingerprint").alias("source_fingerprint"))
    text = F.concat(F.lit("matched query terms in "), F.concat_ws(" and ", F.when(F.col("statement_match"), "statement"), F.when(F.col("entity_match"), "entities"), F.when(F.col("topic_match"), "topics"), F.when(F.col("excerpt_match"), "evidence")))
    return ranked.withColumn("term_coverage", sound).withColumn("why_this_hit", text).join(own, F.col("canonical_id") == F.col("a_id"), "left").drop("a_id")


# What each path can't do.
LIMITS = {
    "fts_trigram": [],
    "substring_short": ["trigram cannot match terms shorter than 3 characters; deterministic literal substring fallback used"],
    "fts_trigram_with_short_filter": ["short terms constrained via deterministic literal substring (trigram <3-character limitation)"],
}


def diagnostics(units: DataFrame | Index, query: Query) -> dict:
    """The plan of a query and how many candidates it had before the limit."""
    n = candidates(units, query, None).count()
    return {
        "normalized_query": normalise(query.text), "terms": query.terms, "long_terms": query.long, "short_terms": query.short, "retrieval_path": query.path, "filters_applied": {k: list(v) for k, v in query.filters.items() if v},
        "candidate_count_before_limit": n, "result_count": min(n, query.top_k), "top_k": query.top_k, "short_query_fallback": bool(query.short), "limitations": LIMITS[query.path],
    }


class Backend:
    """What answers queries: another one needs this method alone."""

    def __init__(self, index: DataFrame | Index):
        self.index = as_index(index)

    def retrieve(self, query: Query) -> DataFrame:
        return retrieve(self.index, query)


def postings(units: DataFrame) -> DataFrame:
    """Each trigram of a field with its row and how often it stands there."""
    texts = F.array(*[F.struct(F.lit(f).alias("field"), F.regexp_extract_all(_lower(f), F.lit("(?s)(?=(...))"), F.lit(1)).alias("g")) for f in FIELDS])
    grams = units.select("unit_rowid", F.explode(texts).alias("x")).select("unit_rowid", "x.field", F.explode("x.g").alias("trigram"))
    return grams.groupBy("trigram", "unit_rowid", "field").agg(F.count(F.lit(1)).alias("n"))
