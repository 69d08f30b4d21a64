"""The store: fingerprints, idempotent ingestion, revisions, child tables, validation, rebuilds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Versions that a store must have.
SCHEMA_VERSION, USER_VERSION, INDEX_POLICY = "knowledge-store-v1", "1", "m5-fts-trigram-v1"
META = {"schema_version": SCHEMA_VERSION, "user_version": USER_VERSION, "fts_policy_version": INDEX_POLICY}
#: Digits of the size of a unit's confidence that its payload and its column may differ by.
CLOSE = 1e-9


#: Numbers of units that one digest covers, before the asset's digest covers these.
SPAN = 4096


def asset_fingerprints(units: DataFrame) -> DataFrame:
    """canonical_id, unit_count, fingerprint: a digest of the digests of spans of units, each in order.

    A span gathers at most ``SPAN`` short digests, an asset one for each of its spans, so an asset that holds a large part of
    all units doesn't have to pass through one buffer.
    """
    each = F.struct("unit_rowid", F.sha2(F.concat_ws("|", "unit_type", "statement", "excerpt", "verification_status"), 256).alias("d"))
    joined = lambda rows: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda e: e.d), ""), 256)
    spans = units.select("canonical_id", F.floor(F.col("unit_rowid") / SPAN).alias("span"), each.alias("e")).groupBy("canonical_id", "span").agg(F.count(F.lit(1)).alias("n"), joined("e").alias("d"))
    return spans.groupBy("canonical_id").agg(F.sum("n").alias("unit_count"), joined(F.struct("span", "d")).alias("fingerprint"))


def ingest_status(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """inserted, replaced, unchanged, or kept where an asset doesn't come again; both sides canonical_id, fingerprint."""
    a, b = stored.alias("a"), incoming.alias("b")
    status = F.when(F.col("a.fingerprint").isNull(), "inserted").when(F.col("b.fingerprint").isNull(), "kept").when(F.col("a.fingerprint") == F.col("b.fingerprint"), "unchanged").otherwise("replaced")
    return a.join(b, F.col("a.canonical_id") == F.col("b.canonical_id"), "full_outer").select(F.coalesce("a.canonical_id", "b.canonical_id").alias("canonical_id"), status.alias("status"))


def ingest(stored: DataFrame, incoming: DataFrame, key: str = "canonical_id") -> DataFrame:
    """The store after ingestion: assets that come again are replaced whole, all others kept."""
    return stored.join(incoming.select(key).distinct(), key, "left_anti").unionByName(incoming)


def remove(stored: DataFrame, assets: DataFrame, key: str = "canonical_id") -> DataFrame:
    return stored.join(assets.select(key).distinct(), key, "left_anti")


def revision(fingerprints: DataFrame) -> DataFrame:
    """One row: the digest of all (asset, fingerprint) pairs in order; of [] for an empty store.

    The definition is one digest over one text, so a short row an asset (some 90 bytes, no units) is gathered to make it;
    ``revision_by_parts`` tells versions of stores apart where that is too much.
    """
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("canonical_id", "fingerprint"))), lambda x: F.concat(F.lit('["'), x.canonical_id, F.lit('","'), x.fingerprint, F.lit('"]')))
    return fingerprints.agg(F.sha2(F.concat(F.lit("["), F.array_join(pairs, ","), F.lit("]")), 256).alias("revision"), F.count(F.lit(1)).alias("assets"))


def revision_by_parts(fingerprints: DataFrame, parts: int = 1024) -> DataFrame:
    """One row: a digest of ``parts`` digests, each over the sorted pairs of the assets whose hash falls there."""
    own = fingerprints.withColumn("part", F.pmod(F.xxhash64("canonical_id"), F.lit(parts)).cast("int"))
    digest = own.groupBy("part").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "canonical_id", "fingerprint"))), ","), 256).alias("d"), F.count(F.lit(1)).alias("n"))
    return digest.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "d"))), lambda x: x.d), ""), 256).alias("revision"), F.coalesce(F.sum("n"), F.lit(0)).alias("assets"))


def children(units: DataFrame, key: str, values: str) -> DataFrame:
    """A child table: a row for each value of an array, with its ordinal from 0."""
    return units.select(key, F.posexplode(values).alias("ordinal", "value"))


def ordinal_faults(child: DataFrame, key: str) -> DataFrame:
    """Parents whose ordinals aren't exactly 0 to n - 1."""
    facts = child.groupBy(key).agg(F.min("ordinal").alias("low"), F.max("ordinal").alias("high"), F.count(F.lit(1)).alias("n"), F.countDistinct("ordinal").alias("different"))
    return facts.where("low <> 0 or high <> n - 1 or different <> n").select(key)


def count_faults(assets: DataFrame, units: DataFrame) -> DataFrame:
    """Assets whose declared number of units isn't the real one."""
    real = units.groupBy("canonical_id").agg(F.count(F.lit(1)).alias("actual"))
    return assets.join(real, "canonical_id", "left").select("canonical_id", "unit_count", F.coalesce("actual", F.lit(0)).alias("actual")).where("unit_count <> actual")


def orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return rows.join(parents.select(key).distinct(), key, "left_anti")


def text_projection(units: DataFrame) -> DataFrame:
    """The full-text row of a unit: statement, entities, topics and excerpts, joined in order."""
    return units.select("unit_rowid", "statement", F.array_join("entities", " ").alias("entities"), F.array_join("topics", " ").alias("topics"), F.array_join(F.transform("evidence_refs", lambda r: r.source_excerpt), " ").alias("excerpts"))


def kept_times(stored: DataFrame, incoming: DataFrame, now) -> DataFrame:
    """canonical_id, fingerprint, ingested_at after an ingestion: an asset that comes again unchanged keeps its time.

    stored: canonical_id, fingerprint, ingested_at; incoming: canonical_id, fingerprint.
    """
    a, b = stored.alias("a"), incoming.alias("b")
    both = a.join(b, F.col("a.canonical_id") == F.col("b.canonical_id"), "full_outer")
    stays = F.col("b.canonical_id").isNull() | F.coalesce(F.col("a.fingerprint") == F.col("b.fingerprint"), F.lit(False))
    return both.select(F.coalesce("a.canonical_id", "b.canonical_id").alias("canonical_id"), F.coalesce("b.fingerprint", "a.fingerprint").alias("fingerprint"), F.when(stays, F.col("a.ingested_at")).otherwise(now).alias("ingested_at"))


def projection_differs(units: DataFrame) -> DataFrame:
    """Units whose columns aren't those of their payload (JSON text), or whose payload can't be read: unit_rowid, fault."""
    told = F.from_json("payload", "unit_type string, statement string, verification_status string, extraction_confidence double")
    same = told.unit_type.eqNullSafe(F.col("unit_type")) & told.statement.eqNullSafe(F.col("statement")) & told.verification_status.eqNullSafe(F.col("verification_status"))
    near = F.coalesce(F.abs(told.extraction_confidence - F.col("confidence")) <= CLOSE, told.extraction_confidence.isNull() & F.col("confidence").isNull())
    fault = F.when(F.try_parse_json("payload").isNull(), "payload").when(~(same & near), "projection")
    return units.select("unit_rowid", fault.alias("fault")).where("fault is not null")


def meta_faults(meta: DataFrame) -> DataFrame:
    """Versions that aren't the expected ones, missing ones included. meta: key, value."""
    spark = meta.sparkSession
    want = spark.createDataFrame(list(META.items()), "key string, want string")
    return want.join(meta, "key", "left").where(~F.col("value").eqNullSafe(F.col("want"))).select("key", "want", "value")


def duplicate_ordinals(child: DataFrame, key: str) -> DataFrame:
    return child.groupBy(key, "ordinal").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def validation(assets: DataFrame, units: DataFrame, children: dict[str, DataFrame], projection: DataFrame, index_rows: DataFrame, key: str = "knowledge_unit_id") -> DataFrame:
    """(counter, value) of all checks of a store: sizes first, then what breaks a rule; a sound store has zeros there.

    children: evidence_refs, entities, topics, each with the unit's id and an ordinal; projection: unit_rowid of the full-text
    rows; index_rows: unit_rowid of the rows that the index has. Every check is a distributed count of its own.
    """
    one = lambda frame, name: frame.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("counter"), "value")
    units_of = units.select(key)
    orphan_children = reduce(DataFrame.unionByName, [c.select(key).join(units_of, key, "left_anti") for c in children.values()])
    numbers, rows = units.select("unit_rowid"), projection.select("unit_rowid")
    counts = [
        one(assets, "assets"), one(units, "units"), *[one(c, name) for name, c in children.items()], one(rows, "fts_content_rows"), one(index_rows, "fts_index_rows"),
        one(projection_differs(units), "projection_violations"), one(orphan_children.select(F.lit(1)).unionByName(orphans(units, assets, "canonical_id").select(F.lit(1))), "orphan_rows"),
        one(count_faults(assets, units), "asset_unit_count_mismatches"), one(orphans(units, assets, "canonical_id"), "ku_asset_mismatches"),
        one(reduce(DataFrame.unionByName, [duplicate_ordinals(c, key) for c in children.values()]), "duplicate_ordinals"), one(reduce(DataFrame.unionByName, [ordinal_faults(c, key) for c in children.values()]), "invalid_ordinals"),
        one(numbers.join(rows, "unit_rowid", "left_anti"), "fts_missing_content"), one(rows.join(numbers, "unit_rowid", "left_anti"), "fts_orphan_content"),
        one(rows.join(index_rows, "unit_rowid", "left_anti").unionByName(index_rows.select("unit_rowid").join(rows, "unit_rowid", "left_anti")), "fts_integrity_violations"),
    ]
    return reduce(DataFrame.unionByName, counts)


SIZES = ("assets", "units", "evidence_refs", "entities", "topics", "fts_content_rows", "fts_index_rows")


class Versions:
    """Whole states of a store in folders of their own; a pointer names the one that readers see."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self, path: str):
        own = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return own.getFileSystem(self.spark._jsc.hadoopConfiguration()), own

    def current(self) -> str | None:
        fs, path = self._fs(f"{self.folder}/pointer")
        return self.spark.read.schema("version string, at bigint").json(f"{self.folder}/pointer").orderBy(F.desc("at")).first()["version"] if fs.exists(path) else None

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{self.current()}/{table}")

    def rebuild(self, version: str, tables: dict[str, DataFrame], check) -> DataFrame:
        """Writes all tables, reads them again, and flips the pointer only if ``check(tables)``, a frame of (counter, value), finds nothing.

        Otherwise the old version stays what readers see, and the new one is deleted. Folders of versions before the last two go.
        """
        for name, frame in tables.items():
            frame.write.parquet(f"{self.folder}/{version}/{name}")
        found = check({name: self.spark.read.parquet(f"{self.folder}/{version}/{name}") for name in tables})
        bad = found.where(~F.col("counter").isin(list(SIZES)) & (F.col("value") > 0)).collect()  # a row a counter
        if bad:
            self._delete(version)
            raise ValueError(f"the store breaks its rules: {', '.join(r['counter'] for r in bad)}")
        number = 0 if self.current() is None else self.spark.read.schema("version string, at bigint").json(f"{self.folder}/pointer").agg(F.max("at")).first()[0] + 1
        self.spark.createDataFrame([(version, number)], "version string, at bigint").coalesce(1).write.mode("append").json(f"{self.folder}/pointer")
        for r in self.spark.read.schema("version string, at bigint").json(f"{self.folder}/pointer").where(F.col("at") < number - 1).collect():
            self._delete(r["version"])
        return found

    def _delete(self, version: str) -> None:
        fs, path = self._fs(f"{self.folder}/{version}")
        fs.delete(path, True)
