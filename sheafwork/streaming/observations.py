"""Incremental forms: observations into current items, the outbox, all replay-safe.

State is a table per batch number under one folder, and a pointer names the last one that is whole, with a digest of the
batch's rows. A batch that comes again with the same rows changes nothing, with others it is an error; readers never see
half a batch. Folders before the last two are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("scope_id", "content_id")


def folded(items: DataFrame | None, observations: DataFrame, lapse: int) -> DataFrame:
    """Items after a batch of observations (keys, position). First sightings are kept, a repeated position counts once.

    The batch's own first position decides whether an item came back since the state's last one; inside the batch,
    each gap does. One aggregation of the batch and one join with the state by key.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*KEYS).orderBy("position")
    fresh = observations.dropDuplicates([*KEYS, "position"]).withColumn("gap", F.col("position") - F.lag("position").over(w))
    back = F.col("gap") > lapse
    new = fresh.groupBy(*KEYS).agg(
        F.min("position").alias("n_first"), F.max("position").alias("n_last"), F.count(F.lit(1)).alias("n_count"), F.count_if(back).alias("n_back"), F.max(F.when(back, F.col("position"))).alias("n_back_at")
    )
    if items is None:
        return new.select(*KEYS, F.col("n_first").alias("first_seen"), F.col("n_last").alias("last_seen"), F.col("n_count").alias("observed_count"), F.col("n_back").alias("reappearances"), F.col("n_back_at").alias("reappeared_at"))
    both = items.join(new, list(KEYS), "full_outer")
    lapsed = F.coalesce(F.col("n_first") - F.col("last_seen") > lapse, F.lit(False))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return both.select(
        *KEYS,
        F.coalesce("first_seen", "n_first").alias("first_seen"),
        F.greatest("last_seen", "n_last").alias("last_seen"),
        (zero("observed_count") + zero("n_count")).alias("observed_count"),
        (zero("reappearances") + zero("n_back") + F.when(lapsed, 1).otherwise(0)).alias("reappearances"),
        F.greatest("reappeared_at", "n_back_at", F.when(lapsed, F.col("n_first"))).alias("reappeared_at"),
    )


VERSION = "items-v1"
POINTER = "batch bigint, digest string, version string"


class DivergentReplay(Exception):
    """A batch that was folded in before comes again with other rows."""


class ItemStore:
    """Current items in versioned folders of a shared file system, reached by Spark's own readers and writers."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        versions = {r["version"] for r in self._pointer().select("version").distinct().collect()}
        if versions - {VERSION}:
            raise ValueError(f"a store of another version: {', '.join(sorted(map(str, versions - {VERSION})))}")

    def _fs(self, path: str):
        own = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return own.getFileSystem(self.spark._jsc.hadoopConfiguration()), own

    def _pointer(self) -> DataFrame:
        fs, path = self._fs(f"{self.folder}/pointer")
        return self.spark.read.schema(POINTER).json(f"{self.folder}/pointer") if fs.exists(path) else self.spark.createDataFrame([], POINTER)

    def committed(self) -> int | None:
        """Number of the last whole batch."""
        return self._pointer().agg(F.max("batch")).first()[0]

    def items(self) -> DataFrame | None:
        batch = self.committed()
        return None if batch is None else self.spark.read.parquet(f"{self.folder}/batch={batch}")

    def apply(self, observations: DataFrame, batch: int, lapse: int = 20) -> None:
        """Folds a batch in, once. A number up to the committed one is a replay: nothing if its rows are the same, else an error."""
        marks = observations.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*[F.col(c) for c in sorted(observations.columns)]).cast("decimal(38,0)")).alias("s")).first()
        digest, last = f"{marks['n']}:{marks['s']}", self.committed()
        if last is not None and batch <= last:
            known = self._pointer().where(F.col("batch") == batch).select("digest").first()
            if known is not None and known["digest"] != digest:
                raise DivergentReplay(f"batch {batch} comes again with other rows")
            return
        folded(self.items(), observations, lapse).write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        self.spark.createDataFrame([(batch, digest, VERSION)], POINTER).coalesce(1).write.mode("append").json(f"{self.folder}/pointer")
        for r in self._pointer().where(F.col("batch") < (last if last is not None else batch)).select("batch").collect():
            fs, path = self._fs(f"{self.folder}/batch={r['batch']}")
            fs.delete(path, True)

    def follow(self, stream: DataFrame, checkpoint: str, lapse: int = 20):
        """Runs over all that a stream holds now, then stops; a restart goes on where the last run ended."""
        return stream.writeStream.foreachBatch(lambda frame, batch: self.apply(frame, batch, lapse)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
