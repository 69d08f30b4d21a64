"""What the operators of this subpackage share: durable cuts of the lineage and Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of one Arrow batch. Texts are long, so batches are kept far below Spark's default of 10,000 rows.
BATCH_ROWS = 2000
#: Bytes of one Arrow batch, for tables whose texts are very long.
BATCH_BYTES = "16m"


def _local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers get, by rows and by bytes, for the rest of the session.

    Spark reads these settings when a plan runs, so they can't be put back when an operator returns its plan. Smaller
    ones that the session has already stay. On one machine, workers also learn where this package lies, for sessions
    started from another folder; on a cluster it is installed or shipped with --py-files.
    """
    if _local(spark):
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; on one machine, where it is unset, a temporary one."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not _local(spark):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="checkpoints-")


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a reliable checkpoint in the shared folder.

    All executors share that folder, so a lost executor costs no recomputation of what was cut. How long the files
    stay is the session's choice (spark.cleaner.referenceTracking.cleanCheckpoints).
    """
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def release() -> None:
    """Gives what Python no longer uses back to the system, where its C library has a way for that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_HELD: dict[str, tuple] = {}


def held(name: str, owner, make):
    """What a worker keeps from batch to batch and task to task: the last thing made, so that stages don't add up.

    The memory of the one before goes back to the system.
    """
    if name not in _HELD or _HELD[name][0] is not owner:
        if _HELD:
            _HELD.clear()
            release()
        _HELD[name] = (owner, make())
    return _HELD[name][1]


def map_arrow(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """mapInArrow with bounded batches; function gets one RecordBatch and returns one or None."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = function(batch)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def free_prefix(df: DataFrame) -> str:
    """A prefix for columns of our own that no column of the table begins with."""
    prefix = "own_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = f"{prefix}x_"
    return prefix


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id, modulus: int, remainder: int):
    """True where crc32 of the id written as text leaves this remainder; a null id is written as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus == remainder
