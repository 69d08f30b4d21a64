"""Where a session may write what all of its executors have to read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the one that the cluster names in spark.checkpoint.dir; a temporary one on one machine."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="shared-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
