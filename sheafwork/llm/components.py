"""Connected components of links that never meet in one task or on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.common import durable, release

#: A node with more than this part of all links is joined by itself.
PART = 1000


def _told(links: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """Links (a, b) with their node's m. least: k, m, n (links of the node), of which there are ``total`` in about.

    Nodes with more than 1 / ``PART`` of all links, at most some thousand whatever the input, come by a broadcast, so that the
    links of a star's centre stay where they are; all others by a join, where none is large.
    """
    hot = least.where(F.col("n") > total / PART).select("k", F.col("m").alias("hot"))
    marked = links.join(F.broadcast(hot), F.col("a") == F.col("k"), "left").drop("k")
    cold = marked.where("hot is null").join(least.select("k", "m"), F.col("a") == F.col("k")).select("a", "b", "m")
    return cold.unionByName(marked.where("hot is not null").select("a", "b", F.col("hot").alias("m")))


def tidy(df: DataFrame) -> None:
    """Collects the garbage of the driver's Python and its JVM, whose heap is small between rounds."""
    release()
    df.sparkSession._jvm.System.gc()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of bigint nodes -> (node, component) for every node with a link; component is the least node.

    Alternating large and small stars: every node tells its neighbours its least neighbour, until the links are
    one star a component. Each step is an aggregation with map-side minima and a join on the node. Rounds grow with
    the logarithm of the longest chain; every round is cut by a checkpoint.
    """
    links = durable(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state, total = None, links.count()
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"), "n")
        large = durable(_told(both.where("b > a"), least, total).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select(F.col("a").alias("k"), "m", "n")
        pairs = F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        links = durable(_told(large, least, total).select(F.explode(pairs).alias("p")).select("p.a", "p.b").where("a <> b").distinct())
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        state, total = now, now[0]
        del both, least, large
        tidy(links)  # shuffles and checkpoints of a round go with the driver's garbage
