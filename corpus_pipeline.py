"""A corpus pipeline: language, toxicity, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; all but the last return
the columns of documents. ``run`` writes each stage's result as Parquet in the shared checkpoint folder and reads it
again, so a lost executor costs one stage at most.

Defined cases: an empty table gives no rows; null and empty texts have no letters and go with the first stage; of rows
that repeat an id and a text one stays; a document without an id is judged like any other; columns of any other name
are carried along. ORACLE_SQL is None: the models of the first two stages, components
of near copies, raking and packing aren't SQL; the tests hold the stages against brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sheafwork.llm import langid, mixing, packing, simhash, toxicity
from sheafwork.llm.common import shared_folder
from sheafwork.llm.registry import vocabulary

ORACLE_SQL = None
#: Chance of toxicity from which a document goes.
TOXIC = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without letters go."""
    return langid.accepted(docs, vocabulary("piece_bpe_32k.model"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones among them, scores below TOXIC."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TOXIC)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    Candidates are the links of SimHash fingerprints by vantage-point trees, as in op2, and of MinHash, which adds those
    that four bits miss; an exact similarity of 0.8 of their five-word shingles decides.
    """
    return simhash.representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of sources, languages and topics."""
    return mixing.sampled(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), added=True)


STAGES = [("language", language), ("toxicity", clean), ("near duplicates", unique), ("mixing", mixed), ("packing", packed)]


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; of the results in between only the last one stays in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{own}/{number}")
        docs = spark.read.parquet(f"{own}/{number}")
        if number:
            _delete(spark, f"{own}/{number - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
