"""A corpus made ready for training: five stages, each one operator of ``reelstar.llm``.

Every stage reads what the one before it wrote, works on all of it, and hands on whole documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.llm import decontaminate, langid, mixing, sharding, simhash
from reelstar.session import scratch_dir

SHARDS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a clear language; the model learns from those that are labelled."""
    return langid.accepted(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link at two bits or
    fewer: the one with the least id."""
    return simhash.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources uses them."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    placed = sharding.kd_shards(docs, shards=SHARDS)
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]

# zstandard and the CGK embedding have no SQL; the tests hold the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs.withColumn("shard", F.col("shard").cast("int"))
