"""Quality by importance resampling.

Two generative models over hashed word n-grams are counted: one of target texts that are known
to be good, one of all raw texts. A document's weight is the ratio of its likelihoods under the
two. Documents are then sampled without replacement in proportion to their weights: Gumbel noise
is added to the logarithm of each weight, and the largest sums are taken.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import bounded_batches, ranked
from reelstar.llm.words import WordHasher
from reelstar.session import stored


def ngram_buckets(
    hasher: WordHasher, texts: list[bytes], buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of the texts, and the text of each."""
    words, begins = hasher.of(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    pairs = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]
    pairs ^= pairs >> np.uint64(31)
    inside = owner[:-1] == owner[1:]
    grams = np.concatenate([words, pairs[inside]])
    return (
        (grams % np.uint64(buckets)).astype(np.int64),
        np.concatenate([owner, owner[:-1][inside]]),
    )


def _parts(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """About a megabyte of texts at a time, and the number of the first."""
    values = texts.cast(pa.binary()).fill_null(b"")
    lengths = pa.compute.binary_length(values).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(values):
        end = at + 1 + int(np.searchsorted(np.cumsum(lengths[at + 1 :]), size))
        yield at, values[at:end].to_pylist()
        at = end


def bucket_counts(rows: DataFrame, buckets: int) -> DataFrame:
    """``bucket``, ``raw`` and ``target`` n-grams over rows of ``text`` and ``is_target``.

    A task sends each bucket once, so what is shuffled does not grow with a common word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(whole=True)
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            good = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for at, texts in _parts(batch.column(0)):
                grams, owner = ngram_buckets(hasher, texts, buckets)
                raw += np.bincount(grams, minlength=buckets)
                mine = good[at + owner]
                if mine.any():
                    target += np.bincount(grams[mine], minlength=buckets)
        used = np.flatnonzero(raw)
        for at in range(0, len(used), 1 << 16):
            part = used[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(raw[part]), pa.array(target[part])],
                ["bucket", "raw", "target"],
            )

    counted = rows.select("text", "is_target").mapInArrow(
        run, "bucket long, raw long, target long"
    )
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int, smoothing: float = 1.0) -> np.ndarray:
    """Logarithm of target over raw probability of every bucket.

    The target counts are smoothed towards the raw distribution, so a bucket the target texts
    say nothing about has ratio one.
    """
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for row in counts.toLocalIterator():  # a number of buckets that is bounded by the caller
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not raw.sum() or not target.sum():
        return np.zeros(buckets)
    p_raw = (raw + smoothing / buckets) / (raw.sum() + smoothing)
    pull = smoothing * buckets
    p_target = (target + pull * p_raw) / (target.sum() + pull)
    return np.log(p_target / p_raw)


def resample(
    docs: DataFrame,
    targets: DataFrame,
    keep: float = 0.75,
    doc_id: str = "doc_id",
    text: str = "text",
    target_docs: int = 20_000,
    buckets: int = 1 << 16,
    seed: int = 23,
) -> DataFrame:
    """``doc_id``, ``log_weight``, ``gumbel_key``, ``rank`` and ``keep`` of every document.

    ``targets`` holds the ids (``doc_id``) of good documents; the target model is counted over
    ``target_docs`` of them at most, chosen by a hash, the raw model over all documents. The
    number of ``buckets`` bounds what a task sends and the driver holds. The ``keep`` share of documents with the largest keys, rounded
    up, is kept; ``rank`` counts from 0, ties go to the smaller id. The noise is a hash of seed,
    id and text, so reruns agree. NULL and empty texts have weight 1 (logarithm 0). Without
    targets all weights are 1. Rows without an id can be no target. Repeated rows are kept.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    n = rows.count()
    good = (
        targets.filter(F.col("doc_id").isNotNull())
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64(F.lit(seed), F.col("doc_id")), "doc_id")
        .limit(target_docs)
        .withColumn("_good", F.lit(True))
    )
    marked = rows.join(F.broadcast(good), "doc_id", "left").withColumn(
        "is_target", F.coalesce("_good", F.lit(False))
    )
    ratios = log_ratios(bucket_counts(marked, buckets), buckets)
    held = spark.sparkContext.broadcast(ratios)

    @F.arrow_udf("double")
    def weight(texts: pa.Array) -> pa.Array:
        hasher, own = WordHasher(whole=True), held.value
        out = np.zeros(len(texts))
        for at, part in _parts(texts):
            grams, owner = ngram_buckets(hasher, part, buckets)
            out[at : at + len(part)] = np.bincount(owner, own[grams], len(part))
        return pa.array(out)

    h = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    uniform = (F.shiftrightunsigned(h, 11) + 0.5) / float(1 << 53)
    scored = rows.select(
        "doc_id",
        weight(F.coalesce("text", F.lit(""))).alias("log_weight"),
        (-F.log(-F.log(uniform))).alias("_noise"),
        F.xxhash64("text").alias("_text"),
    )
    scored = scored.withColumn("gumbel_key", F.col("log_weight") + F.col("_noise"))
    order = [F.desc("gumbel_key"), F.col("doc_id").asc_nulls_last(), F.col("_text")]
    placed = ranked(stored(spark, scored, "weights"), order, "rank")
    return placed.select(
        "doc_id",
        "log_weight",
        "gumbel_key",
        "rank",
        (F.col("rank") < math.ceil(keep * n)).alias("keep"),
    )
