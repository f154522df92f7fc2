"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a cap, a number of epochs over its own words. The words asked for
are shared by weight; sources above their cap are clamped to it and the excess is shared anew
among the others, until none is above. A document is then repeated whole epochs, and a seeded
prefix of each source's documents is taken once more to make up the fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstar.llm.common import packed, ranked, unpacked, word_count
from reelstar.session import stored

# Up to so many sources, their targets are sent to every task instead of moving documents.
_FEW_SOURCES = 100_000
# Sums per source are kept for so many slices of the seeded order, so only one slice of a source
# has to be looked at row by row. Three hexadecimal digits.
_SLICES = 16**3


def water_fill(sources: DataFrame, words: float, epochs: float) -> DataFrame:
    """Add ``target`` to sources with ``weight`` and ``source_size``.

    If the caps together hold fewer than ``words``, every source is at its cap. Each round sends
    three sums to the driver; a round clamps one source at least or is the last. Weights and
    sizes are whole numbers, so the sums are exact and the level does not depend on their order.
    """
    cap = F.col("source_size") * epochs
    level, clamped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > cap
        row = sources.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(~above, F.col("weight")).otherwise(0)).alias("weight"),
        ).first()
        if row["n"] == clamped or not row["weight"]:
            break
        clamped, level = row["n"], (words - row["held"]) / row["weight"]
    share = F.lit(float("inf")) if level is None or not row["weight"] else F.col("weight") * level
    return sources.withColumn("target", F.when(share > cap, cap).otherwise(share).cast("double"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: int = 7,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` to documents.

    ``size`` is the number of words (NULL text: 0). Sources in the order of their code points,
    NULL last as a source of its own, get the weights in turn; together they share ``share``
    times all words, at most ``epochs`` times their own. ``copies`` is how often the document is
    used, and ``taken`` the words that makes. The last part of an epoch goes to documents in the
    order of a hash of seed and id, up to the nearest document, so a source misses its target by
    half of one document at most and reruns agree. Rows with equal ids are ordered by size and
    text; rows without an id count as having an empty one. A source without words has target 0
    and its documents are used 0 times. Columns of the five names are replaced.
    """
    rows = packed(docs, doc_id=doc_id, text=text, _source=source)
    rows = rows.withColumn("size", word_count(F.col("text")))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumns({"_order": order, "_tie": F.xxhash64("text")})
    # what the sums need, without the texts
    light = rows.select("_source", "size", "_order", "_tie")
    light = stored(docs.sparkSession, light, "mix-sizes")
    targets = source_targets(light, weights, share, epochs)
    extra = stored(docs.sparkSession, _extra_until(light, targets), "mix-ends")
    if extra.count() <= _FEW_SOURCES:
        extra = F.broadcast(extra)
    joined = rows.join(extra, F.col("_source").eqNullSafe(F.col("_s")), "left")
    position = (F.col("_order"), F.col("size"), F.col("_tie"))
    last = (F.col("_last_order"), F.col("_last_size"), F.col("_last_tie"))
    once_more = F.coalesce(F.struct(*position) <= F.struct(*last), F.lit(False))
    copies = F.col("_whole") + F.when(once_more, 1).otherwise(0)
    return joined.select(
        *unpacked(rows, "size", "source_size", "target", "copies", "taken"),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def source_targets(
    light: DataFrame, weights: Sequence[int], share: float, epochs: float
) -> DataFrame:
    """``_source``, ``source_size``, ``weight`` and ``target``, a row for each source."""
    sizes = light.groupBy("_source").agg(F.sum("size").alias("source_size"))
    numbered = ranked(sizes, [F.col("_source").asc_nulls_last()], "_rank")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    sources = stored(
        light.sparkSession,
        numbered.withColumn("weight", F.get(turn, F.col("_rank") % len(weights))).drop("_rank"),
        "mix-sources",
    )
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    return water_fill(sources, share * words, epochs)


def _extra_until(light: DataFrame, targets: DataFrame) -> DataFrame:
    """A row for each source (``_s``): whole epochs, and the last document to be used once more.

    The seeded order is cut into slices by its first digits. Sums of slices find the slice in
    which the fraction ends; only its documents are then added up one by one, so a source with
    a third of all rows is no task of its own.
    """
    size, target = F.col("source_size"), F.col("target")
    whole = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("int")
    sources = targets.withColumn("_whole", whole).withColumn(
        "_quota", target - F.col("_whole") * size
    )
    cut = F.conv(F.substring("_order", 1, 3), 16, 10).cast("int")
    slices = light.groupBy("_source", cut.alias("_slice")).agg(F.sum("size").alias("_words"))
    in_source = Window.partitionBy("_source").orderBy("_slice")  # _SLICES rows at most
    earlier = in_source.rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
    # the last slice that begins within the quota; one that begins right at it adds nothing
    ends = (
        slices.alias("s")
        .join(sources.alias("t"), F.expr("s._source <=> t._source"))
        .filter(F.col("s._before") < F.col("t._quota"))
        .groupBy(F.col("t._source").alias("_s"))
        .agg(
            F.max_by("s._slice", "s._slice").alias("_at"),
            F.max_by("s._before", "s._slice").alias("_begun"),
            F.first("t._quota").alias("_quota"),
        )
    )
    inside = light.withColumn("_slice", cut).join(
        ends, F.expr("_source <=> _s AND _slice = _at"), "inner"
    )
    by_order = Window.partitionBy("_s").orderBy("_order", "size", "_tie")
    running = F.sum("size").over(by_order.rowsBetween(Window.unboundedPreceding, 0))
    reached = F.col("_begun") + running - F.col("size") / 2 <= F.col("_quota")
    inside = inside.withColumn("_reached", reached).filter("_reached")
    position = F.struct("_order", "size", "_tie")
    # where no document of that slice is reached, all of the earlier slices still are
    lasts = inside.groupBy("_s").agg(F.max(position).alias("_last"))
    floor = F.lpad(F.lower(F.hex("_at")), 3, "0")
    return (
        sources.withColumnRenamed("_source", "_s")
        .join(
            ends.select(F.col("_s").alias("_e"), "_at"), F.expr("_s <=> _e"), "left"
        )
        .join(lasts.withColumnRenamed("_s", "_l"), F.expr("_s <=> _l"), "left")
        .select(
            "_s",
            "source_size",
            "target",
            "_whole",
            F.coalesce("_last._order", floor).alias("_last_order"),
            F.coalesce("_last.size", F.lit(-1)).cast("long").alias("_last_size"),
            F.coalesce("_last._tie", F.lit(0)).alias("_last_tie"),
        )
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as many times as it is used, with its own columns only."""
    named = {k: options.pop(k, k) for k in ("doc_id", "text", "source")}
    found = mix(packed(docs, **named), **options).filter("copies > 0")
    return found.select("_row", F.explode(F.array_repeat(F.lit(0), "copies"))).select("_row.*")
