"""Newest row per key, and most frequent value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """One row per key: the one with the highest ``order`` columns, NULLs last.

    Ties fall to ``tie_break``; by default to a hash of the whole row, so the survivor does not
    depend on input order. Pass ``()`` where the feed never repeats an order value within a
    key: the window then needs no more columns than the caller selects.

    Spark turns the ``= 1`` filter into a group limit on both sides of the shuffle, so a key
    holding a third of the rows sends one row per map task, not its whole group.
    """
    if tie_break is None:
        tie_break = [F.xxhash64(*df.columns)]
    ranking = [F.col(c).desc_nulls_last() for c in order]
    ranking += [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in tie_break]
    newest_first = Window.partitionBy(*keys).orderBy(*ranking)
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def mode_by(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-null value of each column per key; the lowest value wins a tie.

    Counting by (key, column, value) first keeps a hot key spread over its values, and only
    one counter per value reaches the group of the key.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])
    )
    counts = (
        df.filter(F.col(key).isNotNull())
        .select(key, cells.alias("cell"))
        .select(key, "cell.name", "cell.value")
        .filter(F.col("value").isNotNull())
        .groupBy(key, "name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = F.struct((-F.col("n")).alias("rank"), F.col("value"))
    return counts.groupBy(key).agg(
        *[F.min(F.when(F.col("name") == c, ranked))["value"].alias(c) for c in columns]
    )
