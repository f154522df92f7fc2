"""Exact distinct visitors as mergeable state: bitmaps over dense visitor numbers.

Every visitor gets a number when first seen. A bitmap block holds which of 32,768 numbers watched
a video on a day; blocks of any days and videos are merged by a bitwise OR, and counted by
their bits, so a distinct count over a range reads neither the fact nor a visitor key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstar.operators.joins import lookup_join
from reelstar.schemas import columns

# numbers that one bitmap covers: the size of Spark's bitmap aggregates
BLOCK = 32768
# numbers are given out in so many rows at once, each by a task of its own
ROWS = 1024

NUMBERS = columns("visitor_key string, visitor_no long")
VISITOR_DAYS = columns("event_date date, media_id string, block long, bits binary")


def new_numbers(facts: DataFrame, numbers: DataFrame) -> DataFrame:
    """Numbers for the visitors of ``facts`` that have none.

    A visitor belongs to one of many rows by a hash of its key; the k-th visitor of row *r* gets
    ``k * ROWS + r``. Rows fill evenly, so numbers stay dense, and no task numbers all visitors.
    """
    row = F.pmod(F.xxhash64("visitor_key"), F.lit(ROWS)).alias("row")
    seen = facts.filter(F.col("visitor_key").isNotNull()).select("visitor_key").distinct()
    unknown = seen.join(numbers, "visitor_key", "left_anti").select("visitor_key", row)
    used = numbers.groupBy((F.col("visitor_no") % ROWS).alias("row")).agg(
        F.max(F.expr(f"visitor_no div {ROWS}")).alias("last")
    )
    place = F.row_number().over(Window.partitionBy("row").orderBy("visitor_key"))
    numbered = unknown.join(used, "row", "left").withColumn("place", place)
    number = (F.coalesce("last", F.lit(-1)) + F.col("place")) * ROWS + F.col("row")
    return numbered.select("visitor_key", number.cast("long").alias("visitor_no"))


def visitor_days(facts: DataFrame, numbers: DataFrame) -> DataFrame:
    """Bitmaps of the visitors of each day and video; events without a visitor set no bit."""
    seen = facts.select("event_date", "media_id", "visitor_key").filter("visitor_key IS NOT NULL")
    placed = lookup_join(seen, numbers, "visitor_key", "inner")
    return placed.groupBy(
        "event_date", "media_id", F.expr(f"visitor_no div {BLOCK}").alias("block")
    ).agg(F.bitmap_construct_agg(F.col("visitor_no") % BLOCK).alias("bits"))


def distinct_visitors(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``unique_visitors`` of the given bitmaps, by columns that stand next to them."""
    blocks = days.groupBy(*by, "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = blocks.groupBy(*by) if by else blocks.groupBy()
    total = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("unique_visitors")
    return counts.agg(total)
