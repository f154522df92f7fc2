"""High-water marks of an incremental pull.

What has landed was fetched already, so every landed row above its mark is taken, whatever page
it is on. Frames: *rows* hold ``media_id`` and a time column; *marks* hold ``endpoint``,
``media_id`` and ``high_water`` (text, one row per endpoint and video).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.functions import columns as C
from reelstar.operators.joins import lookup_join


def marks_of(marks: DataFrame, endpoint: str, compare: str = "parsed") -> DataFrame:
    """Marks of one endpoint; empty and sentinel marks count as none."""
    return marks.filter(F.col("endpoint") == endpoint).select(
        "media_id", C.high_water(F.col("high_water"), compare).alias("_mark")
    )


def with_marks(
    rows: DataFrame, marks: DataFrame, endpoint: str, ts: str, compare: str = "parsed"
) -> DataFrame:
    """Rows plus ``_ts`` (comparable time), ``_mark`` and ``_is_new``."""
    joined = lookup_join(rows, marks_of(marks, endpoint, compare), "media_id", spread_by=ts)
    return joined.withColumn("_ts", C.comparable(F.col(ts), compare)).withColumn(
        "_is_new", C.is_new(F.col("_ts"), F.col("_mark"))
    )


def incremental_filter(
    rows: DataFrame, marks: DataFrame, endpoint: str, ts: str, compare: str = "parsed"
) -> DataFrame:
    marked = with_marks(rows, marks, endpoint, ts, compare)
    return marked.filter("_is_new").select(*rows.columns)


def late_rows(
    rows: DataFrame, marks: DataFrame, endpoint: str, ts: str, compare: str = "parsed"
) -> DataFrame:
    """What the filter leaves out, with the mark that did it."""
    marked = with_marks(rows, marks, endpoint, ts, compare)
    return marked.filter(~F.col("_is_new")).select(*rows.columns, F.col("_mark").alias("mark"))


def next_marks(
    marked: DataFrame, marks: DataFrame, endpoint: str, compare: str = "parsed"
) -> DataFrame:
    """Marks of the endpoint after the pull: the newest time of all rows, see ``with_marks``.

    A mark never moves back. A video without new times keeps its mark.
    """
    seen = (
        marked.groupBy("media_id")
        .agg(F.max("_ts").alias("_seen"))
        .filter(F.col("_seen").isNotNull())
    )
    joined = seen.join(marks_of(marks, endpoint, compare), "media_id", "full")
    newest = F.greatest("_seen", "_mark")
    text = newest if compare == "text" else C.iso_timestamp(newest)
    return joined.filter(newest.isNotNull()).select(
        F.lit(endpoint).alias("endpoint"), "media_id", text.alias("high_water")
    )
