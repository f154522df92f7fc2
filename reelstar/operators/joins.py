"""Join shapes that stay balanced when a key is hot or missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.functions.columns import split_list

# keys that may be broadcast: the driver holds some 100 bytes of each
BROADCAST_ROWS = 250_000


def lookup_join(
    df: DataFrame, lookup: DataFrame, key: str, how: str = "left", spread_by: str | None = None
) -> DataFrame:
    """Equi-join of a large frame with a lookup that is unique on ``key``.

    Besides the key, both sides are joined by a hash of it. The matches are the same, but

    * with ``spread_by``, a row whose key is NULL hashes that column instead. Such rows match
      nothing, yet a plain join sends all of them to one task.
    * neither side can reuse an earlier partitioning by the key alone, so each gets a shuffle
      directly below the join. Only then can adaptive execution split a hot key, and nothing
      after the join groups that key's rows in one task to save a shuffle.

    Below the broadcast threshold there is no shuffle at all, and the hash costs next to nothing.
    """
    hashed = F.col(key) if spread_by is None else F.coalesce(F.col(key), F.col(spread_by))
    left = df.withColumn("_spread", F.xxhash64(hashed))
    right = lookup.filter(F.col(key).isNotNull()).withColumn("_spread", F.xxhash64(key))
    return left.join(right, [key, "_spread"], how).drop("_spread")


def shuffled_if_many(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A side of a join that is not to be broadcast if it has many rows, however small its files.

    Spark takes a column for its share of the file by width. Keys are compressed, and beside many
    columns a few megabytes of that share hold millions, which the driver would gather. The frame
    is counted unless ``rows`` is known, so pass one that was written before.
    """
    many = (df.count() if rows is None else rows) > BROADCAST_ROWS
    return df.hint("merge") if many else df


def tracked_only(df: DataFrame, tracked: str | DataFrame, key: str = "media_id") -> DataFrame:
    """Rows of the tracked videos: a comma-separated setting, or a frame of ids of any size."""
    if isinstance(tracked, str):
        return df.filter(F.col(key).isin(split_list(tracked)))
    return lookup_join(df, tracked.select(key), key, "left_semi").select(*df.columns)
