"""Upsert by key as delete-matching plus insert-all, on plain frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def keyed(staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staging without the rows that have no key."""
    return staging.filter(_all_present(keys))


def delete_matching(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in staging; a NULL key matches nothing and stays.

    Rows without a key go round the join, which would send all of them to one task.
    """
    with_key = target.filter(_all_present(keys))
    left = with_key.join(keyed(staging, keys).select(*keys), list(keys), "left_anti")
    return left.select(*target.columns).unionByName(target.filter(~_all_present(keys)))


def matching(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is in staging: the rows an upsert replaces."""
    return target.join(keyed(staging, keys).select(*keys), list(keys), "left_semi").select(
        *target.columns
    )


def touched_parts(
    target: DataFrame, staging: DataFrame, keys: Sequence[str], part: str
) -> DataFrame:
    """Values of the partition column that an upsert changes, with ``n_rows`` that are why.

    They are those of the staged rows and of the target's older versions of them, as a row may
    move. Of the target only keys and the partition column are read.
    """
    staged = keyed(staging, keys)
    held = target.select(*dict.fromkeys((*keys, part)))
    changed = matching(held, staged, keys).select(part).unionByName(staged.select(part))
    return changed.groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"))


def in_parts(target: DataFrame, touched: DataFrame, part: str) -> DataFrame:
    """Target rows of the touched partitions; a NULL of the partition column matches nothing.

    Spark prunes the partitions when the query runs: no value passes the driver, and there may
    be as many as there are. It does so only below the broadcast threshold, and only where it
    sees a filter on the other side.
    """
    values = touched.filter(F.col("n_rows") > 0).select(part)
    return target.join(values, part, "left_semi").select(*target.columns)


def not_older(
    staging: DataFrame, held: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Staging rows at least as new as the held row of their key; NULLs rank last.

    ``held`` is unique on the keys and no larger than staging, see ``matching``.
    """
    versions = [F.col(c).alias(f"_held_{c}") for c in order]
    old = held.select(*keys, *versions, F.lit(1).alias("_held"))
    ahead, equal = F.col("_held").isNull(), F.lit(True)
    for c in order:
        new, before = F.col(c), F.col(f"_held_{c}")
        higher = (new > before) | (new.isNotNull() & before.isNull())
        ahead = ahead | (equal & F.coalesce(higher, F.lit(False)))
        equal = equal & new.eqNullSafe(before)
    joined = staging.join(old, list(keys), "left")
    return joined.filter(ahead | equal).select(*staging.columns)


def upsert(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target after the load: untouched rows and every keyed staging row."""
    return delete_matching(target, staging, keys).unionByName(keyed(staging, keys))
