"""Differences between two snapshots of a table that is pulled whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEW, CHANGED, GONE, SAME = "new", "changed", "gone", "same"


def row_hash(df: DataFrame, columns: Sequence[str]):
    """Hash of a row's values. A NULL hashes as nothing at all, so each is marked besides."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def compare(old: DataFrame, new: DataFrame, key: str, leave_out: Sequence[str] = ()) -> DataFrame:
    """``key`` and ``change`` of every key of either snapshot: new, changed, gone or same.

    Both are unique on the key; rows without one are passed over. Columns of ``leave_out`` do not
    count as a change. Only keys and hashes are joined.
    """
    columns = [c for c in new.columns if c != key and c not in leave_out]
    sides = [
        df.filter(F.col(key).isNotNull()).select(key, row_hash(df, columns).alias(name))
        for df, name in ((old, "_old"), (new, "_new"))
    ]
    change = (
        F.when(F.col("_old").isNull(), NEW)
        .when(F.col("_new").isNull(), GONE)
        .when(F.col("_old") != F.col("_new"), CHANGED)
        .otherwise(SAME)
    )
    return sides[0].join(sides[1], key, "full").select(key, change.alias("change"))


def to_publish(new: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The rows of the new snapshot that are new or changed."""
    differing = changes.filter(F.col("change").isin(NEW, CHANGED)).select(key)
    return new.join(differing, key, "left_semi").select(*new.columns)
