"""Helpers shared by the operators: bounded Arrow batches, row numbers without one big task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.session import stored

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# the words of the contracts: runs of anything but ASCII white space
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """Texts may be very long, so a batch on its way to a Python worker holds few of them."""
    if int(spark.conf.get(BATCH_ROWS)) > rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def word_count(text: Column) -> Column:
    """Number of words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame less columns that an operator is about to add, however they are capitalised."""
    taken = {name.lower() for name in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def packed(df: DataFrame, **named: str) -> DataFrame:
    """The rows as a struct ``_row`` next to the columns an operator works with, under its names.

    So no column of the input can be taken for one of the operator's own. ``unpacked`` names
    the columns to hand back.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(row.alias("_row"), *[F.col(c).alias(k) for k, c in named.items()])


def unpacked(df: DataFrame, *names: str) -> list[Column]:
    """Columns of the packed rows, less those an operator is about to add."""
    taken = {name.lower() for name in names}
    own = df.schema["_row"].dataType.names
    return [F.col(f"_row.`{c}`") for c in own if c.lower() not in taken]


def ranked(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows numbered from 0 in a global order, without sorting all of them in one task.

    Each range partition numbers its own rows; the counts of the partitions before it, one
    number for each partition, are added afterwards. The frame is stored in between, because
    a range partitioning computed twice need not fall out the same.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(
        df.sparkSession, sorted_rows.withColumn("_n", F.monotonically_increasing_id()), "ranked"
    )
    part, within = F.shiftright("_n", 33), F.col("_n").bitwiseAND((1 << 33) - 1)
    counts = numbered.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    before, offsets = 0, []
    for row in counts:
        offsets += [F.lit(row["_part"]), F.lit(before)]
        before += row["count"]
    base = F.create_map(*offsets)[part] if offsets else F.lit(0)
    return numbered.withColumn(name, (base + within).cast("long")).drop("_n")
