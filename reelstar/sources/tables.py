"""Declared tables: the star and its staging twins in the session catalog.

The declaration carries the VARCHAR lengths, so Spark itself refuses a value that is too long, and
the layout: tables lie in sorted buckets of the column they are joined by, so that a fact is not
shuffled to meet its videos, nor a staged one to meet its visitors. A bucket is one task of such a
join, and a hot key lies in one bucket: where that is too much, read the published tables instead.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.operators.upsert import delete_matching, in_parts, keyed, touched_parts
from reelstar.schemas import BUCKET_BY, KEYS, LOAD_ORDER, MAX_LENGTH, PARTITION_BY, STAR
from reelstar.session import stored

BUCKETS = 16


def _columns(table: str, staging: bool) -> str:
    parts = []
    for field in STAR[table].fields:
        length = MAX_LENGTH[table].get(field.name)
        dtype = f"varchar({length})" if length else field.dataType.simpleString()
        required = " not null" if not field.nullable and not staging else ""
        parts.append(f"{field.name} {dtype}{required}")
    return ", ".join(parts)


def _bucket_column(name: str) -> str:
    return BUCKET_BY.get(name) or BUCKET_BY[name.removeprefix("stg_")]


def declare(
    spark: SparkSession, root: str, prefix: str | None = None, buckets: int = BUCKETS
) -> dict[str, str]:
    """Create the six tables under ``root`` if they do not exist, in so many buckets each.

    Returns the catalog name of every table and, under ``stg_`` + name, of its staging twin.
    """
    prefix = f"t{uuid.uuid4().hex[:12]}_" if prefix is None else prefix
    names = {}
    for table in LOAD_ORDER:
        for staging in (False, True):
            name = f"stg_{table}" if staging else table
            part = None if staging else PARTITION_BY.get(table)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({_columns(table, staging)}) "
                f"USING parquet {f'PARTITIONED BY ({part})' if part else ''} "
                f"CLUSTERED BY ({_bucket_column(name)}) SORTED BY ({_bucket_column(name)}) "
                f"INTO {buckets} BUCKETS "
                f"LOCATION '{root}/{name}'"
            )
            names[name] = f"{prefix}{name}"
    return names


def _dealt(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """Rows dealt as the buckets of a table are, so that a task writes one bucket's files."""
    return df.repartition(buckets, _bucket_column(name))


def fill_staging(
    names: dict[str, str], table: str, df: DataFrame, buckets: int = BUCKETS
) -> None:
    """Empty the staging table and load it by column position."""
    rows = _dealt(df.select(*STAR[table].names), f"stg_{table}", buckets)
    rows.write.insertInto(names[f"stg_{table}"], overwrite=True)


def insert_from_staging(
    spark: SparkSession, names: dict[str, str], table: str, buckets: int = BUCKETS
) -> None:
    """Upsert the keyed staging rows: rows of their keys are deleted first, so a second load of
    the same rows changes nothing.

    Columns go by name, as a partitioned table keeps its date last. A table without a date is
    rewritten whole. Of a partitioned one, the dates of the staged rows and of their older versions
    are, with the rows that have no date; other dates are neither read, but for the keys, nor
    written. A date that loses all its rows is dropped.
    """
    key, part = [KEYS[table]], PARTITION_BY.get(table)
    staging = keyed(spark.table(names[f"stg_{table}"]), key)
    target = spark.table(names[table])
    old = target
    if part:
        found = touched_parts(target, staging, key, part)
        touched = stored(spark, found, f"touched-{table}")
        undated = target.filter(F.col(part).isNull())
        old = in_parts(target, touched, part).unionByName(undated)
    kept = stored(spark, delete_matching(old, staging, key), f"kept-{table}")
    rows = kept.unionByName(staging.select(*target.columns))
    emptied = []
    if part:
        # found before the write, as staging and kept rows are all there will be
        left = rows.select(part).distinct()
        emptied = touched.join(left, touched[part].eqNullSafe(left[part]), "left_anti").collect()
    _dealt(rows, table, buckets).select(*target.columns).createOrReplaceTempView("_upserted")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    mode = "dynamic" if part else "static"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        spark.sql(f"INSERT OVERWRITE {names[table]} BY NAME SELECT * FROM _upserted")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        spark.catalog.dropTempView("_upserted")
    for row in emptied:
        value = "NULL" if row[part] is None else f"'{row[part]}'"
        spark.sql(f"ALTER TABLE {names[table]} DROP IF EXISTS PARTITION ({part}={value})")


def joins(spark: SparkSession, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The two joins that the layout serves: staged facts with the counters of their visitors, and
    published facts with the channel of their videos. Neither shuffles the facts."""
    staged, facts = spark.table(names["stg_fact_media_engagement"]), spark.table(names["fact_media_engagement"])
    people = spark.table(names["dim_visitor"]).select("visitor_key", "play_count", "load_count")
    media = spark.table(names["dim_media"]).select("media_id", "channel")
    counted = staged.drop("visitor_play_count", "visitor_load_count").join(people, "visitor_key", "left")
    return counted, facts.join(media, "media_id")
