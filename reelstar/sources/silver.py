"""Silver: one Parquet table per star table, partitioned by load_date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
)

from reelstar.schemas import STAR

# each type holds all values of those before it in its row
_WIDER = ((ByteType, ShortType, IntegerType, LongType), (FloatType, DoubleType))


class MissingColumns(ValueError):
    pass


class EmptyTable(ValueError):
    pass


class Narrowed(TypeError):
    """A later part has a type that cannot hold what an earlier one may."""


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def check_columns(df: DataFrame, table: str, required: tuple[str, ...]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns(f"{table}: missing required columns {missing}")


def write_silver(df: DataFrame, root: str, table: str) -> None:
    """Replace the load dates present in ``df``; other days stay.

    Every task of the last stage writes its own file, and adaptive execution merges small
    partitions first, so the build is never squeezed through one writer. Rows are counted on
    the way out; a build that produced none is an error.
    """
    written = Observation()
    observed = df.observe(written, F.count(F.lit(1)).alias("n"))
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("load_date")
        .parquet(table_path(root, table))
    )
    if written.get["n"] == 0:
        raise EmptyTable(f"{table}: produced 0 rows")


def read_silver(
    spark: SparkSession, root: str, table: str, run_date: str | None = None
) -> DataFrame | None:
    """A day of a table (or all days) in declared column order; None when there is none.

    The filter is on the partition column, so only that day's folder is scanned.
    """
    try:
        df = spark.read.schema(STAR[table]).parquet(table_path(root, table))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise
    if run_date is not None:
        df = df.filter(F.col("load_date") == F.to_date(F.lit(run_date)))
    df = df.select(*STAR[table].names)
    return None if df.isEmpty() else df


def widened(old: DataType, new: DataType, column: str) -> DataType:
    """The type of a later part if it holds all values of the earlier one's."""
    if old == new:
        return new
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        if new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale:
            return new
    for row in _WIDER:
        if type(old) in row and type(new) in row and row.index(type(old)) < row.index(type(new)):
            return new
    raise Narrowed(f"{column}: {old.simpleString()} became {new.simpleString()}")


def evolved_schema(schemas: Sequence[StructType]) -> StructType:
    """One schema for parts written one after another: columns in the order they first came,
    each in its widest type. A column that is gone stays, and reads as NULL in later parts."""
    found: dict[str, DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            old = found.get(field.name, field.dataType)
            found[field.name] = widened(old, field.dataType, field.name)
    return StructType([StructField(name, dtype) for name, dtype in found.items()])


def read_parts(spark: SparkSession, parts: Sequence[str]) -> DataFrame:
    """Parts of a table, oldest first, whose columns may have changed on the way.

    A part's schema is that of its files; part names are days or folders, a short list. All parts
    are one scan under the evolved schema: a column that a part lacks reads as NULL, and Parquet
    widens a narrower type while reading. A type that became narrower fails the read before it
    begins.
    """
    schema = evolved_schema([spark.read.parquet(part).schema for part in parts])
    return spark.read.schema(schema).parquet(*parts)
