"""Fields of raw documents, read as VARIANT: which are new, gone, or of another type.

The typed scan gives NULL for a field that no document has any more, and drops one it does not
know. So the fields themselves are taken from the documents, and compared by resource and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from reelstar.operators.quality import build_line
from reelstar.schemas import REQUIRED_FIELDS

NEW, GONE, RETYPED, SAME = "new", "gone", "type", "same"


def field_kinds(documents: DataFrame) -> DataFrame:
    """``resource``, ``day``, ``field``, ``kind`` and the number of documents that have it.

    ``documents`` has ``resource``, ``day`` and ``doc``, a VARIANT object. Kinds are STRING, NUMBER,
    BOOLEAN, OBJECT, ARRAY and VOID (a JSON null). One pass, partly aggregated before its shuffle.
    """
    fields = documents.lateralJoin(
        documents.sparkSession.tvf.variant_explode(F.col("doc").outer())
    ).select("resource", "day", F.col("key").alias("field"), F.schema_of_variant("value").alias("type"))
    plain = F.regexp_extract("type", "^[A-Z]+", 0)
    kind = F.when(plain.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").otherwise(plain)
    return fields.groupBy("resource", "day", "field", kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("documents")
    )


def drift(kinds: DataFrame, old_day: str, new_day: str) -> DataFrame:
    """Fields of a resource that differ between two days: ``resource``, ``field``, ``change``, the
    kinds of both days, and the documents that have the field on the new one.

    A JSON null is of any type. A resource that is missing on one of the days is not compared.
    """

    def of(day: str, name: str) -> list[Column]:
        there = F.col("day") == day
        known = F.collect_set(F.when(there & (F.col("kind") != "VOID"), F.col("kind")))
        documents = F.sum(F.when(there, F.col("documents")))
        kinds_there = F.when(documents.isNotNull(), F.array_join(F.array_sort(known), "|"))
        return [kinds_there.alias(f"{name}_kinds"), documents.alias(f"{name}_documents")]

    fields = kinds.filter(F.col("day").isin(old_day, new_day)).groupBy("resource", "field")
    joined = fields.agg(*of(old_day, "old"), *of(new_day, "new"))
    # a resource has few fields; both days must have some of them
    resource = Window.partitionBy("resource")
    for name in ("old", "new"):
        joined = joined.withColumn(f"{name}_any", F.max(f"{name}_documents").over(resource))
    joined = joined.filter("old_any IS NOT NULL AND new_any IS NOT NULL")
    empty = (F.col("old_kinds") == "") | (F.col("new_kinds") == "")
    change = (
        F.when(F.col("old_documents").isNull(), NEW)
        .when(F.col("new_documents").isNull(), GONE)
        .when(~empty & (F.col("old_kinds") != F.col("new_kinds")), RETYPED)
        .otherwise(SAME)
    )
    return joined.select(
        "resource", "field", change.alias("change"), "old_kinds", "new_kinds",
        F.coalesce("new_documents", F.lit(0)).alias("documents"),
    ).filter(F.col("change") != SAME)


def required_lines(kinds: DataFrame, day: str) -> list[Row]:
    """A report line for every required field of the day's resources: the documents that have it,
    failing at none. One row a field reaches the driver."""
    found: dict[str, dict[str, int]] = {}
    of_day = kinds.filter(F.col("day") == day).groupBy("resource", "field")
    for r in of_day.agg(F.sum("documents").alias("n")).collect():
        found.setdefault(r["resource"], {})[r["field"]] = r["n"]
    return [
        build_line(resource, "required_field", field, fields.get(field, 0), 0, int(field not in fields))
        for resource, fields in sorted(found.items())
        for field in REQUIRED_FIELDS.get(resource, ())
    ]
