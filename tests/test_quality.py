from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reelstar.operators import quality
from reelstar.sources import silver


def media(spark, rows=(("m1", "n", "YouTube"),)):
    df = spark.createDataFrame(list(rows), "media_id string, name string, channel string")
    return df.withColumn("created_at", F.current_timestamp())


def visitors(spark, n=10, without_browser=0):
    return spark.range(n).select(
        F.col("id").cast("string").alias("visitor_key"),
        F.when(F.col("id") >= without_browser, "F").alias("browser"),
        F.lit("mac").alias("platform"),
    )


def facts(spark, rows=(("e1", "m1", "v1"),)):
    df = spark.createDataFrame(list(rows), "event_key string, media_id string, visitor_key string")
    return df.withColumn("event_date", F.current_date()).withColumn("percent_viewed", F.lit(0.5))


def failures(tables, **kw):
    report = quality.quality_report(tables, **kw)
    return {(r["table"], r["check"], r["column"]) for r in report.filter("status = 'fail'").collect()}


def all_good(spark):
    return {
        "dim_media": media(spark), "dim_visitor": visitors(spark),
        "fact_media_engagement": facts(spark),
    }


def test_clean_day_passes(spark):
    report = quality.quality_report(all_good(spark))
    assert tuple(report.columns) == quality.REPORT
    rows = quality.gate(report)
    assert {r["check"] for r in rows} == {
        "dropped_null_key", "min_rows", "required_column", "null_pct", "unique_key", "max_length",
        "orphan_media",
    }


def test_threshold_itself_passes_and_above_fails(spark):
    day = all_good(spark)
    assert failures({**day, "dim_visitor": visitors(spark, 10, 2)}) == set()
    assert failures({**day, "dim_visitor": visitors(spark, 10, 3)}) == {
        ("dim_visitor", "null_pct", "browser")
    }
    rows = [(f"e{i}", "m1", None if i == 0 else "v") for i in range(20)]
    assert failures({**day, "fact_media_engagement": facts(spark, rows)}) == set()
    rows = [(f"e{i}", "m1", None if i < 2 else "v") for i in range(20)]
    assert failures({**day, "fact_media_engagement": facts(spark, rows)}) == {
        ("fact_media_engagement", "null_pct", "visitor_key")
    }


def test_percentage_is_compared_unrounded(spark):
    # 5.004 percent rounds to 5.0, and still is above 5
    df = spark.range(100000).select(
        F.col("id").cast("string").alias("event_key"), F.lit("m1").alias("media_id"),
        F.when(F.col("id") >= 5004, "v").alias("visitor_key"),
        F.current_date().alias("event_date"), F.lit(0.1).alias("percent_viewed"),
    )
    day = {**all_good(spark), "fact_media_engagement": df}
    assert failures(day) == {("fact_media_engagement", "null_pct", "visitor_key")}


def test_rows_without_key_are_dropped_first(spark):
    day = all_good(spark)
    rows = [("m1", "n", "YouTube"), (None, None, None)]
    report = quality.quality_report({**day, "dim_media": media(spark, rows)})
    assert report.filter("status = 'fail'").count() == 0
    dropped = report.filter("check = 'dropped_null_key' AND table = 'dim_media'").first()
    assert dropped["value"] == 1.0
    only_nulls = {**day, "dim_media": media(spark, [(None, "n", "c")])}
    assert ("dim_media", "min_rows", None) in failures(only_nulls)


def test_missing_required_column_fails(spark):
    day = {**all_good(spark), "dim_visitor": visitors(spark).drop("platform")}
    assert failures(day) == {("dim_visitor", "required_column", "platform")}
    with pytest.raises(silver.MissingColumns, match="platform"):
        silver.check_columns(day["dim_visitor"], "dim_visitor", ("visitor_key", "platform"))


def test_duplicate_key_fails(spark):
    day = {**all_good(spark), "dim_media": media(spark, [("m1", "a", "b"), ("m1", "c", "d")])}
    assert failures(day) == {("dim_media", "unique_key", "media_id")}


def test_too_long_value_fails(spark):
    day = {**all_good(spark), "dim_media": media(spark, [("m1", "x" * 501, "c")])}
    assert failures(day) == {("dim_media", "max_length", "name")}
    day = {**all_good(spark), "dim_media": media(spark, [("m1", "x" * 500, "c")])}
    assert failures(day) == set()


def test_orphan_fails_unless_the_video_was_published_before(spark):
    day = {**all_good(spark), "fact_media_engagement": facts(spark, [("e1", "old", "v"), ("e2", None, "v")])}
    orphan = ("fact_media_engagement", "orphan_media", "media_id")
    # a fact without a video is a null, not an orphan
    null_media = ("fact_media_engagement", "null_pct", "media_id")
    assert failures(day) == {orphan, null_media}
    known = media(spark, [("old", "n", "c")]).select("media_id")
    assert failures(day, known_media=known) == {null_media}


def test_quiet_day_is_skipped(spark):
    day = {"fact_media_engagement": facts(spark), "dim_media": None}
    assert failures(day) == set()
    assert quality.quality_report({}) is None
    assert quality.gate(None) == []


def test_gate_names_what_failed(spark):
    day = {**all_good(spark), "dim_visitor": visitors(spark, 10, 3)}
    with pytest.raises(quality.QualityGateError, match="dim_visitor.browser null_pct=30.0") as error:
        quality.gate(quality.quality_report(day))
    assert len(error.value.failures) == 1


def test_empty_build_is_refused(spark, tmp_path):
    from reelstar.schemas import STAR

    nothing = spark.createDataFrame([], STAR["dim_media"])
    with pytest.raises(silver.EmptyTable):
        silver.write_silver(nothing, str(tmp_path), "dim_media")
