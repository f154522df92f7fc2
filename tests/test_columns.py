from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from reelstar.functions import columns as C


def one(spark, values, schema, expr):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(F.expr(expr) if isinstance(expr, str) else expr).collect()]


def test_channel(spark):
    names = [
        "Spring sale cut 3 Youtube Paid Ads",
        "Spring sale cut 3 Facebook Paid Ads",
        "Spring sale, long version",
        "SALE YOUTUBE",
        "facebook and youtube",
        None,
    ]
    got = one(spark, names, "name string", C.channel_of(F.col("name")))
    assert got == ["YouTube", "Facebook", "Unknown", "YouTube", "YouTube", "Unknown"]


def test_media_id_from_path(spark):
    path = "s3a://lake/media_stats/year=2026/month=04/day=20/media_id=ab12/ab12.json"
    got = one(spark, [path, "no/id/here"], "p string", C.media_id_from_path(F.col("p")))
    assert got == ["ab12", ""]


def test_depth_bucket(spark):
    shares = ["0", "0.099999", "0.1", "0.55", "0.999999", "1", None]
    df = spark.createDataFrame([(s,) for s in shares], "s string")
    bucket = C.depth_bucket(F.col("s").cast("decimal(10,6)"))
    assert [r[0] for r in df.select(bucket).collect()] == [0, 0, 10, 50, 90, 100, None]


def test_whole_number_casts(spark):
    values = ["12", "12.0", "12.7", "-12.7", "abc", "", "3000000000", "9223372036854775807", None]
    as_int = one(spark, values, "v string", C.safe_cast("v", "int"))
    assert as_int == [12, 12, 12, -12, None, None, None, None, None]
    as_long = one(spark, values[-3:], "v string", C.safe_cast("v", "bigint"))
    assert as_long == [3000000000, 9223372036854775807, None]


def test_failed_casts_are_told_from_missing_values(spark):
    values = ["1.5", "x", "123456789", None]
    got = one(spark, values, "v string", C.cast_failed("v", "decimal(10,6)"))
    assert got == [False, True, True, False]


def test_event_date_rules(spark):
    times = ["2026-04-20T23:30:00-05:00", "2026-04-20T10:00:00Z", "junk", None]
    local = one(spark, times, "t string", C.event_date(F.col("t")))
    utc = one(spark, times, "t string", C.event_date(F.col("t"), "utc"))
    april = lambda day: dt.date(2026, 4, day)
    assert local == [april(20), april(20), None, None]
    assert utc == [april(21), april(20), None, None]


def test_allow_list_text():
    assert C.split_list(" a, b ,,c ,") == ["a", "b", "c"]
    assert C.split_list("") == []


def test_iso_keeps_microseconds(spark):
    df = spark.sql("SELECT timestamp'2024-01-02 03:04:05.678901' AS t")
    assert df.select(C.iso_timestamp(F.col("t"))).first()[0] == "2024-01-02T03:04:05.678901Z"


def test_a_third_channel(spark):
    names = spark.createDataFrame([("TikTok via youtube",), ("tiktok",), ("radio",), (None,)], "name string")
    words = (("tiktok", "TikTok"), ("youtube", "YouTube"))
    got = [r[0] for r in names.select(C.channel_of(F.col("name"), words)).collect()]
    assert got == ["TikTok", "TikTok", "Unknown", "Unknown"]
