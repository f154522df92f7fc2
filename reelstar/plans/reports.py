"""The views and dashboard queries over the star.

``fact`` and ``dim_media`` are frames with at least the columns each report names. The dimension
is unique on media_id, so a report that groups by video aggregates first and joins the few
result rows afterwards; one that counts visitors per channel joins the facts themselves, by a
join that can split a hot video.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.functions import columns as C
from reelstar.operators.joins import lookup_join
from reelstar.operators.visitors import distinct_visitors
from reelstar.schemas import CHANNEL_WORDS, NO_CHANNEL


def engagement_daily(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    """Per day and video: visitors, events, average share viewed."""
    per_day = fact.groupBy("event_date", "media_id").agg(
        F.count_distinct("visitor_key").alias("unique_visitors"),
        F.count(F.lit(1)).alias("total_events"),
        F.avg("percent_viewed").alias("avg_percent_viewed"),
    )
    media = dim_media.select("media_id", "channel", F.col("name").alias("media_name"))
    return per_day.join(media, "media_id").select(
        "event_date", "channel", "media_id", "media_name",
        "unique_visitors", "total_events", "avg_percent_viewed",
    )


def top_countries(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    """Events and visitors per channel and country. Order it where it is shown."""
    placed = fact.filter(F.col("country").isNotNull()).select("media_id", "country", "visitor_key")
    return (
        lookup_join(placed, dim_media.select("media_id", "channel"), "media_id", "inner")
        .groupBy("channel", "country")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("visitor_key").alias("unique_visitors"),
        )
    )


def kpi_media(dim_media: DataFrame) -> DataFrame:
    return dim_media.agg(
        F.sum("total_plays").alias("total_plays"),
        F.sum("total_loads").alias("total_loads"),
        F.round(F.sum("hours_watched"), 1).alias("total_hours"),
    )


def kpi_fact(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("visitor_key").alias("unique_visitors"),
        C.avg_pct(F.col("percent_viewed"), 1).alias("avg_view_pct"),
    )


def channel_comparison(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    viewed = fact.select("media_id", "visitor_key", "percent_viewed")
    return (
        lookup_join(viewed, dim_media.select("media_id", "channel"), "media_id", "inner")
        .groupBy("channel")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("visitor_key").alias("unique_visitors"),
            C.avg_pct(F.col("percent_viewed"), 2).alias("avg_view_pct"),
        )
        .orderBy(F.desc("events"), "channel")
    )


def geo_top(fact: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` countries with most events; the name breaks ties."""
    return (
        fact.filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("visitor_key").alias("unique_visitors"),
            C.avg_pct(F.col("percent_viewed"), 2).alias("avg_view_pct"),
        )
        .orderBy(F.desc("events"), "country")
        .limit(k)
    )


def daily_trend(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    per_media = fact.groupBy("event_date", "media_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_media.join(dim_media.select("media_id", "channel"), "media_id")
        .groupBy("event_date", "channel")
        .agg(F.sum("n").alias("events"))
        .orderBy("event_date", "channel")
    )


def depth_histogram(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    per_media = fact.groupBy(
        "media_id", C.depth_bucket(F.col("percent_viewed")).alias("bucket_pct")
    ).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_media.join(dim_media.select("media_id", "channel"), "media_id")
        .groupBy("channel", "bucket_pct")
        .agg(F.sum("n").alias("events"))
        .orderBy("bucket_pct", "channel")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def register_views(star: dict[str, DataFrame]) -> None:
    """Temp views of the tables and the two reporting views, for SQL users."""
    for name, df in star.items():
        df.createOrReplaceTempView(name)
    fact, media = star["fact_media_engagement"], star["dim_media"]
    engagement_daily(fact, media).createOrReplaceTempView("v_engagement_daily")
    top_countries(fact, media).createOrReplaceTempView("v_top_countries")


def visitors_between(
    visitor_days: DataFrame, dim_media: DataFrame, first: str, last: str
) -> DataFrame:
    """Distinct visitors per channel from one day to another, from bitmaps instead of facts."""
    of_range = visitor_days.filter(F.col("event_date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
    # blocks of a video are merged before the join
    per_media = of_range.groupBy("media_id", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    placed = per_media.join(dim_media.select("media_id", "channel"), "media_id")
    return distinct_visitors(placed, ["channel"])


# Each reads the views of ``register_views``; a date range reaches the scan of the fact.
_BETWEEN = "f.event_date BETWEEN first_day AND last_day"
_TABLE_FUNCTIONS = {
    "geo_top(first_day DATE, last_day DATE, k INT)": (
        "country STRING, events BIGINT, unique_visitors BIGINT, avg_view_pct DOUBLE",
        f"""SELECT country, events, unique_visitors, avg_view_pct FROM (
              SELECT *, row_number() OVER (ORDER BY events DESC, country) AS place FROM (
                SELECT country, count(*) AS events, count(DISTINCT visitor_key) AS unique_visitors,
                       round(avg(percent_viewed) * 100, 2) AS avg_view_pct
                FROM fact_media_engagement f
                WHERE {_BETWEEN} AND country IS NOT NULL GROUP BY country)) WHERE place <= k""",
    ),
    "channel_comparison_between(first_day DATE, last_day DATE)": (
        "channel STRING, events BIGINT, unique_visitors BIGINT, avg_view_pct DOUBLE",
        f"""SELECT m.channel, count(*), count(DISTINCT f.visitor_key),
                   round(avg(f.percent_viewed) * 100, 2)
            FROM fact_media_engagement f JOIN dim_media m ON f.media_id = m.media_id
            WHERE {_BETWEEN} GROUP BY m.channel""",
    ),
    "daily_trend_between(first_day DATE, last_day DATE)": (
        "event_date DATE, channel STRING, events BIGINT",
        f"""SELECT f.event_date, m.channel, count(*)
            FROM fact_media_engagement f JOIN dim_media m ON f.media_id = m.media_id
            WHERE {_BETWEEN} GROUP BY f.event_date, m.channel""",
    ),
    "depth_between(first_day DATE, last_day DATE)": (
        "channel STRING, bucket_pct INT, events BIGINT",
        f"""SELECT m.channel, depth_bucket(f.percent_viewed), count(*)
            FROM fact_media_engagement f JOIN dim_media m ON f.media_id = m.media_id
            WHERE {_BETWEEN} GROUP BY ALL""",
    ),
    "countries_between(first_day DATE, last_day DATE)": (
        "channel STRING, country STRING, events BIGINT, unique_visitors BIGINT",
        f"""SELECT m.channel, f.country, count(*), count(DISTINCT f.visitor_key)
            FROM fact_media_engagement f JOIN dim_media m ON f.media_id = m.media_id
            WHERE {_BETWEEN} AND f.country IS NOT NULL GROUP BY m.channel, f.country""",
    ),
}


def register_functions(spark: SparkSession) -> None:
    """SQL functions of the session: ``derive_channel(title)``, ``depth_bucket(share)``, and the
    dashboard's reports as table functions of a date range; register the views first."""
    cases = " ".join(
        f"WHEN contains(lower(title), '{word}') THEN '{channel}'" for word, channel in CHANNEL_WORDS
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION derive_channel(title STRING) RETURNS STRING "
        f"RETURN CASE {cases} ELSE '{NO_CHANNEL}' END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION depth_bucket(share DECIMAL(10,6)) RETURNS INT "
        "RETURN CAST(floor(share * 10) * 10 AS INT)"
    )
    for head, (columns, body) in _TABLE_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS TABLE({columns}) RETURN {body}"
        )
