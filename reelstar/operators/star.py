"""Build the two dimensions and the fact from bronze frames.

An optional source that did not arrive is passed as an empty frame with its schema: the same
left join then fills its columns with typed NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstar.functions import columns as C
from reelstar.operators.joins import lookup_join
from reelstar.operators.latest import latest_by, mode_by
from reelstar.schemas import BROKEN, CHANNEL_WORDS, STAR

# target column, bronze field, type
MEDIA_FIELDS = (
    ("media_id", "hashed_id", "string"),
    ("name", "name", "string"),
    ("duration_seconds", "duration", "decimal(10,3)"),
    ("created_at", "created", "timestamp"),
    ("updated_at", "updated", "timestamp"),
    ("status", "status", "string"),
    ("project_name", "project.name", "string"),
    ("section_name", "section", "string"),
)
STATS_FIELDS = (
    ("media_id", "media_id", "string"),
    ("total_plays", "play_count", "bigint"),
    ("total_loads", "load_count", "bigint"),
    ("play_rate", "play_rate", "decimal(10,6)"),
    ("hours_watched", "hours_watched", "decimal(14,6)"),
    ("total_visitors", "visitors", "bigint"),
    ("engagement", "engagement", "decimal(10,6)"),
)
VISITOR_FIELDS = (
    ("visitor_key", "visitor_key", "string"),
    ("first_seen_at", "created_at", "timestamp"),
    ("last_active_at", "last_active_at", "timestamp"),
    ("load_count", "load_count", "int"),
    ("play_count", "play_count", "int"),
    ("browser", "user_agent_details.browser", "string"),
    ("browser_version", "user_agent_details.browser_version", "string"),
    ("platform", "user_agent_details.platform", "string"),
    ("is_mobile", "user_agent_details.mobile", "boolean"),
)
EVENT_FIELDS = (
    ("event_key", "event_key", "string"),
    ("media_id", "media_id", "string"),
    ("visitor_key", "visitor_key", "string"),
    ("received_at", "received_at", "timestamp"),
    ("ip", "ip", "string"),
    ("country", "country", "string"),
    ("region", "region", "string"),
    ("city", "city", "string"),
    ("lat", "lat", "decimal(10,6)"),
    ("lon", "lon", "decimal(10,6)"),
    ("percent_viewed", "percent_viewed", "decimal(10,6)"),
    ("embed_url", "embed_url", "string"),
    ("media_name", "media_name", "string"),
    ("browser", "user_agent_details.browser", "string"),
    ("platform", "user_agent_details.platform", "string"),
    ("is_mobile", "user_agent_details.mobile", "boolean"),
)
_EVENT_DAY = ("event_date", "event_date", "date")
FIELDS = {
    "media_metadata": MEDIA_FIELDS,
    "media_stats": STATS_FIELDS,
    "visitors": VISITOR_FIELDS,
    "events": EVENT_FIELDS,
}

TieBreak = Sequence[str | Column] | None


def _casts(fields: Sequence[tuple[str, str, str]]) -> list[str]:
    return [f"{C.safe_cast(src, dtype)} AS {dst}" for dst, src, dtype in fields]


def project(raw: DataFrame, fields: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rename, flatten and cast in one select."""
    return raw.selectExpr(*_casts(fields))


def in_star_order(df: DataFrame, table: str) -> DataFrame:
    """Select by name in the declared order and check the types that came out."""
    schema = STAR[table]
    out = df.select(*schema.names)
    wrong = [
        (got.name, got.dataType.simpleString(), want.dataType.simpleString())
        for got, want in zip(out.schema.fields, schema.fields)
        if got.dataType != want.dataType
    ]
    if wrong:
        raise TypeError(f"{table}: column types differ from the declaration: {wrong}")
    return out


def _load_date(run_date: str) -> Column:
    return F.to_date(F.lit(run_date))


def build_dim_media(
    metadata: DataFrame,
    stats: DataFrame,
    run_date: str,
    tie_break: TieBreak = None,
    channel_words: Sequence[tuple[str, str]] = CHANNEL_WORDS,
) -> DataFrame:
    """One row per video: metadata, derived channel, and its statistics where there are any.

    Both sides are reduced to one row per media_id on the join key, so the join reuses their
    partitioning and adds no shuffle.
    """
    media = project(metadata, MEDIA_FIELDS).filter(F.col("media_id").isNotNull())
    media = latest_by(media, ["media_id"], ["updated_at"], tie_break)
    media = media.withColumn("channel", C.channel_of(F.col("name"), channel_words))
    # a rerun may land a second statistics document; counters only grow, keep the highest
    counters = project(stats, STATS_FIELDS).filter(F.col("media_id").isNotNull())
    counters = latest_by(counters, ["media_id"], ["total_plays", "total_loads"], tie_break)
    joined = media.join(counters, "media_id", "left")
    return in_star_order(joined.withColumn("load_date", _load_date(run_date)), "dim_media")


def latest_visitors(visitors: DataFrame, tie_break: TieBreak = None) -> DataFrame:
    known = project(visitors, VISITOR_FIELDS).filter(F.col("visitor_key").isNotNull())
    return latest_by(known, ["visitor_key"], ["last_active_at"], tie_break)


def visitor_geo(events: DataFrame, geo: str = "latest", tie_break: TieBreak = None) -> DataFrame:
    """Where a visitor watches from: the newest event's place, or the most frequent one.

    The address is the newest event's in both cases.
    """
    places = events.select(
        "visitor_key", "country", "region", "city",
        F.col("ip").alias("last_ip"),
        F.col("received_at").try_cast("timestamp").alias("_seen_at"),
    ).filter(F.col("visitor_key").isNotNull())
    newest = latest_by(places, ["visitor_key"], ["_seen_at"], tie_break).drop("_seen_at")
    if geo == "latest":
        return newest
    if geo == "mode":
        usual = mode_by(places, "visitor_key", ("country", "region", "city"))
        return newest.select("visitor_key", "last_ip").join(usual, "visitor_key", "left")
    raise ValueError(f"unknown geo rule {geo!r}")


def build_dim_visitor(
    visitors: DataFrame,
    events: DataFrame,
    run_date: str,
    geo: str = "latest",
    tie_break: TieBreak = None,
) -> DataFrame:
    """One row per visitor with the newest snapshot and a place taken from the events."""
    people = latest_visitors(visitors, tie_break)
    joined = people.join(visitor_geo(events, geo, tie_break), "visitor_key", "left")
    return in_star_order(joined.withColumn("load_date", _load_date(run_date)), "dim_visitor")


def clean_events(
    events: DataFrame, date_rule: str = "source_local", tie_break: TieBreak = None
) -> DataFrame:
    """Typed events with both keys present, the newest delivery of each."""
    day = C.event_date(F.col("received_at"), date_rule)
    typed = project(events.withColumn("event_date", day), (*EVENT_FIELDS, _EVENT_DAY))
    keyed = typed.filter(F.col("event_key").isNotNull() & F.col("media_id").isNotNull())
    return latest_by(keyed, ["event_key"], ["received_at"], tie_break)


def visitor_counts(people: DataFrame) -> DataFrame:
    return people.select(
        "visitor_key",
        F.col("play_count").alias("visitor_play_count"),
        F.col("load_count").alias("visitor_load_count"),
    )


def build_fact(
    events: DataFrame,
    people: DataFrame,
    run_date: str,
    date_rule: str = "source_local",
    tie_break: TieBreak = None,
) -> DataFrame:
    """One row per event with the visitor's counters.

    ``people`` is unique on visitor_key: the latest visitors of the day, the day's
    ``dim_visitor``, or the accumulated one.
    """
    facts = clean_events(events, date_rule, tie_break)
    facts = lookup_join(facts, visitor_counts(people), "visitor_key", spread_by="event_key")
    return in_star_order(
        facts.withColumn("load_date", _load_date(run_date)), "fact_media_engagement"
    )


def cast_counters(resource: str) -> dict[str, Column]:
    """Per typed column: how many present values do not fit, as aggregates over the raw frame."""
    return {
        dst: F.expr(f"count_if({C.cast_failed(src, dtype)})").alias(dst)
        for dst, src, dtype in FIELDS[resource]
        if dtype != "string"
    }


# what a row needs to enter its table
ROW_KEYS = {
    "media_metadata": ("dim_media", ("hashed_id",)),
    "visitors": ("dim_visitor", ("visitor_key",)),
    "events": ("fact_media_engagement", ("event_key", "media_id")),
}


def row_counters(raw: DataFrame, resource: str) -> list[Column]:
    """Aggregates over a raw frame: rows, rows without a key, and broken documents.

    A broken document is no row without a key; it is counted apart.
    """
    intact = F.col(BROKEN).isNull() if BROKEN in raw.columns else F.lit(True)
    keys = ROW_KEYS[resource][1] if resource in ROW_KEYS else ()
    lacking = F.lit(False)
    for key in keys:
        lacking = lacking | F.col(key).isNull()
    return [
        F.count_if(intact).alias("_rows"),
        F.count_if(intact & lacking).alias("_no_key"),
        F.count_if(~intact).alias("_broken"),
    ]


def cast_failures(raw: DataFrame, resource: str) -> DataFrame:
    """Values per field that were present but did not fit the target type, in one pass."""
    typed = [field for field in FIELDS[resource] if field[2] != "string"]
    counts = raw.selectExpr(
        *[f"count_if({C.cast_failed(src, dtype)}) AS {dst}" for dst, src, dtype in typed]
    )
    lines = ", ".join(
        f"('{resource}', '{dst}', '{dtype}', CAST({dst} AS bigint))" for dst, _, dtype in typed
    )
    return counts.selectExpr(f"inline(array({lines})) AS (resource, column, type, failed)")
