"""Schemas, keys and rules of the bronze resources and the star.

Bronze leaves are read as STRING: a feed may send a number as text or text where a number
belongs, and the star build casts without raising, so drift shows up in the quality report
and not as a failed scan.
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def columns(spec: str, required: tuple[str, ...] = (), **nested: StructType) -> StructType:
    """StructType from ``name type`` pairs; built without a running session, unlike fromDDL."""
    struct = StructType()
    for pair in spec.split(", "):
        name, dtype = pair.split(" ")
        struct = struct.add(name, nested.get(dtype, dtype), name not in required)
    return struct


_AGENT = columns("browser string, browser_version string, platform string, mobile string")

# The fields of the raw documents, and below those of the star.
RAW = {
    "media_metadata": columns(
        "hashed_id string, name string, duration string, created string, updated string, "
        "status string, project project, section string",
        project=columns("name string"),
    ),
    # an API document carries no media id, the bronze scan takes it from the path
    "media_stats": columns(
        "media_id string, play_count string, load_count string, play_rate string, "
        "hours_watched string, visitors string, engagement string"
    ),
    "visitors": columns(
        "visitor_key string, created_at string, last_active_at string, load_count string, "
        "play_count string, user_agent_details agent",
        agent=_AGENT,
    ),
    "events": columns(
        "event_key string, media_id string, visitor_key string, received_at string, ip string, "
        "country string, region string, city string, lat string, lon string, "
        "percent_viewed string, embed_url string, media_name string, user_agent_details agent",
        agent=_AGENT,
    ),
}

# Column order is part of the contract: staging loads map by position.
STAR = {
    "dim_media": columns(
        "media_id string, name string, duration_seconds decimal(10,3), created_at timestamp, "
        "updated_at timestamp, status string, project_name string, section_name string, "
        "channel string, total_plays long, total_loads long, play_rate decimal(10,6), "
        "hours_watched decimal(14,6), total_visitors long, engagement decimal(10,6), "
        "load_date date",
        required=("media_id",),
    ),
    "dim_visitor": columns(
        "visitor_key string, first_seen_at timestamp, last_active_at timestamp, "
        "load_count integer, play_count integer, browser string, browser_version string, "
        "platform string, is_mobile boolean, country string, region string, city string, "
        "last_ip string, load_date date",
        required=("visitor_key",),
    ),
    "fact_media_engagement": columns(
        "event_key string, media_id string, visitor_key string, event_date date, "
        "received_at timestamp, ip string, country string, region string, city string, "
        "lat decimal(10,6), lon decimal(10,6), percent_viewed decimal(10,6), embed_url string, "
        "media_name string, browser string, platform string, is_mobile boolean, "
        "visitor_play_count integer, visitor_load_count integer, load_date date",
        required=("event_key", "media_id"),
    ),
}

BROKEN = "_broken"  # text of a document that is no JSON of its schema

# documents that a run has taken in
FILES = columns("endpoint string, path string, modified timestamp, day string")

# micro-batches that a gated stream has published
BATCHES = columns("stream string, batch long, rows long, no_key long, broken long")

MARKS = columns("endpoint string, media_id string, high_water string")

# Dimensions load before the fact that points at them.
LOAD_ORDER = ("dim_media", "dim_visitor", "fact_media_engagement")

KEYS = {
    "dim_media": "media_id",
    "dim_visitor": "visitor_key",
    "fact_media_engagement": "event_key",
}

PARTITION_BY = {"fact_media_engagement": "event_date"}

SORT_BY = {
    "dim_media": ("media_id",),
    "dim_visitor": ("last_active_at", "visitor_key"),
    "fact_media_engagement": ("event_date", "media_id"),
}

# A row older by these than the published one of its key does not replace it.
NEWEST_BY = {
    "dim_media": ("updated_at", "load_date"),
    "dim_visitor": ("last_active_at", "load_date"),
    "fact_media_engagement": ("received_at", "load_date"),
}

# Failed casts of a field up to this share of a resource's rows do not stop a run; places are
# often spelt out where there should be a coordinate.
FAILED_CAST_PCT = 5.0
FAILED_CAST_PCT_OF = {("events", "lat"): 50.0, ("events", "lon"): 50.0}

# Fields that some document of a resource must have on every day.
REQUIRED_FIELDS = {
    "media_metadata": ("hashed_id", "name", "created"),
    "visitors": ("visitor_key", "user_agent_details"),
    "events": ("event_key", "media_id", "visitor_key", "received_at", "percent_viewed"),
}

# Declared tables lie in buckets of the columns that they are joined by; a staged fact meets the
# visitors, a published one the videos.
BUCKET_BY = {
    "dim_media": "media_id",
    "dim_visitor": "visitor_key",
    "fact_media_engagement": "media_id",
    "stg_fact_media_engagement": "visitor_key",
}

# Declared VARCHAR lengths, in bytes.
MAX_LENGTH = {
    "dim_media": {
        "media_id": 64, "name": 500, "status": 32, "project_name": 200, "section_name": 300,
        "channel": 20,
    },
    "dim_visitor": {
        "visitor_key": 256, "browser": 64, "browser_version": 32, "platform": 64,
        "country": 128, "region": 128, "city": 128, "last_ip": 64,
    },
    "fact_media_engagement": {
        "event_key": 256, "media_id": 64, "visitor_key": 256, "ip": 64, "country": 128,
        "region": 128, "city": 128, "embed_url": 1000, "media_name": 500, "browser": 64,
        "platform": 64,
    },
}

# Quality rules per table.
RULES = {
    "dim_media": {
        "required": ("media_id", "name", "channel", "created_at"),
        "min_rows": 1,
        "max_null_pct": {"media_id": 0.0, "name": 0.0, "channel": 0.0},
    },
    "dim_visitor": {
        "required": ("visitor_key", "browser", "platform"),
        "min_rows": 1,
        "max_null_pct": {"visitor_key": 0.0, "browser": 20.0, "platform": 20.0},
    },
    "fact_media_engagement": {
        "required": ("event_key", "media_id", "visitor_key", "event_date", "percent_viewed"),
        "min_rows": 1,
        "max_null_pct": {"event_key": 0.0, "media_id": 0.0, "visitor_key": 5.0},
    },
}

# Channels by the word in a video's title, first match first; the id in a path.
CHANNEL_WORDS = (("youtube", "YouTube"), ("facebook", "Facebook"))
NO_CHANNEL = "Unknown"
MEDIA_ID_IN_PATH = r"media_id=([^/]+)/"

# The high-water sentinel, and the time each paged endpoint is read by.
NO_HIGH_WATER = "1970-01-01T00:00:00Z"
PAGED = {"visitors": "created_at", "events": "received_at"}


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in STAR[table].fields if not f.nullable]
