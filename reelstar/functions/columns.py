"""Native column expressions shared by the build, the reports and the incremental load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelstar.schemas import CHANNEL_WORDS, MEDIA_ID_IN_PATH, NO_CHANNEL, NO_HIGH_WATER

_WHOLE_NUMBERS = ("int", "bigint")


def safe_cast(field: str, dtype: str) -> str:
    """SQL text of a cast that yields NULL for a value the type cannot hold.

    Text that is no whole number takes the slower way through a decimal, so ``"12.0"`` and
    ``"12.7"`` become 12 as they do when a JSON number is cast. Text, because wide projections
    are generated from field lists and one parsed select costs less than a Column per cast.
    """
    if dtype in _WHOLE_NUMBERS:
        by_decimal = f"try_cast(try_cast({field} AS decimal(38,18)) AS {dtype})"
        return f"coalesce(try_cast({field} AS {dtype}), {by_decimal})"
    return field if dtype == "string" else f"try_cast({field} AS {dtype})"


def cast_failed(field: str, dtype: str) -> str:
    return f"{field} IS NOT NULL AND {safe_cast(field, dtype)} IS NULL"


def channel_of(name: Column, words: Sequence[tuple[str, str]] = CHANNEL_WORDS) -> Column:
    """Advertising channel named in a video title, case-blind.

    ``words`` pairs a word in lower case with its channel; the first pair whose word occurs wins.
    """
    found = F.filter(
        F.array(*[F.struct(F.lit(w).alias("word"), F.lit(c).alias("channel")) for w, c in words]),
        lambda pair: F.contains(F.lower(name), pair["word"]),
    )
    return F.coalesce(F.get(found, F.lit(0))["channel"], F.lit(NO_CHANNEL))


def media_id_from_path(path: Column) -> Column:
    return F.regexp_extract(path, MEDIA_ID_IN_PATH, 1)


def event_date(received_at: Column, rule: str = "source_local") -> Column:
    """Day of an event.

    ``source_local`` keeps the calendar date written in the text, whatever its offset;
    ``utc`` takes the date of the instant.
    """
    if rule == "source_local":
        return received_at.try_cast("date")
    if rule == "utc":
        return received_at.try_cast("timestamp").try_cast("date")
    raise ValueError(f"unknown event date rule {rule!r}")


def depth_bucket(share: Column) -> Column:
    """Viewing depth in steps of ten percent; a full view is its own bucket, 100."""
    return (F.floor(share * 10) * 10).cast("int")


def avg_pct(share: Column, digits: int) -> Column:
    return F.round(F.avg(share) * 100, digits)


def split_list(text: str) -> list[str]:
    """Comma-separated configuration value, trimmed, empty items dropped."""
    return [item.strip() for item in text.split(",") if item.strip()]


# ISO text with microseconds; Spark's JSON default keeps milliseconds only.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def iso_timestamp(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def comparable(ts: Column, compare: str = "parsed") -> Column:
    """What a row time is compared by: the instant, or the raw text (empty text is no time)."""
    if compare == "parsed":
        return ts.try_cast("timestamp")
    if compare == "text":
        return F.nullif(ts, F.lit(""))
    raise ValueError(f"unknown comparison {compare!r}")


def high_water(mark: Column, compare: str = "parsed") -> Column:
    """The stored mark, NULL when it is empty or the 1970 sentinel."""
    return comparable(F.nullif(mark, F.lit(NO_HIGH_WATER)), compare)


def is_new(ts: Column, mark: Column) -> Column:
    """Strictly above the mark. Without a mark every row is new; with one, not a row without time."""
    return mark.isNull() | F.coalesce(ts > mark, F.lit(False))
