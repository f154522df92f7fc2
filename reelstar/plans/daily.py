"""The daily run: landed pages -> bronze -> star -> quality gate -> published tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelstar.operators import incremental as inc
from reelstar.operators import drift, quality, snapshots, star, visitors
from reelstar.operators.joins import shuffled_if_many, tracked_only
from reelstar.operators.latest import latest_by
from reelstar.schemas import (
    BROKEN,
    FAILED_CAST_PCT,
    FAILED_CAST_PCT_OF,
    FILES,
    KEYS,
    LOAD_ORDER,
    MARKS,
    NEWEST_BY,
    PAGED,
    PARTITION_BY,
    RAW,
    RULES,
    SORT_BY,
    STAR,
)
from reelstar.session import stored
from reelstar.sources import bronze, silver
from reelstar.sources.warehouse import Derived, Load, Warehouse

MARKS_TABLE = "high_water"
FILES_TABLE = "files_taken"
NUMBERS_TABLE = "visitor_numbers"
VISITOR_DAYS_TABLE = "visitor_days"
REFRESHED = ("media_metadata", "media_stats")


@dataclass(frozen=True)
class Roots:
    """Folders of a deployment; rows a pull leaves out go to ``quarantine`` if it is named."""

    landing: str
    bronze: str
    silver: str
    warehouse: str
    quarantine: str | None = None


@dataclass
class Day:
    """What a run built, and what it counted on the way.

    ``tables`` are the silver tables with data. ``rows``, ``no_key`` and ``broken`` count rows,
    rows left out for a missing key, and unreadable documents per resource; ``failed_casts``
    values per resource and field that did not fit a type.
    """

    tables: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    no_key: dict[str, int] = field(default_factory=dict)
    broken: dict[str, int] = field(default_factory=dict)
    failed_casts: dict[tuple[str, str], int] = field(default_factory=dict)


def _quarantine(df: DataFrame, roots: Roots, name: str, run_date: str) -> None:
    """Keep rows of a run aside; a rerun replaces what the run kept before."""
    if roots.quarantine is not None:
        dated = df.withColumn("run_date", F.to_date(F.lit(run_date)))
        writer = dated.write.partitionBy("run_date").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{roots.quarantine}/{name}")


def refresh(spark: SparkSession, roots: Roots, endpoint: str, days: Sequence[str]) -> None:
    """Put the landed documents of a resource that is pulled whole in place of the day's."""
    for day in days:
        documents = bronze.read_bronze(spark, roots.landing, endpoint, [day], keep_broken=True)
        documents = stored(spark, documents, f"landed-{endpoint}")
        _stop_if_broken(documents, roots, endpoint, day)
        bronze.write_bronze(documents, roots.bronze, endpoint, day, replace=True)


def _stop_if_broken(documents: DataFrame, roots: Roots, name: str, run_date: str) -> None:
    """Fail the gate if documents cannot be read, and keep their texts in quarantine."""
    torn = documents.filter(F.col(BROKEN).isNotNull())
    n = torn.count()
    if n:
        _quarantine(torn.select(BROKEN), roots, f"broken_{name}", run_date)
        quality.gate(None, [quality.build_line(name, "broken_documents", None, n, 0, n)])


def pull_pages(
    spark: SparkSession,
    roots: Roots,
    endpoint: str,
    run_date: str,
    compare: str = "parsed",
    tracked: str | DataFrame | None = None,
    days: Sequence[str] | None = None,
    lines: bool = False,
) -> DataFrame:
    """Move the new rows of the days' landed pages to bronze; returns the endpoint's next marks.

    Every landed row above its video's mark is taken, and the next mark is the newest time of
    all landed rows. Rows that bronze holds already are passed over, so a rerun adds nothing;
    the others, late or without a time, go to quarantine. Landing is parsed once. ``tracked``
    limits the pull to some videos, as a comma-separated setting or a frame. A landed file holds
    one page, or with ``lines`` one page per line.

    The marks are not stored here: they are published together with the tables.
    """
    ts, days = PAGED[endpoint], list(days or [run_date])
    landed = bronze.read_landing(
        spark, roots.landing, endpoint, days, multiline=not lines, keep_broken=True
    )
    content = F.xxhash64(*RAW[endpoint].names)
    landed = landed.withColumn("_content", content)
    if "media_id" in landed.columns:  # events repeat the id in the row
        landed = landed.withColumnRenamed("media_id", "row_media_id")
    rows = landed.withColumnRenamed("request_media_id", "media_id")
    marks = Warehouse(spark, roots.warehouse).read(MARKS_TABLE, MARKS)
    marked = stored(
        spark, inc.with_marks(rows, marks, endpoint, ts, compare), f"landed-{endpoint}"
    )
    _stop_if_broken(marked, roots, endpoint, run_date)
    if tracked is not None:
        marked = tracked_only(marked, tracked)

    known = bronze.read_bronze(spark, roots.bronze, endpoint, days)
    known = known.select(content.alias("_content")).distinct()
    rest = marked.join(known, "_content", "left_anti")
    rest = rest.withColumnRenamed("media_id", "request_media_id")
    if "row_media_id" in rest.columns:
        rest = rest.withColumnRenamed("row_media_id", "media_id")
    rest = stored(spark, rest, f"unseen-{endpoint}")
    bronze.write_bronze(rest.filter("_is_new"), roots.bronze, endpoint, run_date)
    late = rest.filter(~F.col("_is_new"))
    shown = ["request_media_id", "page", "pos", *RAW[endpoint].names]
    _quarantine(late.select(*shown, F.col("_mark").alias("mark")), roots, endpoint, run_date)
    return inc.next_marks(marked, marks, endpoint, compare)


def build_day(
    spark: SparkSession,
    roots: Roots,
    run_date: str,
    days: Sequence[str] | None = None,
    geo: str = "latest",
    date_rule: str = "source_local",
    accumulated_visitors: DataFrame | None = None,
) -> Day:
    """Build and write the silver tables of a run.

    ``days`` lists the bronze days to take in, the run date alone by default. The events are
    parsed once and kept as Parquet, because the visitor dimension and the fact both read them;
    the fact takes the visitor counters from the dimension just written, or with
    ``accumulated_visitors`` from those and the day's together, the more recently active of the
    two. Rows, missing keys, broken documents and failed casts are counted by the jobs that
    write the tables.
    """
    days = [run_date] if days is None else list(days)
    raw = {
        name: bronze.read_bronze(spark, roots.bronze, name, days, keep_broken=True)
        for name in star.FIELDS
    }

    day, counting = Day(), {}

    def counted(resource: str, df: DataFrame) -> DataFrame:
        counting[resource] = Observation()
        counters = [*star.cast_counters(resource).values(), *star.row_counters(df, resource)]
        return df.observe(counting[resource], *counters)

    def write(table: str, df: DataFrame) -> None:
        silver.check_columns(df, table, RULES[table]["required"])
        silver.write_silver(df, roots.silver, table)
        day.tables[table] = silver.read_silver(spark, roots.silver, table, run_date)

    if not raw["media_metadata"].isEmpty():
        stats = raw["media_stats"]
        if not stats.isEmpty():
            stats = counted("media_stats", stats)
        metadata = counted("media_metadata", raw["media_metadata"])
        write("dim_media", star.build_dim_media(metadata, stats, run_date))

    has_events = not raw["events"].isEmpty()
    events = raw["events"]
    if has_events:
        events = stored(spark, counted("events", events), "events")
    day_visitors = star.latest_visitors(raw["visitors"])
    if not raw["visitors"].isEmpty():
        visitors = counted("visitors", raw["visitors"])
        write("dim_visitor", star.build_dim_visitor(visitors, events, run_date, geo))
        day_visitors = day.tables["dim_visitor"]
    if has_events:
        counts_from = day_visitors
        if accumulated_visitors is not None:
            both = ("visitor_key", "last_active_at", "play_count", "load_count")
            together = accumulated_visitors.select(*both).unionByName(day_visitors.select(*both))
            counts_from = latest_by(together, ["visitor_key"], ["last_active_at"])
        df = star.build_fact(events, counts_from, run_date, date_rule)
        write("fact_media_engagement", df)
    for resource, counts in counting.items():
        found = dict(counts.get)
        day.rows[resource] = found.pop("_rows")
        day.no_key[resource] = found.pop("_no_key")
        day.broken[resource] = found.pop("_broken")
        day.failed_casts |= {(resource, c): n for c, n in found.items()}
        if day.broken[resource]:
            # Spark wants such rows stored before they are looked for
            every = stored(spark, raw[resource], f"torn-{resource}")
            torn = every.filter(F.col(BROKEN).isNotNull()).select(BROKEN)
            _quarantine(torn, roots, f"broken_{resource}", run_date)
    return day


def build_lines(
    day: Day,
    failed_cast_pct: float = FAILED_CAST_PCT,
    of_field: dict[tuple[str, str], float] = FAILED_CAST_PCT_OF,
) -> list:
    """Report lines of what the build counted: no broken document, few failed casts.

    ``of_field`` has the limits of fields that need one of their own.
    """
    lines = [
        quality.build_line(resource, "broken_documents", None, n, 0, n)
        for resource, n in day.broken.items()
    ]
    for (resource, column), n in day.failed_casts.items():
        share = 100 * n / max(1, day.rows[resource])
        limit = of_field.get((resource, column), failed_cast_pct)
        lines.append(quality.build_line(resource, "failed_casts", column, n, limit, share))
    return lines


def load(table: str, staging: DataFrame) -> Load:
    return Load(
        staging, [KEYS[table]], PARTITION_BY.get(table), SORT_BY[table], NEWEST_BY.get(table, ())
    )


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    warehouse = Warehouse(spark, root)
    return {t: warehouse.read(t, STAR[t], PARTITION_BY.get(t)) for t in LOAD_ORDER}


def _changes(spark: SparkSession, roots: Roots, media: DataFrame, run_date: str) -> tuple[DataFrame, list]:
    """The videos of a whole pull that differ from the published ones, and report lines that
    count them. Videos that are published but not pulled any more are kept, and listed in
    quarantine."""
    old = published(spark, roots.warehouse)["dim_media"]
    found = snapshots.compare(old, media, KEYS["dim_media"], leave_out=("load_date",))
    found = stored(spark, found, "changes")
    counts = {r["change"]: r["count"] for r in found.groupBy("change").count().collect()}
    if counts.get(snapshots.GONE):
        gone = found.filter(F.col("change") == snapshots.GONE).select(KEYS["dim_media"])
        _quarantine(gone, roots, "gone_dim_media", run_date)
    lines = [
        quality.build_line("dim_media", f"{kind}_videos", None, counts.get(kind, 0), 0, 0)
        for kind in (snapshots.NEW, snapshots.CHANGED, snapshots.GONE)
    ]
    differing = sum(counts.get(kind, 0) for kind in (snapshots.NEW, snapshots.CHANGED))
    found = shuffled_if_many(found, differing)
    return stored(spark, snapshots.to_publish(media, found, KEYS["dim_media"]), "changed"), lines


def published_visitors(spark: SparkSession, root: str) -> DataFrame:
    """Bitmaps of visitors per day and video, of runs that counted visitors."""
    return Warehouse(spark, root).read(VISITOR_DAYS_TABLE, visitors.VISITOR_DAYS, "event_date")


def count_visitors_of(
    spark: SparkSession, warehouse: Warehouse, facts: DataFrame, fact: str
) -> tuple[dict[str, Load], dict[str, Derived]]:
    """What publishes the visitors of a load's days with it: numbers for new visitors, and the
    rule that makes the bitmaps of every touched day anew. One writer at a time may give out numbers.
    """
    known = warehouse.read(NUMBERS_TABLE, visitors.NUMBERS)
    new = stored(spark, visitors.new_numbers(facts, known), "visitor-numbers")
    numbers = known.unionByName(new)
    rule = Derived(fact, lambda rows: visitors.visitor_days(rows, numbers))
    return {NUMBERS_TABLE: Load(new, ["visitor_key"])}, {VISITOR_DAYS_TABLE: rule}


def field_kinds(spark: SparkSession, roots: Roots, days: Sequence[str]) -> DataFrame:
    """Fields of the raw documents of some days, and their kinds; see ``operators.drift``."""
    parts = [bronze.read_variants(spark, roots.bronze, name, days) for name in star.FIELDS]
    return drift.field_kinds(reduce(DataFrame.unionByName, parts))


def check_and_publish(
    spark: SparkSession,
    roots: Roots,
    day: Day,
    run_date: str,
    marks: DataFrame | None = None,
    taken: DataFrame | None = None,
    lines: Sequence = (),
    count_visitors: bool = False,
    max_null_pct: dict[tuple[str, str], float] | None = None,
) -> list:
    """Run every check on every table, then publish all of them in one commit.

    The fact may point at a video of an earlier day, so it is checked against the published
    dimension and the day's together. ``taken`` lists the files of the run; the commit that
    publishes its rows notes them. Of the videos, pulled whole every time, only new and changed ones
    are published. ``lines`` are further lines of the report, ``max_null_pct`` limits of
    the feed per table and column, in place of those of the rules. Returns the quality report and the
    lines of the build; a failed check raises before anything is published.
    """
    tables = dict(day.tables)
    known = published(spark, roots.warehouse)["dim_media"].select("media_id")
    if "dim_media" in tables:
        known = known.unionByName(tables["dim_media"].select("media_id"))
    elif not Warehouse(spark, roots.warehouse).exists("dim_media"):
        known = None
    dropped = {
        table: day.no_key[resource]
        for resource, (table, _) in star.ROW_KEYS.items()
        if resource in day.no_key
    }
    checks = quality.quality_report(tables, known, dropped, max_null_pct)
    derived: dict[str, Derived] = {}
    if "dim_media" in tables:
        tables["dim_media"], changed = _changes(spark, roots, tables["dim_media"], run_date)
        lines = [*lines, *changed]
    report = quality.gate(checks, [*build_lines(day), *lines])
    loads = {t: load(t, tables[t]) for t in LOAD_ORDER if t in tables}
    warehouse = Warehouse(spark, roots.warehouse)
    if count_visitors and "fact_media_engagement" in loads:
        facts = loads["fact_media_engagement"].staging
        more, derived = count_visitors_of(spark, warehouse, facts, "fact_media_engagement")
        loads |= more
    if marks is not None:
        loads[MARKS_TABLE] = Load(marks, ["endpoint", "media_id"])
    if taken is not None:
        loads[FILES_TABLE] = Load(taken, ["endpoint", "path"])
    if loads:
        warehouse.publish(loads, derived=derived)
    return report


def untaken(
    spark: SparkSession,
    roots: Roots,
    run_date: str,
    landing: bool = False,
    days: Sequence[str] | None = None,
) -> DataFrame:
    """Files up to the run date that no published run has taken, or all files of named days.

    A file counts as new again when it was written anew. Landed files are noted under
    ``landing/`` and their endpoint, as bronze has files of the same names.
    """
    root = roots.landing if landing else roots.bronze
    listed = [bronze.files(spark, root, name) for name in star.FIELDS]
    every = reduce(DataFrame.unionByName, listed)
    if landing:
        every = every.withColumn("endpoint", F.concat(F.lit("landing/"), "endpoint"))
    if days is not None:
        return stored(spark, every.filter(F.col("day").isin(list(days))), "files")
    known = Warehouse(spark, roots.warehouse).read(FILES_TABLE, FILES)
    new = every.filter(F.col("day") <= run_date).join(known, FILES.names[:3], "left_anti")
    return stored(spark, new.select(*FILES.names), "files")


def _days_of(files: DataFrame) -> dict[str, list[str]]:
    """Days with files, per endpoint: one row a day on the driver."""
    found: dict[str, list[str]] = {}
    for row in files.select("endpoint", "day").distinct().orderBy("day").collect():
        found.setdefault(row["endpoint"], []).append(row["day"])
    return found


def open_days(spark: SparkSession, roots: Roots, run_date: str, pull: bool = False) -> list[str]:
    """The run date, and earlier days that have documents which were never published."""
    files = [untaken(spark, roots, run_date, landing) for landing in ((False, True) if pull else (False,))]
    found = set().union(*(days for f in files for days in _days_of(f).values()))
    return sorted(found | {run_date})


def run(
    spark: SparkSession,
    roots: Roots,
    run_date: str,
    days: Sequence[str] | None = None,
    pull: bool = False,
    tracked: str | DataFrame | None = None,
    compare: str = "parsed",
    check_fields: bool = False,
    count_visitors: bool = False,
    max_null_pct: dict[tuple[str, str], float] | None = None,
    **options,
) -> list:
    """One daily run, over every day up to the run date that has files no run has taken.

    So a file that comes late, into the folder of a day published long ago, is taken in by the
    next run. Such a day is read whole, as a visitor's place comes from all events of the day; the
    upsert leaves rows that are published already as they are. Files are noted by the commit that
    publishes their rows: a run that fails takes them again, and one without new files reads none.
    ``days`` names the days instead, to be read whatever was taken; ``options`` of the build do so
    for the run date. ``pull`` first takes the landed pages of the paged endpoints and the landed
    documents of the others, of the days with new ones. ``check_fields`` reads the documents'
    fields besides and fails if a day has none with a required one; ``count_visitors`` keeps up
    the bitmaps of visitors per day and video. ``max_null_pct`` has limits of a feed that leaves
    a column out more often than the rules allow, per table and column.
    """
    named = None if days is None else sorted(set(days))
    taken, marks = [], None
    if pull:
        landed = untaken(spark, roots, run_date, landing=True, days=named)
        landed_days = _days_of(landed)
        for endpoint in REFRESHED:
            refresh(spark, roots, endpoint, landed_days.get(f"landing/{endpoint}", ()))
        for endpoint in PAGED:
            of = landed_days.get(f"landing/{endpoint}")
            if of:
                after = pull_pages(spark, roots, endpoint, run_date, compare, tracked, of)
                marks = after if marks is None else marks.unionByName(after)
        if landed_days:
            taken.append(landed)
            named = None if named is None else sorted({*named, run_date})
    files = untaken(spark, roots, run_date, days=named)
    if options and named is None:
        files = files.unionByName(untaken(spark, roots, run_date, days=[run_date])).distinct()
        files = stored(spark, files, "files")
    of_days = sorted(set().union(*_days_of(files).values()))
    if of_days:
        taken.append(files)
    day = build_day(spark, roots, run_date, of_days, **options) if of_days else Day()
    lines = []
    if check_fields and of_days:
        kinds = stored(spark, field_kinds(spark, roots, of_days), "field-kinds")
        lines = [line for d in of_days for line in drift.required_lines(kinds, d)]
    noted = reduce(DataFrame.unionByName, taken) if taken else None
    return check_and_publish(spark, roots, day, run_date, marks, noted, lines, count_visitors, max_null_pct)
