"""Every operator and report as a query over the test tables.

A query returns strings, integers, doubles and booleans only, so its values print the same in
any engine. The star is planned from the raw tables inside each query; reports that need no
statistics or visitor counters leave those sources out of their plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from reelstar.functions import columns as C
from reelstar.operators import incremental as inc
from reelstar.operators import drift, quality, snapshots, star, visitors
from reelstar.operators import upsert as ups
from reelstar.operators.joins import tracked_only
from reelstar.operators.latest import latest_by
from reelstar.plans import daily, reports
from reelstar.schemas import BATCHES, RAW, STAR
from reelstar.session import apply_settings, scratch_dir, stored
from reelstar.sources import bronze, samples, silver, tables
from reelstar.sources.warehouse import Load, Warehouse
from reelstar.streaming import loads

DAY = samples.RUN_DATE
FACT = "fact_media_engagement"
# a gzip file is read by one task
LINES_PER_FILE = 100_000


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text."""
    forms = {
        DecimalType: "CAST(`{0}` AS double)",
        DateType: "CAST(`{0}` AS string)",
        TimestampType: "date_format(`{0}`, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
        TimestampNTZType: "date_format(`{0}`, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    }
    shown = [forms.get(type(f.dataType), "`{0}`") + " AS `{0}`" for f in df.schema.fields]
    return df.selectExpr(*[text.format(name) for text, name in zip(shown, df.columns)])


# -- the star over the test tables -----------------------------------------------------------
# The sample feed never repeats a time within a key, so the newest row needs no tie-break.


def dim_media(spark: SparkSession, sf: str, stats: bool = True) -> DataFrame:
    counters = samples.media_stats(spark, sf) if stats else bronze.empty(spark, "media_stats")
    return star.build_dim_media(samples.media_metadata(spark, sf), counters, DAY, tie_break=())


def dim_visitor(spark: SparkSession, sf: str, geo: str = "latest") -> DataFrame:
    return star.build_dim_visitor(
        samples.visitors(spark, sf), samples.events(spark, sf), DAY, geo, tie_break=()
    )


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """The fact without visitor counters, which no report reads."""
    return star.clean_events(samples.events(spark, sf), tie_break=())


def fact(spark: SparkSession, sf: str) -> DataFrame:
    people = star.latest_visitors(samples.visitors(spark, sf), tie_break=())
    return star.build_fact(samples.events(spark, sf), people, DAY, tie_break=())


def staged_events(spark: SparkSession, sf: str, raw: DataFrame | None = None) -> DataFrame:
    """Typed events before the key filter and the deduplication."""
    raw = samples.events(spark, sf) if raw is None else raw
    return star.project(raw, star.EVENT_FIELDS)


# -- builds ----------------------------------------------------------------------------------


def channel_derivation(spark, sf):
    named = samples.media_metadata(spark, sf).select("hashed_id", "name")
    return named.withColumn("channel", C.channel_of(F.col("name")))


def media_without_stats(spark, sf):
    return dim_media(spark, sf).filter(F.col("total_plays").isNull()).select(
        "media_id", "name", "channel", "total_plays", "hours_watched"
    )


def media_metadata_only(spark, sf):
    return dim_media(spark, sf, stats=False).select(
        "media_id", "channel", "total_plays", "play_rate", "hours_watched", "total_visitors"
    )


def visitor_geo(spark, sf, geo):
    return star.visitor_geo(samples.events(spark, sf), geo, tie_break=())


def fact_without_visitors(spark, sf):
    nobody = star.latest_visitors(bronze.empty(spark, "visitors"))
    built = star.build_fact(samples.events(spark, sf), nobody, DAY, tie_break=())
    return built.select("event_key", "visitor_key", "visitor_play_count", "visitor_load_count")


def replay_dedup_lineitem(spark, sf):
    lines = samples.table(spark, sf, "lineitem")
    order = (
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus",
    )
    return latest_by(lines, ["l_orderkey", "l_linenumber"], order, tie_break=())


def event_dates(spark, sf):
    """Both date rules on times with an offset: local text date against UTC date."""
    kinds = samples.table(spark, sf, "events").select(
        F.concat(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            F.when(F.col("event_type") == "click", "-05:00").otherwise("Z"),
        ).alias("received_at")
    )
    return (
        kinds.groupBy(
            C.event_date(F.col("received_at"), "source_local").alias("local_date"),
            C.event_date(F.col("received_at"), "utc").alias("utc_date"),
        )
        .agg(F.count(F.lit(1)).alias("events"))
    )


# -- reports ---------------------------------------------------------------------------------


def report(build, spark, sf):
    return build(facts(spark, sf), dim_media(spark, sf, stats=False))


def table_counts(spark, sf):
    return reports.table_counts(
        {"dim_media": dim_media(spark, sf), "dim_visitor": dim_visitor(spark, sf),
         FACT: fact(spark, sf)}
    )


def sql_dashboard(spark, sf):
    """A dashboard query as a SQL user writes it, over views of the published tables."""
    warehouse = Warehouse(spark, scratch_dir(spark, "warehouse"))
    built = {"dim_media": dim_media(spark, sf), FACT: fact(spark, sf)}
    for table, df in built.items():
        silver.write_silver(df, f"{warehouse.root}/silver", table)
    staged = {t: silver.read_silver(spark, f"{warehouse.root}/silver", t) for t in built}
    warehouse.publish({t: daily.load(t, df) for t, df in staged.items()})
    reports.register_views(daily.published(spark, warehouse.root))
    return spark.sql(
        """
        WITH seen AS (
          SELECT weekofyear(event_date) AS week, media_id, visitor_key, max(percent_viewed) AS best
          FROM fact_media_engagement
          WHERE visitor_key IS NOT NULL
          GROUP BY ALL)
        SELECT week, channel, count(DISTINCT visitor_key) AS visitors,
               count_if(best >= 0.5) AS half_watched
        FROM seen JOIN dim_media USING (media_id)
        GROUP BY week, channel
        """
    )


# -- quality ---------------------------------------------------------------------------------


def null_key_filter(spark, sf):
    events = quality.null_key_report(
        staged_events(spark, sf), FACT, ["event_key", "media_id"]
    )
    visitors = quality.null_key_report(
        samples.visitors(spark, sf), "dim_visitor", ["visitor_key"]
    )
    return events.unionByName(visitors)


def null_pct_profile(spark, sf):
    columns = ["event_key", "media_id", "visitor_key", "country", "lat", "percent_viewed"]
    return quality.null_profile(staged_events(spark, sf), FACT, columns)


def dq_report(spark, sf):
    """The report over written tables; rows without a key are counted by the job that writes."""
    raw = {name: getattr(samples, name)(spark, sf) for name in star.ROW_KEYS}
    counts = {name: Observation() for name in raw}
    seen = {
        name: stored(spark, df.observe(counts[name], *star.row_counters(df, name)), name)
        for name, df in raw.items()
    }
    stats = samples.media_stats(spark, sf)
    built = {
        "dim_media": star.build_dim_media(seen["media_metadata"], stats, DAY, tie_break=()),
        "dim_visitor": star.build_dim_visitor(seen["visitors"], seen["events"], DAY, tie_break=()),
        FACT: star.clean_events(seen["events"], tie_break=()),
    }
    tables = {name: stored(spark, df, name) for name, df in built.items()}
    dropped = {star.ROW_KEYS[name][0]: n.get["_no_key"] for name, n in counts.items()}
    return quality.quality_report(tables, dropped=dropped)


def measured_media(spark, sf):
    """The dimension cut down to videos with statistics: facts of the others are orphans."""
    return dim_media(spark, sf).filter(F.col("total_plays").isNotNull())


def orphan_facts(spark, sf):
    lost = quality.orphan_facts(facts(spark, sf), measured_media(spark, sf))
    return lost.select("event_key", "media_id", "event_date")


def orphan_count(spark, sf):
    return quality.orphan_count(facts(spark, sf), measured_media(spark, sf))


def duplicate_keys(spark, sf):
    return quality.duplicate_keys(
        samples.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def constraint_violations(spark, sf):
    """Staged events against the fact's constraints, and documents as videos whose titles are
    whole texts."""
    titles = samples.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("media_id"),
        F.col("text").alias("name"),
        F.col("lang").alias("status"),
        F.col("source").alias("section_name"),
    )
    on_media = quality.constraint_violations(titles, "dim_media")
    as_text = [(c, src, "string" if t.startswith("decimal") else t) for c, src, t in star.EVENT_FIELDS]
    staged = star.project(samples.events(spark, sf), as_text)
    return on_media.unionByName(quality.constraint_violations(staged, FACT))


def cast_failures(spark, sf):
    return star.cast_failures(samples.events(spark, sf), "events")


# -- upsert and publish ----------------------------------------------------------------------

TARGET_COLUMNS = ("event_key", "received_at", "percent_viewed", "platform")


def upsert_sides(spark, sf):
    raw = samples.first_deliveries(spark, sf)
    target = staged_events(spark, sf, raw).select(*TARGET_COLUMNS)
    staging = staged_events(spark, sf, samples.replays(spark, sf)).select(*TARGET_COLUMNS)
    return target, staging


def upsert_fact(spark, sf):
    return ups.upsert(*upsert_sides(spark, sf), ["event_key"])


def upsert_idempotent(spark, sf):
    target, staging = upsert_sides(spark, sf)
    once = ups.upsert(target, staging, ["event_key"])
    return ups.upsert(once, staging, ["event_key"])


def delete_using(spark, sf):
    return ups.delete_matching(*upsert_sides(spark, sf), ["event_key"])


def publish_replays(spark, sf):
    """First deliveries published, then their replays: partitions change, no row stays twice."""
    warehouse = Warehouse(spark, scratch_dir(spark, "warehouse"))
    target, staging = (
        side.withColumn("event_date", F.col("received_at").cast("date"))
        for side in upsert_sides(spark, sf)
    )
    for rows in (target, stored(spark, staging, "staging")):
        warehouse.publish({"facts": Load(rows, ["event_key"], "event_date", ("event_key",))})
    return warehouse.read("facts", target.schema, "event_date")


def staging_load(spark, sf):
    """Declared tables: staging filled by position, keys filtered, loaded into the target twice."""
    names = tables.declare(spark, scratch_dir(spark, "declared"))
    loaded = {
        "dim_media": dim_media(spark, sf),
        "dim_visitor": dim_visitor(spark, sf),
        FACT: fact(spark, sf),
    }
    for table, df in loaded.items():
        tables.fill_staging(names, table, df)
        for _ in range(2):
            tables.insert_from_staging(spark, names, table)
    target, people = spark.table(names["dim_media"]), spark.table(names["dim_visitor"])
    known = people.select("visitor_key", F.lit(1).alias("known"))
    events = (
        spark.table(names[FACT])
        .join(known, "visitor_key", "left")
        .groupBy("media_id")
        .agg(F.count(F.lit(1)).alias("events"), F.count("known").alias("of_visitors"))
    )
    return target.join(events, "media_id", "left").select(
        "media_id", "channel", "total_plays", "hours_watched", "events", "of_visitors"
    )


def declared_replays(spark, sf):
    """Declared facts, then ten days of them again under the next day's date: only the dates of
    those days are read and written, and no event stays twice."""
    names = tables.declare(spark, scratch_dir(spark, "declared"))
    rows = stored(spark, fact(spark, sf), "facts")
    again = rows.filter(F.col("event_date").between("2024-01-10", "2024-01-19"))
    for load in (rows, again.withColumn("event_date", F.date_add("event_date", 1))):
        tables.fill_staging(names, FACT, load)
        tables.insert_from_staging(spark, names, FACT)
    return spark.table(names[FACT]).select("event_key", "media_id", "visitor_key", "event_date")


# -- incremental -----------------------------------------------------------------------------

def landed(spark, sf):
    return samples.landed_pages(spark, sf), samples.high_water_marks(spark, sf)


def incremental_filter(spark, sf):
    return inc.incremental_filter(*landed(spark, sf), "events", "received_at")


def late_rows(spark, sf):
    return inc.late_rows(*landed(spark, sf), "events", "received_at")


def next_watermark(spark, sf):
    rows, marks = landed(spark, sf)
    return inc.next_marks(inc.with_marks(rows, marks, "events", "received_at"), marks, "events")


def _roots(spark, label):
    base = scratch_dir(spark, label)
    names = ("landing", "bronze", "silver", "warehouse", "quarantine")
    return daily.Roots(*(f"{base}/{x}" for x in names))


def _land_pages(spark, rows, roots, day):
    """Landed pages of rows with ``page``: a document per line, its rows in an array."""
    fields = F.struct(*[c for c in rows.columns if c not in ("request", "page")])
    pages = rows.groupBy(F.col("request").alias("media_id"), "page").agg(
        F.collect_list(fields).alias("rows")
    )
    pages.write.json(bronze.day_path(roots.landing, "events", day))


def pull_and_publish(spark, sf):
    """Two days of landed pages, of 5 rows and of 100: where every landed row has gone."""
    roots, first_day, second_day = _roots(spark, "pull"), "2024-01-16", DAY
    first = samples.first_deliveries(spark, sf)
    of_request = Window.partitionBy("request").orderBy("_received", "embed_url", "lon")
    size = F.when(F.col("_kind") == "click", 5).otherwise(100)
    rows = (
        first.withColumn("request", F.concat_ws("/", "_kind", F.coalesce("media_id", F.lit("none"))))
        .withColumn("page", (F.row_number().over(of_request) / size + 1).cast("int"))
        .withColumn("received_at", F.expr("IF(_kind = 'view' AND CAST(lon AS double) < 10, NULL, received_at)"))
    )
    early = F.col("_received") < F.lit(first_day).cast("timestamp_ntz")
    again = rows.filter(early & (F.col("_kind") == "purchase"))  # landed a second time
    for day, part in ((first_day, rows.filter(early)), (second_day, rows.filter(~early).union(again))):
        _land_pages(spark, part.drop("_kind", "_received"), roots, day)
        marks = daily.pull_pages(spark, roots, "events", day, lines=True)
        loads = {daily.MARKS_TABLE: Load(stored(spark, marks, "marks"), ["endpoint", "media_id"])}
        Warehouse(spark, roots.warehouse).publish(loads)
    shown = ["event_key", "media_id", "visitor_key", "received_at"]
    taken = bronze.read_bronze(spark, roots.bronze, "events", [first_day, second_day])
    late = spark.read.schema(RAW["events"]).parquet(f"{roots.quarantine}/events")
    return taken.select(F.lit("bronze").alias("place"), *shown).unionByName(
        late.select(F.lit("quarantine").alias("place"), *shown)
    )


def broken_documents(spark, sf):
    """Documents of events, those of one kind cut short: what can be read of them."""
    root = scratch_dir(spark, "torn")
    events = samples.first_deliveries(spark, sf)
    line = F.to_json(F.struct("event_key", "media_id", "received_at"))
    torn = F.when(F.col("_kind") == "error", F.expr("left(line, length(line) - 3)"))
    lines = events.select("_kind", line.alias("line")).select(F.coalesce(torn, "line").alias("value"))
    path = bronze.day_path(root, "events", DAY)
    lines.write.option("compression", "gzip").text(path)
    back = bronze.read_bronze(spark, root, "events", [DAY], keep_broken=True)
    return back.select(
        F.col("_broken").isNotNull().alias("is_broken"),
        F.expr("IF(_broken IS NULL, event_key, NULL)").alias("event_key"),
    )


def full_refresh(spark, sf):
    """Video metadata pulled whole twice on a day: the second pull takes the place of the first."""
    roots = _roots(spark, "refresh")
    metadata = samples.media_metadata(spark, sf)
    for documents in (metadata, metadata.filter("status = 'ready'")):
        bronze.write_bronze(documents, roots.landing, "media_metadata", DAY, replace=True)
        daily.refresh(spark, roots, "media_metadata", [DAY])
    return bronze.read_bronze(spark, roots.bronze, "media_metadata", [DAY]).select("hashed_id", "name")


def rerun_older_day(spark, sf):
    """All visitors published, then an older day's once more: the newer snapshots stay."""
    warehouse = Warehouse(spark, scratch_dir(spark, "older"))
    everyone, places = samples.visitors(spark, sf), samples.events(spark, sf)
    older = everyone.filter("user_agent_details.platform = 'F'")
    for people, day in ((everyone, DAY), (older, "2024-01-31")):
        built = star.build_dim_visitor(people, places, day, tie_break=())
        staged = stored(spark, built, "visitors")
        warehouse.publish({"dim_visitor": daily.load("dim_visitor", staged)})
    return warehouse.read("dim_visitor", STAR["dim_visitor"])


# -- sources ---------------------------------------------------------------------------------


def path_media_id(spark, sf):
    """Video ids taken back out of document paths."""
    day = F.date_format("ts", "'year='yyyy'/month='MM'/day='dd")
    video = F.get_json_object("props", "$.k")
    path = F.concat_ws(
        "/", F.lit("bronze/media_stats"), day, F.concat(F.lit("media_id="), video),
        F.concat(video, F.lit(".json")),
    )
    ids = samples.table(spark, sf, "events").select(C.media_id_from_path(path).alias("media_id"))
    return ids.groupBy("media_id").agg(F.count(F.lit(1)).alias("documents"))


def json_props(spark, sf):
    parsed = samples.table(spark, sf, "events").select(
        "event_type", F.from_json("props", "k int").alias("props")
    )
    return parsed.groupBy("event_type", F.col("props.k").alias("k")).agg(
        F.count(F.lit(1)).alias("events"),
        F.max(F.to_json("props")).alias("as_json"),
    )


def media_allow_list(spark, sf):
    """Facts of the tracked videos only."""
    tracked = (
        samples.media_metadata(spark, sf)
        .filter(F.col("status") == "archived")
        .select(F.col("hashed_id").alias("media_id"))
    )
    kept = facts(spark, sf).select("event_key", "media_id")
    return tracked_only(kept, tracked)


def json_bronze_roundtrip(spark, sf):
    """Events written as bronze JSON and scanned back."""
    root = scratch_dir(spark, "bronze")
    keyed = samples.events(spark, sf).withColumn(
        "path_id", F.coalesce("media_id", F.lit("none"))
    )
    bronze.write_bronze(keyed, root, "events", DAY, "path_id")
    back = bronze.read_bronze(spark, root, "events", [DAY])
    return staged_events(spark, sf, back)


def silver_roundtrip(spark, sf):
    root = scratch_dir(spark, "silver")
    silver.write_silver(dim_visitor(spark, sf), root, "dim_visitor")
    return silver.read_silver(spark, root, "dim_visitor", DAY)


def landed_documents(spark, sf):
    """Landed documents with a row array (a purchase's two deliveries in one), exploded."""
    first = samples.first_deliveries(spark, sf)
    again = C.iso_timestamp(F.expr("_received + INTERVAL '1' HOUR"))
    delivery = F.struct("event_key", "media_id", "received_at")
    replay = F.struct("event_key", "media_id", again.alias("received_at"))
    pages = first.select(
        F.coalesce("media_id", F.lit("none")).alias("media_id"),
        (F.datediff(F.lit("2024-01-30").cast("date"), F.col("_received")) + 1).alias("page"),
        F.when(F.col("_kind") == "purchase", F.array(delivery, replay))
        .otherwise(F.array(delivery))
        .alias("rows"),
    )
    root = scratch_dir(spark, "landing")
    pages.write.json(f"{root}/events")
    return bronze.read_landing(spark, root, "events", multiline=False).select(
        "request_media_id", "page", "pos", "event_key", "received_at"
    )


def daily_load(spark, sf):
    """A whole day: bronze files, silver, gate, publish; then what was published."""
    base = scratch_dir(spark, "daily")
    roots = daily.Roots(*(f"{base}/{x}" for x in ("landing", "bronze", "silver", "warehouse")))
    for endpoint in star.FIELDS:
        documents = getattr(samples, endpoint)(spark, sf)
        bronze.write_bronze(documents, roots.bronze, endpoint, DAY)
    daily.run(spark, roots, DAY, max_null_pct=samples.MAX_NULL_PCT)
    return daily.published(spark, roots.warehouse)[FACT]


def late_files(spark, sf):
    """Half of a day's events written after the day's run: the next day's run takes them in."""
    roots, first_day = _roots(spark, "late"), "2024-01-31"
    events = samples.events(spark, sf)
    late = F.expr("pmod(crc32(CAST(coalesce(event_key, '') AS binary)), 2) = 1")
    bronze.write_bronze(samples.media_metadata(spark, sf), roots.bronze, "media_metadata", first_day)
    for part, day in ((~late, first_day), (late, DAY)):
        bronze.write_bronze(events.filter(part), roots.bronze, "events", first_day)
        daily.run(spark, roots, day)
    return daily.published(spark, roots.warehouse)[FACT].select(
        "event_key", "media_id", "visitor_key", "received_at", "event_date"
    )


# -- streams ---------------------------------------------------------------------------------


def stream_daily_trend(spark, sf):
    """Day and channel counts kept up by a file stream; replays come first, very late rows last."""
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")
    warehouse = Warehouse(spark, scratch_dir(spark, "stream"))
    late = F.col("received_at") < "2024-01-10"
    everything = samples.events(spark, sf)
    for part in (samples.replays(spark, sf), everything.filter(~late), everything.filter(late)):
        part = part.drop("_kind", "_received")
        part.write.mode("append").parquet(landing)
        stream = loads.parquet_stream(spark, landing, part.schema)
        loads.daily_trend_stream(
            stream, warehouse, "facts", "trend", checkpoint,
            prepare=lambda batch: star.clean_events(batch),
        )
    return loads.read_daily_trend(warehouse, "trend", dim_media(spark, sf, stats=False))


def publish_two_sources(spark, sf):
    """Two streams, each with a checkpoint of its own, into one table."""
    warehouse = Warehouse(spark, scratch_dir(spark, "streams"))
    schema = star.clean_events(samples.events(spark, sf)).schema
    clicks = F.col("user_agent_details.platform") == "click"
    for part in (clicks, ~clicks):
        landing = scratch_dir(spark, "landing")
        events = samples.events(spark, sf).filter(part)
        events.write.parquet(landing)
        loads.upsert_stream(
            loads.parquet_stream(spark, landing, events.schema), warehouse, "facts",
            ["event_key"], ["received_at"], scratch_dir(spark, "checkpoint"),
            partition_by="event_date", prepare=lambda batch: star.clean_events(batch),
        )
    return warehouse.read("facts", schema, "event_date").select(
        "event_key", "media_id", "received_at", "event_date", "percent_viewed"
    )


def stream_upsert(spark, sf):
    """Deliveries streamed in two batches of files; the table keeps the newest of each event."""
    landing = scratch_dir(spark, "landing")
    warehouse = Warehouse(spark, scratch_dir(spark, "stream"))
    checkpoint = scratch_dir(spark, "checkpoint")
    for deliveries in (samples.replays(spark, sf), samples.events(spark, sf)):
        deliveries.drop("_kind", "_received").write.mode("append").parquet(landing)
        stream = loads.parquet_stream(spark, landing, deliveries.drop("_kind", "_received").schema)
        loads.upsert_stream(
            stream, warehouse, "facts", ["event_key"], ["received_at"], checkpoint,
            partition_by="event_date", sort_by=("media_id",),
            prepare=lambda batch: star.clean_events(batch),
        )
    schema = star.clean_events(samples.events(spark, sf)).schema
    return warehouse.read("facts", schema, "event_date").select(
        "event_key", "media_id", "received_at", "event_date", "percent_viewed"
    )


def distinct_visitors(spark, sf):
    """Visitors per channel of eleven days, and of all days, from bitmaps that two loads kept up."""
    warehouse = Warehouse(spark, scratch_dir(spark, "visitors"))
    for deliveries in (samples.first_deliveries(spark, sf), samples.replays(spark, sf)):
        staged = stored(spark, star.clean_events(deliveries, tie_break=()), "staged")
        more, derived = daily.count_visitors_of(spark, warehouse, staged, "facts")
        facts_load = Load(staged, ["event_key"], "event_date", newest_by=("received_at",))
        warehouse.publish({"facts": facts_load, **more}, derived=derived)
    days = daily.published_visitors(spark, warehouse.root)
    in_range = reports.visitors_between(days, dim_media(spark, sf, stats=False), "2024-01-10", "2024-01-20")
    every = visitors.distinct_visitors(days).select(F.lit("all days").alias("channel"), "unique_visitors")
    return in_range.unionByName(every)


def bucketed_joins(spark, sf):
    """Declared tables: staged facts meet their visitors, published ones their videos."""
    names = tables.declare(spark, scratch_dir(spark, "declared"))
    loaded = {
        "dim_media": dim_media(spark, sf, stats=False),
        "dim_visitor": dim_visitor(spark, sf),
        FACT: fact(spark, sf),
    }
    for table, df in loaded.items():
        tables.fill_staging(names, table, df)
        tables.insert_from_staging(spark, names, table)
    counted, placed = tables.joins(spark, names)
    of_visitors = counted.select(
        F.lit("visitor").alias("side"), F.col("event_key").alias("key"), F.col("play_count").cast("long").alias("n")
    )
    of_channels = placed.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))
    return of_visitors.unionByName(of_channels.select(F.lit("channel").alias("side"), F.col("channel").alias("key"), "n"))


def drifting(spark, sf):
    """Two days of event documents as raw text; on the second a field is gone, one is new, and
    shares are numbers."""
    root = scratch_dir(spark, "drift")
    events = samples.first_deliveries(spark, sf)
    early = events.select(*[c for c in RAW["events"].names if c != "user_agent_details"])
    late = early.withColumn("percent_viewed", F.col("percent_viewed").cast("double")).drop("city", "embed_url")
    late = late.withColumn("device", F.struct(F.col("region").alias("seen_in")))
    for day, part in (("2024-01-31", early), (DAY, late)):
        part.select(F.to_json(F.struct("*")).alias("value")).write.option("compression", "gzip").text(
            bronze.day_path(root, "events", day)
        )
    documents = bronze.read_variants(spark, root, "events", ["2024-01-31", DAY])
    return drift.drift(drift.field_kinds(documents), "2024-01-31", DAY)


def snapshot_changes(spark, sf):
    """Videos pulled whole twice: what is new, changed, gone or the same."""
    old = dim_media(spark, sf, stats=False).filter("project_name <> 'Brand#1'")
    new = dim_media(spark, sf, stats=False).filter("section_name <> 'SMALL'")
    new = new.withColumn("status", F.expr("IF(status = 'archived', 'deleted', status)"))
    new = new.withColumn("load_date", F.date_add("load_date", 1))
    return snapshots.compare(old, new, "media_id", leave_out=("load_date",))


def evolving_parts(spark, sf):
    """Three days of events as parts whose columns change: one comes, one goes, one widens."""
    root = scratch_dir(spark, "parts")
    rows = samples.table(spark, sf, "events").select(
        F.col("event_id"), F.col("user_id"), F.col("event_type"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    day = F.pmod("event_id", F.lit(3))
    shapes = {
        "day1": rows.filter(day == 0).select("event_id", "k", "event_type"),
        "day2": rows.filter(day == 1).select("event_id", F.col("k").cast("long").alias("k"), "event_type", "user_id"),
        "day3": rows.filter(day == 2).select("user_id", F.col("k").cast("long").alias("k"), "event_id"),
    }
    for name, part in shapes.items():
        part.write.parquet(f"{root}/{name}")
    return silver.read_parts(spark, [f"{root}/{name}" for name in shapes])


def with_functions(spark, sf, text, **args):
    """SQL over the views and functions of a session."""
    reports.register_views({"dim_media": dim_media(spark, sf, stats=False), FACT: facts(spark, sf)})
    reports.register_functions(spark)
    return spark.sql(text, args=args)


SQL_RANGE = {"first": dt.date(2024, 1, 10), "last": dt.date(2024, 1, 20)}


def stats_by_path(spark, sf):
    """Statistics documents that name no video: their ids come from their paths."""
    root = scratch_dir(spark, "by-path")
    sizes = samples.table(spark, sf, "part").groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"))
    counted = sizes.select(
        F.concat_ws(" ", "p_brand", F.col("p_size").cast("string")).alias("video"),
        F.lit(None).cast("string").alias("media_id"),
        F.col("n").cast("string").alias("play_count"),
        *[F.lit(None).cast("string").alias(c) for c in RAW["media_stats"].names[2:]],
    )
    bronze.write_bronze(counted, root, "media_stats", DAY, "video")
    back = bronze.read_bronze(spark, root, "media_stats", [DAY])
    return back.select("media_id", F.col("play_count").cast("long").alias("plays"))


def tracked_setting(spark, sf):
    """Facts of the videos that a setting lists."""
    kept = facts(spark, sf).select("event_key", "media_id")
    return tracked_only(kept, " 1, 7,,42 , 99,none ")


def empty_builds(spark, sf):
    """Tables of the days that a build may write: one that gives no row is refused."""
    root, rows = scratch_dir(spark, "empty"), []
    built = dim_media(spark, sf, stats=False)
    for status in ("ready", "archived", "deleted"):
        part = built.filter(F.col("status") == status).withColumn("load_date", F.to_date(F.lit(DAY)))
        try:
            silver.write_silver(part, f"{root}/{status}", "dim_media")
            n = silver.read_silver(spark, f"{root}/{status}", "dim_media", DAY).count()
        except silver.EmptyTable:
            n = None
        rows.append((status, n))
    return spark.createDataFrame(rows, "status string, written long")


def gated_stream(spark, sf):
    """Two batches of event documents, those of one kind cut short: what is published, what is
    kept aside, and what the log of batches counts."""
    root, quarantine = scratch_dir(spark, "bronze"), scratch_dir(spark, "quarantine")
    warehouse, checkpoint = Warehouse(spark, scratch_dir(spark, "gated")), scratch_dir(spark, "checkpoint")
    events = samples.first_deliveries(spark, sf)
    line = F.to_json(F.struct(*RAW["events"].names))
    torn = F.when(F.col("_kind") == "error", F.expr("left(line, length(line) - 3)"))
    lines = events.select("_kind", line.alias("line")).select(F.coalesce(torn, "line").alias("value"))
    early = lines.filter(F.col("value").contains('"region":"AFRICA"'))
    late = lines.filter(~F.col("value").contains('"region":"AFRICA"'))
    for day, part in (("2024-01-31", early), (DAY, late)):
        writer = part.write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
        writer.text(bronze.day_path(root, "events", day))
        loads.gated_upsert_stream(
            loads.bronze_stream(spark, root, "events", lines=True, keep_broken=True), warehouse,
            "events", ["event_key"], ["received_at"], checkpoint, quarantine,
            prepare=lambda batch: star.clean_events(batch), partition_by="event_date",
            known_media=dim_media(spark, sf, stats=False),
        )
    schema = star.clean_events(bronze.empty(spark, "events")).schema
    taken = warehouse.read(FACT, schema, "event_date").select(F.lit("published").alias("place"), "event_key")
    kept = spark.read.option("recursiveFileLookup", True).parquet(f"{quarantine}/broken_events")
    key = F.nullif(F.regexp_extract("_broken", '"event_key":"([^"]*)"', 1), F.lit(""))
    log = warehouse.read(loads.BATCHES_TABLE, BATCHES)
    counted = [
        log.agg(F.sum(c).cast("string").alias("event_key")).select(F.lit(c).alias("place"), "event_key")
        for c in ("rows", "no_key", "broken")
    ]
    parts = [taken, kept.select(F.lit("broken").alias("place"), key.alias("event_key")), *counted]
    return reduce(DataFrame.unionByName, parts)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    built: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "channel_derivation": channel_derivation,
        "dim_media_build": dim_media,
        "media_without_stats": media_without_stats,
        "media_metadata_only": media_metadata_only,
        "dim_visitor_build": dim_visitor,
        "dim_visitor_mode": partial(dim_visitor, geo="mode"),
        "visitor_geo_latest": partial(visitor_geo, geo="latest"),
        "visitor_geo_mode": partial(visitor_geo, geo="mode"),
        "fact_build": fact,
        "fact_without_visitors": fact_without_visitors,
        "replay_dedup_lineitem": replay_dedup_lineitem,
        "event_dates": event_dates,
        "engagement_daily": partial(report, reports.engagement_daily),
        "top_countries": partial(report, reports.top_countries),
        "kpi_media": lambda spark, sf: reports.kpi_media(dim_media(spark, sf)),
        "kpi_fact": lambda spark, sf: reports.kpi_fact(facts(spark, sf)),
        "channel_comparison": partial(report, reports.channel_comparison),
        "geo_top15": lambda spark, sf: reports.geo_top(facts(spark, sf)),
        "daily_trend": partial(report, reports.daily_trend),
        "depth_histogram": partial(report, reports.depth_histogram),
        "table_counts": table_counts,
        "sql_dashboard": sql_dashboard,
        "null_key_filter": null_key_filter,
        "null_pct_profile": null_pct_profile,
        "dq_report": dq_report,
        "orphan_facts": orphan_facts,
        "orphan_count": orphan_count,
        "duplicate_keys": duplicate_keys,
        "constraint_violations": constraint_violations,
        "cast_failures": cast_failures,
        "upsert_fact": upsert_fact,
        "upsert_idempotent": upsert_idempotent,
        "delete_using": delete_using,
        "publish_replays": publish_replays,
        "staging_load": staging_load,
        "declared_replays": declared_replays,
        "incremental_filter": incremental_filter,
        "late_rows": late_rows,
        "pull_and_publish": pull_and_publish,
        "broken_documents": broken_documents,
        "full_refresh": full_refresh,
        "rerun_older_day": rerun_older_day,
        "publish_two_sources": publish_two_sources,
        "next_watermark": next_watermark,
        "path_media_id": path_media_id,
        "json_props": json_props,
        "media_allow_list": media_allow_list,
        "json_bronze_roundtrip": json_bronze_roundtrip,
        "silver_roundtrip": silver_roundtrip,
        "landed_documents": landed_documents,
        "daily_load": daily_load,
        "late_files": late_files,
        "stream_daily_trend": stream_daily_trend,
        "stream_upsert": stream_upsert,
        "gated_stream": gated_stream,
        "distinct_visitors": distinct_visitors,
        "bucketed_joins": bucketed_joins,
        "schema_drift": drifting,
        "snapshot_changes": snapshot_changes,
        "evolving_parts": evolving_parts,
        "sql_geo_range": partial(
            with_functions, text="SELECT * FROM geo_top(:first, :last, :k)", k=7, **SQL_RANGE
        ),
        "sql_depth_range": partial(
            with_functions, text="SELECT * FROM depth_between(:first, :last)", **SQL_RANGE
        ),
        "sql_channels": partial(
            with_functions,
            text="SELECT derive_channel(name) AS channel, count(*) AS videos FROM dim_media GROUP BY 1",
        ),
        "stats_by_path": stats_by_path,
        "tracked_setting": tracked_setting,
        "empty_builds": empty_builds,
    }

    def wrapped(query, spark, sf_dir):
        return plain(query(apply_settings(spark), sf_dir.rstrip("/")))

    return {name: partial(wrapped, query) for name, query in built.items()}
