"""Physical plans: what is pruned, what is shuffled by what, and what happens to a hot key."""

from __future__ import annotations

import datetime as dt
import re
from collections import defaultdict
from contextlib import contextmanager
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from reelstar import queries as q
from reelstar.operators import incremental as inc
from reelstar.operators import quality, star
from reelstar.operators.latest import latest_by
from reelstar.plans import daily, reports
from reelstar.schemas import STAR
from reelstar.sources import samples, silver, warehouse
from reelstar.sources.warehouse import Warehouse


@contextmanager
def settings(spark, **values):
    values = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def no_broadcast(spark, **more):
    return settings(
        spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", **more
    )


def tiny_partitions(spark):
    """Thresholds that make small test data skewed."""
    return no_broadcast(
        spark,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="10k",
        adaptive__coalescePartitions__minPartitionSize="1k",
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("published"))
    loads = {
        "dim_media": daily.load("dim_media", q.dim_media(spark, SMALL)),
        q.FACT: daily.load(q.FACT, q.fact(spark, SMALL)),
    }
    Warehouse(spark, root).publish(loads)
    return daily.published(spark, root)


LAZY = sorted(
    set(q.all_queries())
    - {
        "daily_load", "json_bronze_roundtrip", "landed_documents", "publish_replays",
        "silver_roundtrip", "sql_dashboard", "staging_load", "stream_daily_trend", "stream_upsert",
    }
)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_in_the_plan_and_no_pairing_of_everything(spark, name):
    with no_broadcast(spark):
        text = plan(q.all_queries()[name](spark, SMALL))
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                 "BroadcastNestedLoopJoin", "Exchange SinglePartition, REPARTITION"):
        assert word not in text


def test_newest_row_is_limited_before_the_shuffle(spark):
    text = plan(latest_by(samples.table(spark, SMALL, "lineitem"), ["l_orderkey"], ["l_shipdate"]))
    assert text.count("WindowGroupLimit") == 2
    partial = text.index("Partial")
    assert text.index("Final") < text.index("Exchange hashpartitioning") < partial


def test_dimension_is_broadcast_only_below_the_threshold(spark, published):
    fact, media = published[q.FACT], published["dim_media"]
    small = plan(reports.channel_comparison(fact, media))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    with no_broadcast(spark):
        large = plan(reports.channel_comparison(fact, media))
    assert "SortMergeJoin" in large and "Broadcast" not in large


def test_reports_read_only_their_columns(spark, published):
    text = plan(reports.kpi_fact(published[q.FACT]))
    assert "ReadSchema: struct<visitor_key:string,percent_viewed:decimal(10,6)>" in text


def test_a_date_filter_prunes_partitions(spark, published):
    day = published[q.FACT].filter("event_date = date'2024-01-05'").groupBy("media_id").count()
    text = plan(day)
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", text)


def test_silver_reads_one_day(spark, tmp_path):
    silver.write_silver(q.dim_media(spark, SMALL), str(tmp_path), "dim_media")
    df = silver.read_silver(spark, str(tmp_path), "dim_media", q.DAY)
    assert re.search(r"PartitionFilters: \[[^\]]*load_date", plan(df))


def test_trend_counts_before_it_joins(spark, published):
    with no_broadcast(spark):
        text = plan(reports.daily_trend(published[q.FACT], published["dim_media"]))
    join = text.index("SortMergeJoin")
    assert "HashAggregate(keys=[event_date" in text[join:]


def test_top_countries_are_a_bounded_sort(spark, published):
    assert "TakeOrderedAndProject" in plan(reports.geo_top(published[q.FACT]))


def test_reports_against_plain_python(spark):
    """Every report over a dozen rows, added up by hand."""
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    people, places = ["p", "q", "r", None], ["DE", "FR", None]
    media = [("m1", "A", "YouTube", 10, 20, Decimal("1.25")), ("m2", "B", "Facebook", 5, None, Decimal("0.5")), ("m3", "C", "YouTube", None, None, None)]
    fact = [
        (f"e{i}", media[i % 2][0], people[i % 4], days[i % 3 == 0], places[i % 3], Decimal(i) / Decimal(11))
        for i in range(12)
    ]
    facts = spark.createDataFrame(fact, "event_key string, media_id string, visitor_key string, event_date date, country string, percent_viewed decimal(10,6)")
    videos = spark.createDataFrame(media, "media_id string, name string, channel string, total_plays long, total_loads long, hours_watched decimal(14,6)")
    channel = {m[0]: m[2] for m in media}
    shares = [float(round(f[5], 6)) for f in fact]

    def grouped(key):
        groups = defaultdict(list)
        for f, share in zip(fact, shares):
            groups[key(f, share)].append((f, share))
        return {
            k: (len(v), len({f[2] for f, _ in v} - {None}), sum(s for _, s in v) / len(v))
            for k, v in groups.items()
        }

    def got(df, *keys):
        return {tuple(r[k] for k in keys): r for r in df.collect()}

    by_channel = grouped(lambda f, s: (channel[f[1]],))
    found = got(reports.channel_comparison(facts, videos), "channel")
    assert {k: (r["events"], r["unique_visitors"]) for k, r in found.items()} == {k: v[:2] for k, v in by_channel.items()}
    assert all(abs(float(found[k]["avg_view_pct"]) - 100 * v[2]) < 0.0051 for k, v in by_channel.items())
    trend = grouped(lambda f, s: (f[3], channel[f[1]]))
    assert {k: r["events"] for k, r in got(reports.daily_trend(facts, videos), "event_date", "channel").items()} == {k: v[0] for k, v in trend.items()}
    depth = grouped(lambda f, s: (channel[f[1]], int(s * 10) * 10))
    assert {k: r["events"] for k, r in got(reports.depth_histogram(facts, videos), "channel", "bucket_pct").items()} == {k: v[0] for k, v in depth.items()}
    country = {k: v for k, v in grouped(lambda f, s: (channel[f[1]], f[4])).items() if k[1]}
    assert {k: (r["events"], r["unique_visitors"]) for k, r in got(reports.top_countries(facts, videos), "channel", "country").items()} == {k: v[:2] for k, v in country.items()}
    geo = {k: v for k, v in grouped(lambda f, s: (f[4],)).items() if k[0]}
    assert {k: (r["events"], r["unique_visitors"]) for k, r in got(reports.geo_top(facts), "country").items()} == {k: v[:2] for k, v in geo.items()}
    engaged = grouped(lambda f, s: (f[3], f[1]))
    assert {k: (r["total_events"], r["unique_visitors"]) for k, r in got(reports.engagement_daily(facts, videos), "event_date", "media_id").items()} == {k: v[:2] for k, v in engaged.items()}
    whole = reports.kpi_fact(facts).first()
    assert (whole["event_count"], whole["unique_visitors"]) == (12, 3)
    kpi = reports.kpi_media(videos).first()
    assert (kpi["total_plays"], kpi["total_loads"], float(kpi["total_hours"])) == (15, 20, 1.8)


def test_reports_are_views_for_sql(spark, published):
    reports.register_views(published)
    for view, report in (("v_engagement_daily", reports.engagement_daily), ("v_top_countries", reports.top_countries)):
        want = report(published[q.FACT], published["dim_media"])
        assert sorted(map(str, spark.table(view).collect())) == sorted(map(str, want.collect()))


def test_distinct_visitors_are_spread_by_visitor(spark, published):
    """A hot country or channel is never counted in one task: the first shuffle adds the visitor."""
    for df in (
        reports.geo_top(published[q.FACT]),
        reports.channel_comparison(published[q.FACT], published["dim_media"]),
        reports.engagement_daily(published[q.FACT], published["dim_media"]),
    ):
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(df))
        assert "visitor_key" in keys[-1]


def hot_events(spark):
    """A third of the events from one visitor, a third from nobody."""
    third = "pmod(hash(event_key), 3)"
    return samples.events(spark, SMALL).withColumn(
        "visitor_key", F.expr(f"CASE {third} WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE visitor_key END")
    )


def test_hot_and_missing_visitors_are_split(spark):
    people = star.latest_visitors(samples.visitors(spark, SMALL))
    small = star.build_fact(hot_events(spark), people, q.DAY)
    want = sorted(map(str, small.collect()))
    with tiny_partitions(spark):
        df = star.build_fact(hot_events(spark), people, q.DAY)
        got = sorted(map(str, df.collect()))
        text = plan(df)
    assert "SortMergeJoin(skew=true)" in text
    assert "hashpartitioning(visitor_key#" in text and "_spread#" in text
    assert got == want


def test_missing_visitors_do_not_share_a_partition(spark):
    people = star.latest_visitors(samples.visitors(spark, SMALL))
    with no_broadcast(spark, adaptive__enabled="false"):
        df = star.build_fact(hot_events(spark), people, q.DAY).filter("visitor_key IS NULL")
        sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 8
    assert max(r["count"] for r in sizes) < 2 * min(r["count"] for r in sizes)


def test_rows_of_a_hot_video_are_not_counted_in_one_task(spark):
    """New rows are counted after a join on the video; its partitioning is not reused then."""
    rows = spark.range(40000).selectExpr(
        "IF(id % 3 = 0, 'hot', 'm' || id % 500) AS media_id", "CAST(id % 50 + 1 AS int) AS page",
        "CAST(timestamp_micros(1704153600000000 + hash(id)) AS string) AS at",
    )
    marks = rows.select("media_id").distinct().selectExpr(
        "'events' AS endpoint", "media_id", "'2024-01-01T00:00:00Z' AS high_water"
    )
    new = lambda: inc.with_marks(rows, marks, "events", "at").filter("_is_new")
    pulled = lambda: new().groupBy("media_id", "page").count()
    want = {tuple(r) for r in pulled().collect()}
    with tiny_partitions(spark):
        df = pulled()
        got = {tuple(r) for r in df.collect()}
        text = plan(df)
    assert "SortMergeJoin(skew=true)" in text
    assert "hashpartitioning(media_id#" in text and got == want


def test_hot_video_is_split_in_the_channel_report(spark):
    """Also where the dimension is built in the same plan and too large to broadcast."""
    viewed = q.facts(spark, SMALL).withColumn(
        "media_id", F.expr("IF(pmod(hash(event_key), 3) = 0, '7', media_id)")
    )
    media = q.dim_media(spark, SMALL, stats=False)
    want = reports.channel_comparison(viewed, media).collect()
    with tiny_partitions(spark), settings(
        spark, adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
        adaptive__advisoryPartitionSizeInBytes="1k",
    ):
        df = reports.channel_comparison(viewed, media)
        got = df.collect()
        text = plan(df)
    assert "SortMergeJoin(skew=true)" in text and got == want


def test_published_dates_are_written_by_more_than_one_task_when_large(spark, tmp_path):
    """A date with most of the rows is split over files, small dates are not."""
    rows = spark.range(60000).selectExpr(
        "CAST(id AS string) AS k", "IF(id % 10 < 9, date'2024-01-01', date'2024-01-02') AS day",
        "CAST(id AS int) AS v",
    )
    from reelstar.sources.warehouse import Load

    with settings(spark, adaptive__advisoryPartitionSizeInBytes="100k",
                  adaptive__coalescePartitions__minPartitionSize="1k"):
        Warehouse(spark, str(tmp_path)).publish({"t": Load(rows, ["k"], "day", ("k",))})
    files = {d: len(list(tmp_path.glob(f"t/*/day={d}/*.parquet"))) for d in ("2024-01-01", "2024-01-02")}
    assert files["2024-01-01"] > 2 and files["2024-01-02"] <= 2


def test_events_are_read_by_their_own_tasks_and_not_broadcast(spark):
    for df in (samples.events(spark, SMALL), samples.replays(spark, SMALL)):
        joins = re.findall(r"BroadcastHashJoin \[(\w+)#.*(BuildLeft|BuildRight)", plan(df))
        assert sorted(joins) == [
            ("c_nationkey", "BuildRight"), ("n_regionkey", "BuildRight"), ("user_id", "BuildRight")
        ]


def test_landed_lines_are_cut_into_files_for_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(q, "LINES_PER_FILE", 100, raising=False)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("bronze-*"))
    rows = q.gated_stream(spark, SMALL).groupBy("place").count()
    counts = {r["place"]: r["count"] for r in rows.collect()}
    (root,) = set(shared.glob("bronze-*")) - before
    lines = counts["published"] + counts["broken"]
    assert len([*root.rglob("*.txt.gz")]) >= lines / 100 > 5


def many(spark, table, n, name="a"):
    """Rows of a table as a load finds them: many short keys in small files."""
    key = daily.KEYS[table]
    made = {key: F.col("id").cast("string"), "media_id": F.col("id").cast("string"),
            "event_date": F.lit("2024-01-05"), "load_date": F.lit("2024-02-01"), "name": F.lit(name),
            "received_at": F.lit("2024-01-05 00:00:00"), "updated_at": F.lit("2024-01-05 00:00:00")}
    fields = STAR[table].fields
    rows = spark.range(n).select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )
    return daily.stored(spark, rows, "many")


@pytest.fixture()
def stored_plans(monkeypatch):
    """Plans of what the warehouse and the daily run write, by label or table."""
    found = defaultdict(list)

    def stored(spark, df, label, write=daily.stored):
        found[label].append(plan(df))
        return write(spark, df, label)

    def _write(self, table, rows, *rest, write=Warehouse._write):
        found[table].append(plan(rows))
        return write(self, table, rows, *rest)

    monkeypatch.setattr(daily, "stored", stored)
    monkeypatch.setattr(warehouse, "stored", stored)
    monkeypatch.setattr(Warehouse, "_write", _write)
    return found


@pytest.mark.parametrize("table", ["dim_media", q.FACT])
def test_only_a_load_of_few_rows_is_broadcast(spark, tmp_path, stored_plans, table):
    """The keys of a large load would be gathered on the driver, though their files are small."""
    to = Warehouse(spark, str(tmp_path))
    to.publish({table: daily.load(table, many(spark, table, 300_000))})
    for n, kind in ((300_000, "SortMergeJoin"), (100, "BroadcastHashJoin")):
        stored_plans.clear()
        to.publish({table: daily.load(table, many(spark, table, n, "b"))})
        joins = [x for plans in stored_plans.values() for p in plans for x in re.findall(r"\w+Join", p)]
        assert len(joins) > 2 and set(joins) == {kind}, stored_plans
    rows = to.read(table, STAR[table], daily.PARTITION_BY.get(table))
    assert rows.count() == rows.select(daily.KEYS[table]).distinct().count() == 300_000


def test_many_new_videos_are_not_broadcast(spark, tmp_path, stored_plans):
    roots = daily.Roots(*(str(tmp_path / x) for x in ("landing", "bronze", "silver", "warehouse")))
    for n, kind in ((300_000, "SortMergeJoin"), (100, "BroadcastHashJoin")):
        changed, _ = daily._changes(spark, roots, many(spark, "dim_media", n), q.DAY)
        assert changed.count() == n
        assert re.findall(r"\w+Join", stored_plans["changed"].pop()) == [kind]


def test_orphans_are_counted_without_a_broadcast_of_the_videos(spark, published):
    text = plan(quality.orphan_count(published[q.FACT], published["dim_media"]))
    assert "SortMergeJoin" in text and "Broadcast" not in text
