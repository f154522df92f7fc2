"""Visitor bitmaps, snapshot differences, drift of fields, parts of different columns, SQL functions."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from conftest import SMALL
from pyspark.errors import PySparkException
from test_bronze import put
from test_daily import event, media, published, visitor
from test_plans import no_broadcast, plan, settings

from reelstar import queries as q
from reelstar import session
from reelstar.operators import drift, snapshots, upsert, visitors
from reelstar.operators.quality import QualityGateError
from reelstar.plans import daily, reports
from reelstar.sources import bronze, silver, tables
from reelstar.sources.warehouse import Warehouse

FACT = "fact_media_engagement"


@pytest.fixture()
def roots(tmp_path):
    names = ("landing", "bronze", "silver", "warehouse", "quarantine")
    return daily.Roots(*(str(tmp_path / n) for n in names))


@pytest.fixture()
def bronze_root(tmp_path):
    return tmp_path / "bronze"


# -- visitors --------------------------------------------------------------------------------

SEEN = "event_date date, media_id string, visitor_key string"


def seen_rows(n=3000, people=900, seed=3):
    rng = random.Random(seed)
    who = lambda: rng.choice(["hot", None, f"v{rng.randrange(people)}"])
    return [(dt.date(2024, 1, rng.randint(1, 9)), f"m{rng.randrange(4)}", who()) for _ in range(n)]


def test_bitmaps_count_any_range(spark):
    rows = seen_rows()
    facts = spark.createDataFrame(rows, SEEN)
    none = spark.createDataFrame([], visitors.NUMBERS)
    numbers = visitors.new_numbers(facts, none)
    given = {r["visitor_key"]: r["visitor_no"] for r in numbers.collect()}
    assert len(set(given.values())) == len(given) == len({k for _, _, k in rows if k})
    days = visitors.visitor_days(facts, numbers)
    for first, last in ((1, 9), (3, 5), (7, 7), (10, 12)):
        of = days.filter(f"day(event_date) BETWEEN {first} AND {last}")
        inside = [r for r in rows if first <= r[0].day <= last]
        assert visitors.distinct_visitors(of).first()[0] == len({k for _, _, k in inside if k})
        want = {m: len({k for _, n, k in inside if n == m and k}) for m in {r[1] for r in inside}}
        got = visitors.distinct_visitors(of, ["media_id"]).collect()
        assert {r["media_id"]: r["unique_visitors"] for r in got} == {m: n for m, n in want.items() if n}


def test_numbers_are_kept_and_stay_dense(spark):
    first = spark.createDataFrame(seen_rows(), SEEN)
    old = visitors.new_numbers(first, spark.createDataFrame([], visitors.NUMBERS)).collect()
    known = spark.createDataFrame(old, visitors.NUMBERS)
    more = spark.createDataFrame(seen_rows(people=2500, seed=4), SEEN)
    new = visitors.new_numbers(more, known).collect()
    assert not {r["visitor_key"] for r in old} & {r["visitor_key"] for r in new}
    numbers = [r["visitor_no"] for r in (*old, *new)]
    assert len(set(numbers)) == len(numbers) and max(numbers) < 12 * visitors.ROWS
    assert visitors.new_numbers(first, known).count() == 0


def test_a_touched_day_rewrites_only_its_own_bitmaps(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "events", "m1", [event("e1"), event("e2", at="2026-04-19T10:00:00Z", who="v2")], page=1)
    daily.run(spark, roots, "2026-04-20", count_visitors=True)
    warehouse = Warehouse(spark, roots.warehouse)
    folders = lambda: {p: f for t, p, f, _ in warehouse._current() if t == daily.VISITOR_DAYS_TABLE}
    before = folders()
    assert set(before) == {"2026-04-19", "2026-04-20"}
    put(bronze_root, "events", "m1", [event("e3", at="2026-04-20T11:00:00Z", who="v3")], page=1, day="2026-04-21")
    daily.run(spark, roots, "2026-04-21", count_visitors=True)
    after = folders()
    assert after["2026-04-19"] == before["2026-04-19"] and after["2026-04-20"] != before["2026-04-20"]
    days = daily.published_visitors(spark, roots.warehouse)
    dim = published(spark, roots, "dim_media")
    count = lambda a, b: [tuple(r) for r in reports.visitors_between(days, dim, a, b).collect()]
    assert count("2026-04-20", "2026-04-20") == [("YouTube", 2)]
    assert count("2026-04-01", "2026-04-30") == [("YouTube", 3)]
    text = plan(reports.visitors_between(days, dim, "2026-04-20", "2026-04-20"))
    assert FACT not in text and "visitor_key" not in text
    assert "event_date" in text.split("PartitionFilters")[1][:200]


# -- snapshots -------------------------------------------------------------------------------


def test_changes_between_snapshots(spark):
    schema = "k string, a int, b string, load_date date"
    day = dt.date(2024, 1, 1)
    old = spark.createDataFrame([("s", 1, None, day), ("c", 1, None, day), ("g", 1, "x", day), ("n", None, "1", day), (None, 1, "", day)], schema)
    new = spark.createDataFrame([("s", 1, None, None), ("c", None, "1", day), ("n", 1, None, day), ("w", 1, "x", day), (None, 2, "", day)], schema)
    found = snapshots.compare(old, new, "k", ("load_date",))
    assert {r["k"]: r["change"] for r in found.collect()} == {"s": "same", "c": "changed", "g": "gone", "n": "changed", "w": "new"}
    assert {r["k"] for r in snapshots.to_publish(new, found, "k").collect()} == {"c", "n", "w"}
    none = old.limit(0)
    assert {r["change"] for r in snapshots.compare(none, new, "k").collect()} == {"new"}
    assert snapshots.compare(none, none, "k").count() == 0


def test_unchanged_videos_are_not_published_again(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1", "m2", "m3")
    daily.run(spark, roots, "2026-04-20")
    warehouse = Warehouse(spark, roots.warehouse)
    folders = lambda: {p: f for t, p, f, _ in warehouse._current() if t == "dim_media"}
    before = folders()
    media(bronze_root, "2026-04-21", "m1", "m2")
    put(bronze_root, "media_metadata", "m2", {"hashed_id": "m2", "name": "facebook", "created": "2026-01-01T00:00:00Z"}, day="2026-04-21")
    report = daily.run(spark, roots, "2026-04-21")
    lines = {r["check"]: r["value"] for r in report if r["check"].endswith("_videos")}
    assert lines == {"new_videos": 0.0, "changed_videos": 1.0, "gone_videos": 1.0}
    changed = [p for p, f in folders().items() if before.get(p) != f]
    assert len(changed) == 1
    got = {r["media_id"]: (r["channel"], str(r["load_date"])) for r in published(spark, roots, "dim_media").collect()}
    assert got == {"m1": ("YouTube", "2026-04-20"), "m2": ("Facebook", "2026-04-21"), "m3": ("YouTube", "2026-04-20")}
    gone = spark.read.parquet(f"{roots.quarantine}/gone_dim_media").collect()
    assert [r["media_id"] for r in gone] == ["m3"]


# -- drift -----------------------------------------------------------------------------------


def test_drift_of_fields(spark, tmp_path):
    put(tmp_path, "events", "m1", [{"event_key": "a", "lat": 1, "note": None, "city": "x"}, {"event_key": "b", "lat": 1.5}], page=1, indent=1)
    put(tmp_path, "events", "m1", [{"event_key": "c", "lat": "n/a", "note": "t", "tags": []}, {}], page=1, day="2026-04-21")
    (tmp_path / bronze.document_key("events", "m1", "2026-04-21", 2)).write_text('[{"event_key": "d", ')
    put(tmp_path, "visitors", "m1", [], page=1, day="2026-04-21")
    docs = bronze.read_variants(spark, str(tmp_path), "events", ["2026-04-20", "2026-04-21"])
    kinds = drift.field_kinds(docs.unionByName(bronze.read_variants(spark, str(tmp_path), "visitors", ["2026-04-21"])))
    found = {tuple(r) for r in drift.drift(kinds, "2026-04-20", "2026-04-21").collect()}
    assert found == {
        ("events", "lat", "type", "NUMBER", "STRING", 1), ("events", "city", "gone", "STRING", None, 0),
        ("events", "tags", "new", None, "ARRAY", 1),
    }
    assert drift.drift(kinds, "2026-04-20", "2026-04-22").count() == 0
    empty = bronze.read_variants(spark, str(tmp_path), "events", ["2020-01-01"])
    assert drift.field_kinds(empty).count() == 0


def test_required_field_that_is_gone_fails_the_run(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "visitors", "m1", [visitor("v1")], page=1)
    without = {k: v for k, v in event("e1").items() if k != "percent_viewed"}
    put(bronze_root, "events", "m1", [without], page=1)
    with pytest.raises(QualityGateError, match="events.percent_viewed required_field"):
        daily.run(spark, roots, "2026-04-20", check_fields=True)
    assert Warehouse(spark, roots.warehouse).version() == 0
    put(bronze_root, "events", "m1", [without, event("e2")], page=1)
    report = daily.run(spark, roots, "2026-04-20", check_fields=True)
    assert {r["column"]: r["value"] for r in report if r["check"] == "required_field" and r["table"] == "events"} == {
        "event_key": 2.0, "media_id": 2.0, "visitor_key": 2.0, "received_at": 2.0, "percent_viewed": 1.0}


# -- parts -----------------------------------------------------------------------------------


def test_parts_of_different_columns(spark, tmp_path):
    paths = [str(tmp_path / n) for n in "abc"]
    spark.sql("SELECT 1 AS k, CAST(1.5 AS float) AS f, CAST(1 AS decimal(5,2)) AS d").write.parquet(paths[0])
    spark.sql("SELECT 5000000000 AS k, 'x' AS s, CAST(2 AS decimal(9,4)) AS d").write.parquet(paths[1])
    spark.sql("SELECT CAST(7 AS bigint) AS k, CAST(2.25 AS double) AS f").write.parquet(paths[2])
    df = silver.read_parts(spark, paths)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("k", "bigint"), ("f", "double"), ("d", "decimal(9,4)"), ("s", "string")]
    got = {r["k"]: (r["f"], None if r["d"] is None else float(r["d"]), r["s"]) for r in df.collect()}
    assert got == {1: (1.5, 1.0, None), 5000000000: (None, 2.0, "x"), 7: (2.25, None, None)}
    with pytest.raises(silver.Narrowed, match="k: bigint became int"):
        silver.read_parts(spark, paths[::-1])
    text = plan(df.filter("k > 3").select("k"))
    assert "PushedFilters: [IsNotNull(k), GreaterThan(k,3)]" in text and "ReadSchema: struct<k:bigint>" in text


# -- declared tables -------------------------------------------------------------------------


def test_declared_tables_are_joined_without_shuffling_facts(spark, tmp_path):
    names = tables.declare(spark, str(tmp_path), buckets=4)
    built = {"dim_media": q.dim_media(spark, SMALL, stats=False), "dim_visitor": q.dim_visitor(spark, SMALL), FACT: q.fact(spark, SMALL)}
    for table, df in built.items():
        tables.fill_staging(names, table, df, buckets=4)
        tables.insert_from_staging(spark, names, table, buckets=4)
    with no_broadcast(spark, adaptive__enabled="false"):
        for df in tables.joins(spark, names):
            text = plan(df)
            assert "SortMergeJoin" in text and "Exchange" not in text
            assert df.count() > 0
    files = list((tmp_path / "stg_fact_media_engagement").glob("*.parquet"))
    assert 0 < len(files) <= 4  # a file for each bucket


def dated_facts(spark, rows):
    """Facts of (event, date), with NULLs besides."""
    fields = q.fact(spark, SMALL).schema
    frame = spark.createDataFrame(rows, "event_key string, day string")
    values = {"event_key": "event_key", "event_date": "day", "media_id": "'m1'", "visitor_key": "'v1'"}
    return frame.selectExpr(*[f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields])


def test_a_declared_load_rewrites_only_its_dates(spark, tmp_path):
    names = tables.declare(spark, str(tmp_path), buckets=2)

    def load(rows):
        tables.fill_staging(names, FACT, dated_facts(spark, rows), buckets=2)
        tables.insert_from_staging(spark, names, FACT, buckets=2)
        return sorted((r[0], str(r[1])) for r in spark.table(names[FACT]).select("event_key", "event_date").collect())

    files = lambda day: {f.name for f in (tmp_path / FACT / f"event_date={day}").glob("*.parquet")}
    days = [f"2024-01-0{d}" for d in range(1, 6)]
    first = [(f"e{d}{k}", day) for d, day in enumerate(days) for k in range(3)] + [("alone", "2024-02-01"), ("undated", None), (None, days[0])]
    have = load(first)
    assert have == sorted((k, str(d)) for k, d in first if k)
    before = {day: files(day) for day in days}
    # one row moves from the third day to the second, one leaves its day empty, one is new
    have = load([("e20", days[1]), ("alone", days[1]), ("new", "2024-03-01")])
    want = {k: str(d) for k, d in first if k} | {"e20": days[1], "alone": days[1], "new": "2024-03-01"}
    assert have == sorted(want.items())
    after = {day: files(day) for day in days}
    assert {day for day in days if before[day] != after[day]} == {days[1], days[2]}
    assert load([("e20", days[1]), ("alone", days[1]), ("new", "2024-03-01")]) == have
    assert load([]) == have
    want["undated"] = days[4]
    assert load([("undated", days[4])]) == sorted(want.items())


def test_touched_dates_are_pruned_when_run(spark, tmp_path):
    names = tables.declare(spark, str(tmp_path), buckets=2)
    rows = [(f"e{k}", f"2024-01-{1 + k % 20:02d}") for k in range(200)]
    tables.fill_staging(names, FACT, dated_facts(spark, rows), buckets=2)
    tables.insert_from_staging(spark, names, FACT, buckets=2)
    target, staged = spark.table(names[FACT]), dated_facts(spark, rows[:1])
    touched = session.stored(spark, upsert.touched_parts(target, staged, ["event_key"], "event_date"), "touched")
    old = upsert.in_parts(target, touched, "event_date")
    assert old.count() == 10
    old.collect()
    text = plan(old)
    assert "dynamicpruningexpression" in text.split("PartitionFilters: ")[1][:200]
    scanned = upsert.touched_parts(target, staged, ["event_key"], "event_date")
    read = plan(scanned).split("ReadSchema: ")[1:]
    assert all("media_id" not in part[:100] for part in read if "event_key" in part[:100])


# -- SQL functions ---------------------------------------------------------------------------


def test_functions_for_sql_users(spark, tmp_path):
    root = str(tmp_path)
    loads = {t: daily.load(t, df) for t, df in (("dim_media", q.dim_media(spark, SMALL, stats=False)), (FACT, q.fact(spark, SMALL)))}
    Warehouse(spark, root).publish(loads)
    star = daily.published(spark, root)
    reports.register_views(star)
    reports.register_functions(spark)
    fact, dim = star[FACT], star["dim_media"]
    whole = {"first": dt.date(2000, 1, 1), "last": dt.date(2100, 1, 1)}
    rows = lambda df: sorted(map(tuple, df.collect()))
    sql = lambda text, **args: spark.sql(text, args={**whole, **args})
    as_double = reports.channel_comparison(fact, dim).selectExpr("channel", "events", "unique_visitors", "CAST(avg_view_pct AS double)")
    assert rows(sql("SELECT * FROM channel_comparison_between(:first, :last)")) == rows(as_double)
    assert rows(sql("SELECT * FROM daily_trend_between(:first, :last)")) == rows(reports.daily_trend(fact, dim))
    assert rows(sql("SELECT channel, bucket_pct, events FROM depth_between(:first, :last)")) == rows(reports.depth_histogram(fact, dim))
    assert rows(sql("SELECT * FROM countries_between(:first, :last)")) == rows(reports.top_countries(fact, dim))
    top = reports.geo_top(fact, 3).selectExpr("country", "events", "unique_visitors", "CAST(avg_view_pct AS double)")
    assert rows(sql("SELECT * FROM geo_top(:first, :last, :k)", k=3)) == rows(top)
    day = dt.date(2024, 1, 10)
    text = plan(spark.sql("SELECT * FROM daily_trend_between(:first, :last)", args={"first": day, "last": day}))
    pruned = [part[:200] for part in text.split("PartitionFilters: ")[1:] if "event_date" in part[:200]]
    assert pruned and "2024-01-10" in pruned[0]
    titles = spark.sql("SELECT derive_channel('My YOUTUBE x'), derive_channel('FaceBook'), derive_channel(''), derive_channel(NULL), depth_bucket(0.999), depth_bucket(1)")
    assert tuple(titles.first()) == ("YouTube", "Facebook", "Unknown", "Unknown", 90, 100)
