"""Whole runs over small bronze and landing trees."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from compare import connect, rows_of_spark, rows_of_sql
from conftest import SMALL
from test_bronze import put

from reelstar.operators.quality import QualityGateError
from reelstar.oracles import all_oracles
from reelstar.plans import daily
from reelstar.queries import all_queries
from reelstar.schemas import MARKS
from reelstar.sources.bronze import day_path
from reelstar.sources.warehouse import Warehouse

FACT = "fact_media_engagement"


@pytest.fixture()
def roots(tmp_path):
    names = ("landing", "bronze", "silver", "warehouse", "quarantine")
    return daily.Roots(*(str(tmp_path / n) for n in names))


@pytest.fixture()
def bronze_root(tmp_path):
    return tmp_path / "bronze"


def media(root, day, *ids):
    for m in ids:
        put(root, "media_metadata", m, {
            "hashed_id": m, "name": f"{m} youtube", "created": "2026-01-01T00:00:00Z"}, day=day)
        put(root, "media_stats", m, {"play_count": 1, "hours_watched": 0.5}, day=day)


def visitor(key, count=1):
    return {"visitor_key": key, "created_at": "2026-04-01T00:00:00Z", "last_active_at": "2026-04-02T00:00:00Z",
            "load_count": count, "play_count": count, "user_agent_details": {"browser": "F", "platform": "mac"}}


def event(key, media_id="m1", at="2026-04-20T10:00:00Z", who="v1", share=0.5):
    return {"event_key": key, "media_id": media_id, "visitor_key": who, "received_at": at,
            "percent_viewed": share, "country": "DE"}


def published(spark, roots, table=FACT):
    return daily.published(spark, roots.warehouse)[table]


def test_two_days_with_a_replay(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "visitors", "m1", [visitor("v1")], page=1)
    put(bronze_root, "events", "m1", [event("e1"), {**event("e2"), "lat": "north"}, {}], page=1)
    report = daily.run(spark, roots, "2026-04-20")
    assert all(r["status"] == "ok" for r in report)
    failed = [r for r in report if r["check"] == "failed_casts" and r["value"] > 0]
    assert [(r["table"], r["column"], r["value"]) for r in failed] == [("events", "lat", 1.0)]
    assert published(spark, roots).count() == 2

    # next day: m1 is not pulled again, e2 is replayed on another date, a visitor is unknown
    put(bronze_root, "events", "m1", [
        event("e2", at="2026-04-21T09:00:00Z", share=0.9), event("e3", at="2026-04-21T10:00:00Z", who="v9"),
    ], page=1, day="2026-04-21")
    daily.run(spark, roots, "2026-04-21")
    got = {r["event_key"]: r for r in published(spark, roots).collect()}
    assert set(got) == {"e1", "e2", "e3"}
    assert str(got["e2"]["event_date"]) == "2026-04-21" and float(got["e2"]["percent_viewed"]) == 0.9
    assert got["e1"]["visitor_play_count"] == 1 and got["e2"]["visitor_play_count"] is None
    assert published(spark, roots, "dim_visitor").count() == 1

    # a rerun of the same day changes nothing
    daily.run(spark, roots, "2026-04-21")
    assert published(spark, roots).count() == 3

    # counters may come from all visitors published so far
    known = published(spark, roots, "dim_visitor")
    daily.run(spark, roots, "2026-04-21", accumulated_visitors=known)
    again = {r["event_key"]: r for r in published(spark, roots).collect()}
    assert again["e2"]["visitor_play_count"] == 1 and again["e3"]["visitor_play_count"] is None


def test_failed_gate_publishes_nothing(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "events", "m1", [event("e1"), event("e2", media_id="unknown")], page=1)
    with pytest.raises(QualityGateError, match="orphan_media"):
        daily.run(spark, roots, "2026-04-20")
    assert Warehouse(spark, roots.warehouse).version() == 0
    # the video arrives a day later; the failed day is taken in with it
    media(bronze_root, "2026-04-21", "m1", "unknown")
    daily.run(spark, roots, "2026-04-21", days=["2026-04-20", "2026-04-21"])
    assert published(spark, roots).count() == 2


def test_quiet_day(spark, roots):
    assert daily.run(spark, roots, "2026-04-20") == []
    assert Warehouse(spark, roots.warehouse).version() == 0


def land(roots, endpoint, media_id, page, rows, day="2026-04-20"):
    folder = Path(day_path(roots.landing, endpoint, day))
    folder.mkdir(parents=True, exist_ok=True)
    document = {"media_id": media_id, "page": page, "rows": rows}
    (folder / f"{media_id}-{page}.json").write_text(json.dumps(document, indent=1))


def test_pull_moves_marks_with_the_publish(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    land(roots, "visitors", "m1", 1, [visitor("v1")])
    land(roots, "visitors", "m2", 1, [visitor("v2")])  # not tracked
    land(roots, "events", "m1", 1, [event("e1"), event("e2", at="2026-04-20T11:00:00Z")])
    daily.run(spark, roots, "2026-04-20", pull=True, tracked=" m1, m7 ")
    marks = Warehouse(spark, roots.warehouse).read(daily.MARKS_TABLE, MARKS)
    assert {(r["endpoint"], r["high_water"]) for r in marks.collect()} == {
        ("events", "2026-04-20T11:00:00.000000Z"), ("visitors", "2026-04-01T00:00:00.000000Z"),
    }
    # the next pull lands e2 again with a newer row: only the newer one passes
    land(roots, "events", "m1", 1, [
        event("e3", at="2026-04-21T10:00:00Z"), event("e2", at="2026-04-20T11:00:00Z", share=0.1),
    ], day="2026-04-21")
    daily.run(spark, roots, "2026-04-21", pull=True)
    got = {r["event_key"]: float(r["percent_viewed"]) for r in published(spark, roots).collect()}
    assert got == {"e1": 0.5, "e2": 0.5, "e3": 0.5}
    late = spark.read.parquet(f"{roots.quarantine}/events").collect()
    assert [r["event_key"] for r in late] == ["e2"]
    # a rerun neither takes loaded rows for late ones nor writes them again
    daily.run(spark, roots, "2026-04-21", pull=True)
    again = spark.read.parquet(f"{roots.quarantine}/events").collect()
    assert [r["event_key"] for r in again] == ["e2"]
    assert published(spark, roots).count() == 3


def test_short_pages_and_rows_without_time_are_all_taken(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    for page in range(1, 5):
        rows = [event(f"e{page}{i}", at=f"2026-04-20T{20 - page}:0{i}:00Z") for i in range(5)]
        land(roots, "events", "m1", page, [*rows, {**event(f"x{page}"), "received_at": None}])
    daily.run(spark, roots, "2026-04-20", pull=True)
    assert published(spark, roots).count() == 24


def test_torn_page_fails_the_run_and_is_kept(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    land(roots, "events", "m1", 1, [event("e1")])
    folder = Path(day_path(roots.landing, "events", "2026-04-20"))
    text = (folder / "m1-1.json").read_text()
    (folder / "m1-2.json").write_text(text[: len(text) // 2])
    with pytest.raises(QualityGateError, match="broken_documents"):
        daily.run(spark, roots, "2026-04-20", pull=True)
    torn = spark.read.parquet(f"{roots.quarantine}/broken_events").collect()
    assert [r["_broken"] for r in torn] == [text[: len(text) // 2]]
    # mended, the run takes both pages
    (folder / "m1-2.json").write_text(text.replace("e1", "e2"))
    daily.run(spark, roots, "2026-04-20", pull=True)
    assert {r["event_key"] for r in published(spark, roots).collect()} == {"e1", "e2"}


def test_torn_bronze_document_fails_the_gate(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "events", "m1", [event("e1")], page=1)
    folder = Path(day_path(roots.bronze, "events", "2026-04-20")) / "media_id=m1"
    (folder / "page_00002.json").write_text('[{"event_key": "e2", "med')
    with pytest.raises(QualityGateError, match="broken_documents"):
        daily.run(spark, roots, "2026-04-20")
    assert Warehouse(spark, roots.warehouse).version() == 0
    assert spark.read.parquet(f"{roots.quarantine}/broken_events").count() == 1


def test_rows_without_key_are_reported(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "events", "m1", [event("e1"), event(None), event("e3", media_id=None)], page=1)
    report = daily.run(spark, roots, "2026-04-20")
    dropped = {r["table"]: r["value"] for r in report if r["check"] == "dropped_null_key"}
    assert dropped == {"dim_media": 0.0, FACT: 2.0}


def test_day_that_failed_is_taken_in_by_the_next_run(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "events", "m1", [event("e1"), event("e2", media_id="unknown")], page=1)
    with pytest.raises(QualityGateError, match="orphan_media"):
        daily.run(spark, roots, "2026-04-20")
    media(bronze_root, "2026-04-21", "unknown")
    put(bronze_root, "events", "m1", [event("e3", at="2026-04-21T10:00:00Z")], page=1, day="2026-04-21")
    daily.run(spark, roots, "2026-04-21")
    assert {r["event_key"] for r in published(spark, roots).collect()} == {"e1", "e2", "e3"}
    assert daily.open_days(spark, roots, "2026-04-22") == ["2026-04-22"]


def test_older_day_does_not_win(spark, roots, bronze_root):
    for day, count, title in (("2026-04-20", 1, "old"), ("2026-04-21", 9, "new")):
        put(bronze_root, "media_metadata", "m1", {"hashed_id": "m1", "name": title, "created": "2026-01-01T00:00:00Z"}, day=day)
        put(bronze_root, "visitors", "m1", [{**visitor("v1", count), "last_active_at": f"{day}T00:00:00Z"}], page=1, day=day)
        put(bronze_root, "events", "m1", [event(f"e{count}", at=f"{day}T10:00:00Z")], page=1, day=day)
        daily.run(spark, roots, day)
    daily.run(spark, roots, "2026-04-20")
    assert [r["play_count"] for r in published(spark, roots, "dim_visitor").collect()] == [9]
    assert [r["name"] for r in published(spark, roots, "dim_media").collect()] == ["new"]
    assert published(spark, roots).count() == 2


def test_accumulated_counters_hold_the_days_visitors(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "visitors", "m1", [visitor("v1", 1)], page=1)
    daily.run(spark, roots, "2026-04-20")
    later = {"last_active_at": "2026-04-21T00:00:00Z"}
    put(bronze_root, "visitors", "m1", [{**visitor("v1", 5), **later}, {**visitor("v2", 3), **later}], page=1, day="2026-04-21")
    put(bronze_root, "events", "m1", [event("e1"), event("e2", who="v2")], page=1, day="2026-04-21")
    known = published(spark, roots, "dim_visitor")
    daily.run(spark, roots, "2026-04-21", accumulated_visitors=known)
    got = {r["event_key"]: r["visitor_play_count"] for r in published(spark, roots).collect()}
    assert got == {"e1": 5, "e2": 3}


def test_whole_resources_are_replaced(spark, roots):
    landing = Path(roots.landing)
    for title in ("first", "second"):
        put(landing, "media_metadata", "m1", {"hashed_id": "m1", "name": title, "created": "2026-01-01T00:00:00Z"})
        put(landing, "media_stats", "m1", {"play_count": 4, "hours_watched": 0.5})
        daily.run(spark, roots, "2026-04-20", pull=True)
    row = published(spark, roots, "dim_media").collect()
    assert [(r["name"], r["total_plays"]) for r in row] == [("second", 4)]


def test_file_that_comes_late_is_taken_in(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "events", "m1", [event("e1")], page=1)
    daily.run(spark, roots, "2026-04-20")
    # a page of the day before arrives after that day's run, next to a day without events
    put(bronze_root, "events", "m1", [event("e2"), event("e3", at="2026-04-19T10:00:00Z")], page=2)
    media(bronze_root, "2026-04-21", "m1")
    assert daily.open_days(spark, roots, "2026-04-21") == ["2026-04-20", "2026-04-21"]
    daily.run(spark, roots, "2026-04-21")
    assert {r["event_key"] for r in published(spark, roots).collect()} == {"e1", "e2", "e3"}


def test_second_run_reads_no_file(spark, roots, bronze_root, monkeypatch):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "events", "m1", [event("e1")], page=1)
    daily.run(spark, roots, "2026-04-20")
    version = Warehouse(spark, roots.warehouse).version()

    def unread(*args, **options):
        raise AssertionError("a document was read")

    monkeypatch.setattr(daily.bronze, "read_bronze", unread)
    assert daily.run(spark, roots, "2026-04-20") == []
    assert daily.run(spark, roots, "2026-04-22", pull=True) == []
    assert Warehouse(spark, roots.warehouse).version() == version


def test_rewritten_file_is_taken_again_and_later_days_wait(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    put(bronze_root, "events", "m1", [event("e1", share=0.1)], page=1)
    put(bronze_root, "events", "m1", [event("e9", at="2026-04-22T10:00:00Z")], page=1, day="2026-04-22")
    daily.run(spark, roots, "2026-04-20")
    put(bronze_root, "events", "m1", [event("e1", share=0.7), event("e2 %20", media_id="m1")], page=1)
    daily.run(spark, roots, "2026-04-21")
    got = {r["event_key"]: float(r["percent_viewed"]) for r in published(spark, roots).collect()}
    assert got == {"e1": 0.7, "e2 %20": 0.5}
    daily.run(spark, roots, "2026-04-22")
    assert published(spark, roots).count() == 3


def test_landed_page_that_comes_late_is_pulled(spark, roots, bronze_root):
    media(bronze_root, "2026-04-20", "m1")
    land(roots, "events", "m1", 1, [event("e1")])
    daily.run(spark, roots, "2026-04-20", pull=True)
    land(roots, "events", "m1", 2, [event("e2", at="2026-04-20T12:00:00Z")])
    daily.run(spark, roots, "2026-04-21", pull=True)
    assert {r["event_key"] for r in published(spark, roots).collect()} == {"e1", "e2"}


def test_odd_names_of_folders(spark, roots, bronze_root):
    for name in ("m 1", "m%201", "m=é"):
        put(bronze_root, "events", name, [event(f"e {name}")], page=1)
    media(bronze_root, "2026-04-20", "m1")
    daily.run(spark, roots, "2026-04-20")
    assert published(spark, roots).count() == 3
    assert daily.untaken(spark, roots, "2026-04-21").count() == 0


def test_a_feed_may_have_a_limit_of_its_own(spark, roots, bronze_root):
    # one of four visitors has no browser: over the rule's 20 %, within a limit of 30 %
    media(bronze_root, "2026-04-20", "m1")
    people = [visitor(f"v{i}") for i in range(4)]
    people[0]["user_agent_details"] = {"platform": "mac"}
    put(bronze_root, "visitors", "m1", people, page=1)
    with pytest.raises(QualityGateError, match="dim_visitor.browser null_pct=25.0"):
        daily.run(spark, roots, "2026-04-20")
    with pytest.raises(QualityGateError, match="dim_visitor.browser null_pct=25.0"):
        daily.run(spark, roots, "2026-04-20", max_null_pct={("dim_visitor", "browser"): 24.0})
    report = daily.run(spark, roots, "2026-04-20", max_null_pct={("dim_visitor", "browser"): 30.0})
    shown = {(r["column"], r["threshold"]) for r in report if (r["table"], r["check"]) == ("dim_visitor", "null_pct")}
    assert shown == {("visitor_key", 0.0), ("browser", 30.0), ("platform", 20.0)}
    assert published(spark, roots, "dim_visitor").count() == 4


def test_daily_load_where_over_a_fifth_of_the_visitors_name_no_browser(spark):
    columns, rows = rows_of_spark(all_queries()["daily_load"](spark, SMALL))
    assert (columns, rows) == rows_of_sql(connect(SMALL), all_oracles()["daily_load"])
