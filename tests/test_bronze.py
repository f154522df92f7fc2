"""Hand-written bronze trees through the scan and the star build."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from reelstar.operators import star
from reelstar.sources import bronze

DAY = "2026-04-20"


def put(root: Path, endpoint: str, media_id: str, payload, page=None, day=DAY, indent=None):
    path = root / bronze.document_key(endpoint, media_id, day, page)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload, indent=indent))


@pytest.fixture()
def tree(tmp_path):
    put(tmp_path, "media_metadata", "m1", {
        "hashed_id": "m1", "name": "Ad Youtube", "duration": 12.3456, "created": "2026-01-01T00:00:00Z",
        "updated": "2026-02-01T00:00:00Z", "status": "ready", "project": {"name": "P"}, "section": "S",
    }, indent=2)
    put(tmp_path, "media_metadata", "m2", {"hashed_id": "m2", "name": None, "duration": "bad"})
    put(tmp_path, "media_stats", "m1", {
        "play_count": 7, "load_count": 9.0, "play_rate": 0.5, "hours_watched": 1.25, "visitors": 3,
        "engagement": 99999.0,
    })
    put(tmp_path, "visitors", "m1", [
        {"visitor_key": "v1", "created_at": "2026-04-01T00:00:00Z", "last_active_at": "2026-04-02T00:00:00Z",
         "load_count": 1, "play_count": 1, "user_agent_details": {"browser": "F", "mobile": False}},
        {"visitor_key": "v1", "last_active_at": "2026-04-03T00:00:00Z", "load_count": 2, "play_count": 2,
         "user_agent_details": {"browser": "C", "platform": "mac", "mobile": True}},
        {"visitor_key": None, "last_active_at": "2026-04-09T00:00:00Z"},
    ], page=1, indent=1)
    put(tmp_path, "visitors", "m1", [], page=2)
    put(tmp_path, "events", "m1", [
        {"event_key": "e1", "media_id": "m1", "visitor_key": "v1", "received_at": "2026-04-20T10:00:00Z",
         "country": "DE", "lat": "x", "lon": 8.5, "percent_viewed": 0.25, "ip": "1.1.1.1"},
        {},
        {"event_key": "e2", "media_id": None, "received_at": "2026-04-20T11:00:00Z"},
    ], page=1)
    put(tmp_path, "events", "m1", [
        {"event_key": "e1", "media_id": "m1", "visitor_key": "v1", "received_at": "2026-04-20T23:30:00-05:00",
         "country": "AT", "percent_viewed": 0.5, "ip": "2.2.2.2"},
        {"event_key": "e3", "media_id": "m1", "visitor_key": None, "received_at": None, "percent_viewed": "1"},
    ], page=2)
    return tmp_path


def scan(spark, root, endpoint, days=(DAY,)):
    return bronze.read_bronze(spark, str(root), endpoint, list(days))


def test_document_keys():
    assert bronze.document_key("visitors", "abc123", DAY, 1) == (
        "visitors/year=2026/month=04/day=20/media_id=abc123/page_00001.json"
    )
    assert bronze.document_key("media_stats", "abc", DAY).endswith("/media_id=abc/abc.json")


def test_arrays_and_objects_become_rows(spark, tree):
    assert scan(spark, tree, "media_metadata").count() == 2
    assert scan(spark, tree, "visitors").count() == 3
    assert scan(spark, tree, "events").count() == 5


def test_missing_endpoint_and_missing_day_are_empty_not_errors(spark, tree):
    assert scan(spark, tree, "events", ["2026-04-21"]).count() == 0
    assert scan(spark, tree, "events", [DAY, "2026-04-21"]).count() == 5
    assert scan(spark, tree / "nowhere", "visitors").count() == 0


def test_other_read_errors_are_raised(spark, tree):
    folder = tree / "events/year=2026/month=04/day=20"
    (folder / "broken.txt.gz").write_text("not gzip")
    with pytest.raises((PySparkException, Py4JJavaError), match="FAILED_READ_FILE"):
        scan(spark, tree, "events").collect()


def test_stats_take_their_id_from_the_path(spark, tree):
    rows = scan(spark, tree, "media_stats").collect()
    assert [(r["media_id"], r["play_count"]) for r in rows] == [("m1", "7")]


def test_dim_media(spark, tree):
    df = star.build_dim_media(scan(spark, tree, "media_metadata"), scan(spark, tree, "media_stats"), DAY)
    m1, m2 = df.orderBy("media_id").collect()
    assert m1["duration_seconds"] == Decimal("12.346") and m1["project_name"] == "P"
    assert m1["channel"] == "YouTube" and m1["total_plays"] == 7 and m1["total_loads"] == 9
    assert m1["engagement"] is None  # does not fit decimal(10,6)
    assert m1["load_date"] == dt.date(2026, 4, 20)
    assert m2["channel"] == "Unknown" and m2["duration_seconds"] is None and m2["total_plays"] is None


def test_duplicate_documents_make_one_row(spark, tree):
    put(tree, "media_metadata", "again", {"hashed_id": "m1", "name": "new", "updated": "2026-03-01T00:00:00Z"})
    df = star.build_dim_media(scan(spark, tree, "media_metadata"), scan(spark, tree, "media_stats"), DAY)
    assert {r["media_id"]: r["name"] for r in df.collect()} == {"m1": "new", "m2": None}


def test_dim_visitor(spark, tree):
    df = star.build_dim_visitor(scan(spark, tree, "visitors"), scan(spark, tree, "events"), DAY)
    (v1,) = df.collect()
    assert (v1["visitor_key"], v1["browser"], v1["load_count"], v1["is_mobile"]) == ("v1", "C", 2, True)
    assert (v1["country"], v1["last_ip"]) == ("AT", "2.2.2.2")


def test_fact(spark, tree):
    people = star.latest_visitors(scan(spark, tree, "visitors"))
    local = star.build_fact(scan(spark, tree, "events"), people, DAY).orderBy("event_key").collect()
    assert [r["event_key"] for r in local] == ["e1", "e3"]
    e1, e3 = local
    assert e1["country"] == "AT" and e1["percent_viewed"] == Decimal("0.5")
    assert e1["event_date"] == dt.date(2026, 4, 20) and e1["visitor_play_count"] == 2
    assert e1["browser"] is None and e1["lat"] is None
    assert e3["event_date"] is None and e3["visitor_play_count"] is None
    utc = star.build_fact(scan(spark, tree, "events"), people, DAY, date_rule="utc")
    assert {r["event_key"]: r["event_date"] for r in utc.collect()}["e1"] == dt.date(2026, 4, 21)


def test_missing_optional_sources_give_typed_nulls(spark, tree):
    nothing = bronze.empty(spark, "events")
    df = star.build_dim_visitor(scan(spark, tree, "visitors"), nothing, DAY)
    assert df.first()["country"] is None and dict(df.dtypes)["country"] == "string"
    stats = bronze.empty(spark, "media_stats")
    media = star.build_dim_media(scan(spark, tree, "media_metadata"), stats, DAY)
    assert dict(media.dtypes)["hours_watched"] == "decimal(14,6)"
    nobody = star.latest_visitors(bronze.empty(spark, "visitors"))
    fact = star.build_fact(scan(spark, tree, "events"), nobody, DAY)
    assert fact.count() == 2 and dict(fact.dtypes)["visitor_play_count"] == "int"


def test_cast_failures_are_counted(spark, tree):
    found = star.cast_failures(scan(spark, tree, "events"), "events").filter("failed > 0").collect()
    assert [(r["column"], r["failed"]) for r in found] == [("lat", 1)]


def test_rerun_of_a_day_appends_next_to_documents(spark, tree):
    more = spark.createDataFrame(
        [("e9", "m1", "2026-04-20T12:00:00Z")], "event_key string, media_id string, received_at string"
    )
    rows = star.project(scan(spark, tree, "events"), (("event_key", "event_key", "string"),))
    assert rows.count() == 5
    full = bronze.empty(spark, "events").unionByName(more, allowMissingColumns=True)
    for _ in range(2):
        bronze.write_bronze(full, str(tree), "events", DAY)
    assert scan(spark, tree, "events").count() == 7


def test_full_refresh_replaces_the_day(spark, tmp_path):
    def stats(plays):
        df = spark.createDataFrame([("m1", plays), ("m2", plays)], "media_id string, play_count string")
        return bronze.empty(spark, "media_stats").unionByName(df, allowMissingColumns=True)

    for plays in ("1", "2"):
        bronze.write_bronze(stats(plays), str(tmp_path), "media_stats", DAY, replace=True)
    bronze.write_bronze(stats("3"), str(tmp_path), "media_stats", "2026-04-21", replace=True)
    got = scan(spark, tmp_path, "media_stats").collect()
    assert sorted((r["media_id"], r["play_count"]) for r in got) == [("m1", "2"), ("m2", "2")]


def test_folder_per_video_layout(spark, tmp_path):
    df = spark.createDataFrame([("m1", "5"), ("m2", "6")], "media_id string, play_count string")
    df = bronze.empty(spark, "media_stats").unionByName(df, allowMissingColumns=True)
    bronze.write_bronze(df, str(tmp_path), "media_stats", DAY, media_id="media_id")
    folders = sorted(p.name for p in tmp_path.glob("media_stats/*/*/*/*") if p.is_dir())
    assert folders == ["media_id=m1", "media_id=m2"]
    assert scan(spark, tmp_path, "media_stats").count() == 2


def test_ids_from_odd_paths(spark, tmp_path):
    for name in ("m 1", "a+b", "x#y", "é", "50%"):
        put(tmp_path, "media_stats", name, {"play_count": 1})
    assert {r["media_id"] for r in scan(spark, tmp_path, "media_stats").collect()} == {"m 1", "a+b", "x#y", "é", "50%"}
