from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from reelstar.operators import star
from reelstar.sources import bronze
from reelstar.sources.warehouse import Warehouse
from reelstar.streaming import loads
from test_bronze import put
from test_daily import event


@pytest.fixture()
def dirs(tmp_path):
    return str(tmp_path / "bronze"), str(tmp_path / "w"), str(tmp_path / "c")


def upsert(spark, dirs, lines=False):
    root, warehouse, checkpoint = dirs
    loads.upsert_stream(
        loads.bronze_stream(spark, root, "events", lines=lines, max_files=1),
        Warehouse(spark, warehouse), FACTS, ["event_key"], ["received_at"], checkpoint,
        partition_by="event_date", prepare=lambda batch: star.clean_events(batch),
    )


FACTS = "facts"


def stored(spark, dirs):
    schema = star.clean_events(bronze.empty(spark, "events")).schema
    df = Warehouse(spark, dirs[1]).read(FACTS, schema, "event_date")
    return {r["event_key"]: float(r["percent_viewed"]) for r in df.collect()}


def test_growing_folder_gives_the_batch_result(spark, dirs, tmp_path):
    root = tmp_path / "bronze"
    put(root, "events", "m1", [event("e1", share=0.1), event("e2", share=0.2), {}], page=1, indent=1)
    put(root, "events", "m1", [event("e1", at="2026-04-21T00:00:00Z", share=0.3)], page=2)
    upsert(spark, dirs)
    assert stored(spark, dirs) == {"e1": 0.3, "e2": 0.2}
    version = Warehouse(spark, dirs[1]).version()
    assert version == 2  # one file per batch
    # nothing new: nothing published
    upsert(spark, dirs)
    assert Warehouse(spark, dirs[1]).version() == version
    # a late delivery that is older than the published one does not replace it
    put(root, "events", "m1", [event("e1", at="2026-04-20T00:00:00Z", share=0.9), event("e3", share=0.4)],
        page=1, day="2026-04-21")
    upsert(spark, dirs)
    assert stored(spark, dirs) == {"e1": 0.3, "e2": 0.2, "e3": 0.4}
    days = ["2026-04-20", "2026-04-21"]
    batch = star.clean_events(bronze.read_bronze(spark, str(root), "events", days))
    assert stored(spark, dirs) == {
        r["event_key"]: float(r["percent_viewed"]) for r in batch.collect()
    }


def test_stream_over_written_lines(spark, dirs):
    rows = spark.createDataFrame([(json.dumps(event("e1")),)], "value string")
    rows = rows.select(F.from_json("value", bronze.RAW["events"]).alias("r")).select("r.*")
    bronze.write_bronze(rows, dirs[0], "events", "2026-04-20")
    upsert(spark, dirs, lines=True)
    assert stored(spark, dirs) == {"e1": 0.5}


def test_daily_trend_counts_each_event_once_and_no_event_is_too_late(spark, tmp_path):
    media = spark.createDataFrame([("m1", "YouTube"), ("m2", "Facebook")], "media_id string, channel string")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    schema = bronze.RAW["events"]

    def add(*events):
        lines = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
        lines.select(F.from_json("value", schema).alias("r")).select("r.*").coalesce(1).write.mode(
            "append").parquet(source)
        stream = loads.parquet_stream(spark, source, schema)
        loads.daily_trend_stream(stream, warehouse, FACTS, "trend", checkpoint,
                                 prepare=lambda batch: star.clean_events(batch))
        got = loads.read_daily_trend(warehouse, "trend", media).collect()
        return {(str(r["event_date"]), r["channel"]): r["events"] for r in got}

    first = add(event("a", at="2026-04-20T01:00:00Z"), event("b", at="2026-04-20T02:00:00Z"),
                event("c", "m2", "2026-04-20T03:00:00Z"))
    assert first == {("2026-04-20", "YouTube"): 2, ("2026-04-20", "Facebook"): 1}
    # a replay on another day moves its event; an event of three weeks before still counts
    second = add(event("b", at="2026-04-21T02:00:00Z"), event("d", at="2026-03-30T02:00:00Z"))
    assert second == {
        ("2026-04-20", "YouTube"): 1, ("2026-04-20", "Facebook"): 1,
        ("2026-04-21", "YouTube"): 1, ("2026-03-30", "YouTube"): 1,
    }
    # the last event of a day and channel moves away
    third = add(event("c", "m2", "2026-04-21T03:00:00Z"))
    assert third == {
        ("2026-04-20", "YouTube"): 1, ("2026-04-21", "Facebook"): 1,
        ("2026-04-21", "YouTube"): 1, ("2026-03-30", "YouTube"): 1,
    }


def test_two_streams_into_one_table(spark, dirs, tmp_path):
    put(tmp_path / "bronze", "events", "m1", [event("e1", share=0.1)], page=1)
    upsert(spark, dirs)
    other = (str(tmp_path / "second"), dirs[1], str(tmp_path / "c2"))
    put(tmp_path / "second", "events", "m1", [event("e2", share=0.2)], page=1)
    upsert(spark, other)
    assert stored(spark, dirs) == {"e1": 0.1, "e2": 0.2}


def gated(spark, tmp_path, **options):
    loads.gated_upsert_stream(
        loads.bronze_stream(spark, str(tmp_path / "bronze"), "events", keep_broken=True, max_files=1),
        Warehouse(spark, str(tmp_path / "w")), "events", ["event_key"], ["received_at"], str(tmp_path / "c"),
        str(tmp_path / "q"), prepare=lambda batch: star.clean_events(batch), partition_by="event_date",
        known_media=spark.createDataFrame([("m1",)], "media_id string"), **options,
    )
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    schema = star.clean_events(bronze.empty(spark, "events")).schema
    table = warehouse.read("fact_media_engagement", schema, "event_date")
    log = warehouse.read(loads.BATCHES_TABLE, loads.BATCHES).orderBy("batch").collect()
    return {r["event_key"] for r in table.collect()}, [(r["rows"], r["no_key"], r["broken"]) for r in log]


def test_torn_document_of_a_stream_is_kept_and_counted(spark, tmp_path):
    root = tmp_path / "bronze"
    put(root, "events", "m1", [event("e1"), event(None)], page=1)
    torn = root / bronze.document_key("events", "m1", "2026-04-20", 2)
    torn.write_text('[{"event_key": "e2", "med')
    assert gated(spark, tmp_path) in (({"e1"}, [(2, 1, 0), (0, 0, 1)]), ({"e1"}, [(0, 0, 1), (2, 1, 0)]))
    kept = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "q" / "broken_events"))
    assert [r["_broken"] for r in kept.collect()] == ['[{"event_key": "e2", "med']
    # the pulled page comes once more, whole; a stream takes a path once
    put(root, "events", "m1", [event("e2")], page=3)
    assert gated(spark, tmp_path)[0] == {"e1", "e2"}


def test_bad_batch_publishes_nothing_and_the_stream_goes_on_when_mended(spark, tmp_path):
    root = tmp_path / "bronze"
    put(root, "events", "m1", [event("e1")], page=1)
    gated(spark, tmp_path)
    put(root, "events", "m1", [event("e2"), event("e3", media_id="unknown")], page=2)
    for _ in range(2):  # stays so until it is mended
        with pytest.raises(StreamingQueryException, match="orphan_media"):
            gated(spark, tmp_path)
    schema = star.clean_events(bronze.empty(spark, "events")).schema
    table = Warehouse(spark, str(tmp_path / "w")).read("fact_media_engagement", schema, "event_date")
    assert [r["event_key"] for r in table.collect()] == ["e1"]
    kept = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "q" / "failed_events"))
    assert {r["event_key"] for r in kept.collect()} == {"e2", "e3"}
    put(root, "events", "m1", [event("e2"), event("e3")], page=2)
    assert gated(spark, tmp_path)[0] == {"e1", "e2", "e3"}


def test_stream_limits(spark, tmp_path):
    root = tmp_path / "bronze"
    (root / bronze.document_key("events", "m1", "2026-04-20", 1)).parent.mkdir(parents=True)
    (root / bronze.document_key("events", "m1", "2026-04-20", 1)).write_text("[{")
    with pytest.raises(StreamingQueryException, match="broken_documents"):
        gated(spark, tmp_path, max_broken_pct=10.0)
    assert gated(spark, tmp_path) == (set(), [(0, 0, 1)])
    put(root, "events", "m1", [{**event("e1"), "percent_viewed": "half"}], page=2)
    with pytest.raises(StreamingQueryException, match="failed_casts"):
        gated(spark, tmp_path)
    assert gated(spark, tmp_path, failed_cast_pct=100.0)[0] == {"e1"}
