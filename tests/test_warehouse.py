from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reelstar.operators import upsert as ups
from reelstar.schemas import columns
from reelstar.sources.warehouse import Derived, Load, Warehouse

SCHEMA = columns("k string, day date, v integer")


def d(n):
    return None if n is None else dt.date(2024, 1, n)


def frame(spark, rows):
    return spark.createDataFrame([(k, d(day), v) for k, day, v in rows], SCHEMA)


def rows(df):
    return sorted(((r["k"], r["day"] and r["day"].day, r["v"]) for r in df.collect()), key=str)


def load(spark, data):
    return Load(frame(spark, data), ["k"], "day", ("k",))


@pytest.fixture()
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"))


def test_upsert_keeps_target_rows_without_key(spark):
    target = frame(spark, [("a", 1, 1), (None, 1, 2), ("b", 1, 3)])
    staging = frame(spark, [("a", 2, 9), (None, 2, 8), ("c", 2, 7)])
    assert rows(ups.upsert(target, staging, ["k"])) == rows(
        frame(spark, [(None, 1, 2), ("b", 1, 3), ("a", 2, 9), ("c", 2, 7)])
    )


def test_repeated_staging_keys_are_all_inserted(spark):
    got = ups.upsert(frame(spark, [("a", 1, 1)]), frame(spark, [("a", 1, 2), ("a", 1, 3)]), ["k"])
    assert rows(got) == [("a", 1, 2), ("a", 1, 3)]


def test_empty_warehouse_reads_as_empty(spark, warehouse):
    assert warehouse.version() == 0 and not warehouse.exists("t")
    assert warehouse.read("t", SCHEMA, "day").count() == 0


def test_moved_row_leaves_no_twin_even_if_its_partition_empties(spark, warehouse):
    warehouse.publish({"t": load(spark, [("a", 1, 1), ("b", 2, 1), ("c", 2, 1)])})
    warehouse.publish({"t": load(spark, [("a", 3, 2), ("b", 3, 2)])})
    assert rows(warehouse.read("t", SCHEMA, "day")) == [("a", 3, 2), ("b", 3, 2), ("c", 2, 1)]


def test_only_touched_partitions_are_rewritten(spark, warehouse):
    warehouse.publish({"t": load(spark, [("a", 1, 1), ("b", 2, 1)])})
    before = {p: f for t, p, f, _ in warehouse._current() if t == "t"}
    warehouse.publish({"t": load(spark, [("a", 1, 2)])})
    after = {p: f for t, p, f, _ in warehouse._current() if t == "t"}
    assert before["2024-01-02"] == after["2024-01-02"]
    assert before["2024-01-01"] != after["2024-01-01"]


def test_rows_without_a_date(spark, warehouse):
    warehouse.publish({"t": load(spark, [("a", None, 1), ("b", 1, 1)])})
    warehouse.publish({"t": load(spark, [("b", None, 2)])})
    assert rows(warehouse.read("t", SCHEMA, "day")) == [("a", None, 1), ("b", None, 2)]
    warehouse.publish({"t": load(spark, [("a", 5, 3), ("b", 5, 3)])})
    assert rows(warehouse.read("t", SCHEMA, "day")) == [("a", 5, 3), ("b", 5, 3)]


def test_same_load_twice_is_the_same_table(spark, warehouse):
    warehouse.publish({"t": load(spark, [("a", 1, 1), ("b", 2, 1)])})
    for _ in range(2):
        warehouse.publish({"t": load(spark, [("a", 2, 5), ("c", 1, 5)])})
    assert rows(warehouse.read("t", SCHEMA, "day")) == [("a", 2, 5), ("b", 2, 1), ("c", 1, 5)]


def test_empty_load_changes_nothing(spark, warehouse):
    warehouse.publish({"t": load(spark, [])})
    warehouse.publish({"t": load(spark, [("a", 1, 1)])})
    warehouse.publish({"t": load(spark, [])})
    assert rows(warehouse.read("t", SCHEMA, "day")) == [("a", 1, 1)]


def test_random_loads_against_a_dictionary(spark, warehouse):
    rng, held = random.Random(3), {}
    for step in range(6):
        batch = {f"k{rng.randrange(12)}": (rng.choice([1, 2, 3, None]), step) for _ in range(6)}
        held.update(batch)
        warehouse.publish({"t": load(spark, [(k, *x) for k, x in batch.items()])})
        assert rows(warehouse.read("t", SCHEMA, "day")) == rows(
            frame(spark, [(k, *x) for k, x in held.items()])
        )


def test_unpartitioned_table(spark, warehouse):
    for data in ([("a", 1, 1), ("b", 1, 1)], [("a", 2, 2)]):
        warehouse.publish({"t": Load(frame(spark, data), ["k"], None, ("k",))})
    assert rows(warehouse.read("t", SCHEMA)) == [("a", 2, 2), ("b", 1, 1)]


def test_tables_of_a_failed_publish_stay_as_they_were(spark, warehouse):
    warehouse.publish({"t": load(spark, [("a", 1, 1)])})
    broken = Load(
        frame(spark, [("x", 1, 1)]).selectExpr("k", "day", "assert_true(v > 5) IS NULL AS v"), ["k"]
    )
    with pytest.raises(Exception, match="v > 5"):
        warehouse.publish({"t": load(spark, [("a", 1, 2)]), "u": broken})
    assert warehouse.version() == 1 and not warehouse.exists("u")
    assert rows(warehouse.read("t", SCHEMA, "day")) == [("a", 1, 1)]


class Interrupted(Warehouse):
    """Runs another writer's publish just before its first commit."""

    other = None

    def _commit(self, lines, number):
        other, self.other = self.other, None
        if other:
            other()
        return super()._commit(lines, number)


@pytest.mark.parametrize("table", ["t", "u"])
def test_two_writers_at_once(spark, warehouse, table):
    warehouse.publish({"t": load(spark, [("a", 1, 1), ("b", 1, 1)])})
    slow = Interrupted(spark, warehouse.root)
    slow.other = lambda: warehouse.publish({table: load(spark, [("b", 2, 5), ("c", 3, 5)])})
    assert slow.publish({"t": load(spark, [("a", 2, 9)])}) == 3
    both = rows(warehouse.read("t", SCHEMA, "day")) + rows(warehouse.read("u", SCHEMA, "day"))
    want = {("a", 2, 9), ("b", 2, 5), ("c", 3, 5)} | ({("b", 1, 1)} if table == "u" else set())
    assert set(both) == want and len(both) == len(want)


def test_a_small_load_opens_only_its_buckets(spark, warehouse):
    people = [(f"k{i}", 1, i) for i in range(200)]
    warehouse.publish({"p": Load(frame(spark, people), ["k"], buckets=32)})
    before = {(t, p): f for t, p, f, _ in warehouse._current()}
    opened = []
    read = warehouse._read
    warehouse._read = lambda t, s, part, folders: opened.append((t, len(folders))) or read(t, s, part, folders)
    warehouse.publish({"p": Load(frame(spark, [("k7", 2, 7), ("new", 2, 0)]), ["k"])})
    after = {(t, p): f for t, p, f, _ in warehouse._current()}
    assert sum(before[x] != after[x] for x in before) <= 2 and max(n for _, n in opened) <= 2
    assert len(before) > 20 and warehouse.read("p", SCHEMA).count() == 201

    warehouse.publish({"t": Load(frame(spark, people), ["k"], "day", buckets=32)})
    opened.clear()
    warehouse.publish({"t": Load(frame(spark, [("k7", 2, 7)]), ["k"], "day")})
    assert ("t__keys", 1) in opened and all(n <= 1 for _, n in opened)


def test_derived_partitions_follow_the_source(spark, warehouse):
    counted = Derived("t", lambda df: df.groupBy("day").agg(F.count("k").cast("int").alias("n")))
    for data in ([("a", 1, 1), ("b", 1, 1), ("c", 2, 1)], [("a", 3, 1), ("c", 1, 1)]):
        warehouse.publish({"t": load(spark, data)}, derived={"n": counted})
    got = warehouse.read("n", columns("day date, n integer"), "day").collect()
    assert {(r["day"].day, r["n"]) for r in got} == {(1, 2), (3, 1)}


def test_commit_that_died_midway_is_passed_over(spark, warehouse, tmp_path):
    warehouse.publish({"t": load(spark, [("a", 1, 1)])})
    (tmp_path / "w/_commits/version=0000000002/_temporary").mkdir(parents=True)
    assert warehouse.version() == 1
    assert rows(warehouse.read("t", SCHEMA, "day")) == [("a", 1, 1)]
    assert warehouse.publish({"t": load(spark, [("a", 1, 2)])}) == 3
    assert rows(warehouse.read("t", SCHEMA, "day")) == [("a", 1, 2)]


def test_a_frame_read_before_a_publish_still_reads(spark, warehouse):
    warehouse.publish({"t": load(spark, [("a", 1, 1)])})
    old = warehouse.read("t", SCHEMA, "day")
    warehouse.publish({"t": load(spark, [("a", 1, 2)])})
    assert rows(old) == [("a", 1, 1)]


def test_older_versions_are_left_out_on_request(spark, warehouse):
    def publish(data):
        rows = frame(spark, data)
        warehouse.publish({"t": Load(rows, ["k"], "day", ("k",), newest_by=("v",))})
        return {(k, v) for k, _, v in globals()["rows"](warehouse.read("t", SCHEMA, "day"))}

    assert publish([("a", 1, 5), ("b", 1, None), ("c", 2, 3)]) == {("a", 5), ("b", None), ("c", 3)}
    assert publish([("a", 2, 4), ("b", 2, 1), ("c", 3, 3)]) == {("a", 5), ("b", 1), ("c", 3)}
    assert publish([("b", 1, None), ("d", 1, None)]) == {("a", 5), ("b", 1), ("c", 3), ("d", None)}


def test_noted_work_is_applied_once(spark, warehouse):
    assert warehouse.publish({"t": load(spark, [("a", 1, 1)])}, note="s#0") == 1
    assert warehouse.publish({"t": load(spark, [("a", 1, 7)])}, note="s#0") == 1
    assert rows(warehouse.read("t", SCHEMA, "day")) == [("a", 1, 1)]
    assert warehouse.publish({"t": load(spark, [("a", 1, 7)])}, note="s#1") == 2
    assert warehouse.notes() == {"s#1"}
