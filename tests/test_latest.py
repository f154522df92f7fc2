from __future__ import annotations

import random

from pyspark.sql import functions as F

from reelstar.operators.joins import lookup_join
from reelstar.operators.latest import latest_by, mode_by


def test_survivor_does_not_depend_on_input_order(spark):
    rows = [(k, t, v) for k in "abc" for t in (None, 1, 2, 2) for v in range(5)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, t int, v int").repartition(5)
        seen.add(tuple(sorted(map(tuple, latest_by(df, ["k"], ["t"]).collect()))))
    assert len(seen) == 1
    assert all(t == 2 for _, t, _ in seen.pop())


def test_nulls_rank_last(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", None)], "k string, t int")
    assert sorted(map(tuple, latest_by(df, ["k"], ["t"]).collect())) == [("a", 1), ("b", None)]


def test_mode_ignores_nulls_and_takes_the_lowest_on_a_tie(spark):
    rows = [
        ("v", "DE", "x"), ("v", "DE", None), ("v", "AT", "y"), ("v", "AT", "y"), ("v", None, "x"),
        ("w", None, None), ("w", "FR", None), (None, "FR", "z"),
    ]
    df = spark.createDataFrame(rows, "visitor string, country string, city string")
    got = mode_by(df, "visitor", ["country", "city"]).collect()
    assert sorted(map(tuple, got)) == [("v", "AT", "x"), ("w", "FR", None)]


def test_mode_agrees_with_the_builtin(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(20), rng.choice(["a", "b", "c", None])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k int, c string")
    want = df.groupBy("k").agg(F.mode("c", deterministic=True).alias("c"))
    assert set(map(tuple, mode_by(df, "k", ["c"]).collect())) == set(map(tuple, want.collect()))


def test_lookup_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame(
        [("e1", "v1"), ("e2", None), ("e3", "gone"), ("v1", None)], "e string, v string"
    )
    right = spark.createDataFrame([("v1", 5), ("v2", 6), (None, 7)], "v string, n int")
    got = lookup_join(left, right, "v", spread_by="e").select("e", "v", "n").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("e1", "v1", 5), ("e2", None, None), ("e3", "gone", None), ("v1", None, None)], key=str
    )
