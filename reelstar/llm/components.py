"""Connected components of a graph of any size, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.session import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``a``, ``b``): the least node it reaches.

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its
    least neighbour, then its smaller neighbours are. Both keep the components and shorten
    paths, so a chain of n nodes takes in the order of log n rounds. Each round is written to
    the shared scratch folder; only two numbers a round reach the driver.
    """
    spark = edges.sparkSession
    links = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = stored(spark, links.distinct(), "links")
    state = _digest(links)
    while True:
        links = stored(spark, _small_star(_large_star(links)), "links")
        after = _digest(links)
        if after == state:
            break
        state = after
    roots = links.select("b").distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def _digest(links: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _with_least(links: DataFrame, least: DataFrame, key: str, how: str) -> DataFrame:
    """Links with the least neighbour ``m`` of their node ``key``.

    A node in a group of very many may have a third of all links: by a hash besides, neither side
    can reuse the aggregate's partitioning, so Spark can split the join of that node.
    """
    right = least.withColumnRenamed("a", key).withColumn("_spread", F.xxhash64(key))
    left = links.withColumn("_spread", F.xxhash64(key))
    return left.join(right, [key, "_spread"], how)


def _large_star(links: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least of the node and its neighbours."""
    # links run from the larger node a to the smaller b, so a node's smaller neighbours are the
    # b of its rows as a, and its larger neighbours the a of its rows as b
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    up = _with_least(links, least, "b", "left")
    own = up.select("a", F.coalesce("m", "b").alias("b"))
    return own.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = _with_least(links, least, "a", "inner")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .filter("a <> b")
        .distinct()
    )
