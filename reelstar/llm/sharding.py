"""Sharding by a k-d tree over document metadata.

A node of the tree holds documents and a number of shards. It is split along the dimension in
which its documents lie widest, at the weighted median: the place where the bytes on its left
are the left child's part of the shards. Leaves hold one shard each, so all reach about the
target bytes, and a shard's documents are alike in source, language and length.

Medians are found by counting. The range of a node's widest dimension is cut into bins, the
bytes of each bin are summed over the cluster, and the bin in which the median lies is cut anew
until the split is exact enough. All nodes of a level share the jobs. The driver sees that bin
of each node, a few numbers for a shard, and never a document.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from reelstar.session import stored

OVERHEAD = 16
# bins of a job over all nodes, and of one node at least
_BINS, _FEWEST = 32768, 16
# how far a split may be from its place, in parts of a shard
_TOLERANCE = 0.002
# copies of one text that hold less than this part of a shard are not parted by a split
_WHOLE_GROUP = 0.01
_MAX, _MIN = (1 << 63) - 1, -(1 << 63)
_SLOT_ROWS = 200_000
# the documents' nodes are written after so many levels, so no job descends more than that
_STORE_LEVELS = 3
# the dimensions of a split, in order: a coordinate, then the text, then the document
_TEXT, _DOC = -1, -2


@dataclass
class _Split:
    """A node that is being split, and how far the search for its median has come."""

    node: int
    shards: int
    first: int
    goal: float
    phase: int
    low: float
    high: float
    before: float = 0.0
    dim: int = -1
    at: float | None = None  # coordinate, text and document of the last row on the left
    text: int = _MAX
    doc: int = _MAX
    done: bool = False


def measured(
    docs: DataFrame, doc_id: str, text: str, dims: Sequence[str], extra: Sequence[str] = ()
) -> DataFrame:
    """Size, hashes and coordinates of every document, all at node 1, the root of the tree.

    Texts are read for nothing else.

    Coordinates lie between 0 and 1: ``size`` on a logarithmic scale, and columns of ``dims`` by
    a hash, which puts equal values together and different ones apart. Copies of a text are
    placed as one, under the least of their values.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD
    tags = [F.xxhash64(F.col(d)).alias(f"_d{k}") for k, d in enumerate(dims)]
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        size.alias("size"),
        F.crc32(F.col(text)).alias("text_crc32"),
        F.xxhash64(F.col(text)).alias("_text"),
        F.xxhash64(F.lit(3), F.col(doc_id), F.col(text)).alias("_doc"),
        *tags,
        *extra,
    )
    rows = stored(docs.sparkSession, rows, "shard-sizes")
    if tags:
        same = ["_text", "size"]
        least = [F.min(f"_d{k}").alias(f"_m{k}") for k in range(len(dims))]
        # by a hash besides, neither side can reuse the aggregate's partitioning, so Spark can
        # split a text that very many documents share
        spread = F.xxhash64(*same).alias("_spread")
        groups = rows.groupBy(*same).agg(*least).select("*", spread)
        rows = rows.select("*", spread).join(groups.hint("merge"), [*same, "_spread"])
    unit = [F.shiftrightunsigned(f"_m{k}", 11) / float(1 << 53) for k in range(len(dims))]
    spans = [*unit, F.log2(F.col("size")) / 63.0]
    kept = ["doc_id", "size", "text_crc32", "_text", "_doc", *extra]
    return stored(
        docs.sparkSession,
        rows.select(
            *kept, F.lit(1).cast("long").alias("_node"), *[c.alias(f"_c{k}") for k, c in enumerate(spans)]
        ),
        "shard-points",
    )


def _inline(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of the tree as part of the plan; it has a row for each shard at most."""
    names = [column.split()[0] for column in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    table = F.from_json(F.lit(text), f"array<struct<{schema}>>")
    return df.sparkSession.range(1).select(F.inline(table))


def _coordinate(n_dims: int, dim: str):
    value = F.lit(None).cast("double")
    for k in range(n_dims):
        value = F.when(F.col(dim) == k, F.col(f"_c{k}")).otherwise(value)
    return value


def _descend(points: DataFrame, splits: list[_Split], n_dims: int) -> DataFrame:
    """Move the documents of split nodes to the children, numbered 2 n and 2 n + 1."""
    if not splits:
        return points
    rules = _inline(
        points,
        [(s.node, s.dim, s.at, s.text, s.doc) for s in splits],
        "_node long, _dim int, _at double, _at_text long, _at_doc long",
    )
    joined = points.join(F.broadcast(rules), "_node", "left")
    v = _coordinate(n_dims, "_dim")
    inner = (F.col("_text") < F.col("_at_text")) | (
        (F.col("_text") == F.col("_at_text")) & (F.col("_doc") <= F.col("_at_doc"))
    )
    # a node without any width is split by text alone, which is dimension -1
    left = F.when(F.col("_dim") < 0, inner).otherwise(
        (v < F.col("_at")) | ((v == F.col("_at")) & inner)
    )
    child = F.col("_node") * 2 + F.when(left, 0).otherwise(1)
    node = F.when(F.col("_dim").isNull(), F.col("_node")).otherwise(child)
    return joined.withColumn("_node", node).select(*points.columns)


def _median_bins(points: DataFrame, open_: list[_Split], n_dims: int, bins: int) -> dict:
    """The bin of the searched range of each open node in which its median lies.

    A row has the bin's bytes, its least and greatest value, the bytes in the bins ``before`` it
    and the greatest value there (NULL in the first).
    """
    ranges = _inline(
        points,
        [
            (
                s.node, s.dim, s.phase, s.goal - s.before,
                None if s.phase >= 0 else s.at,
                s.text,
                float(s.low) if s.phase >= 0 else 0.0,
                float(s.high) if s.phase >= 0 else 0.0,
                int(s.low) if s.phase < 0 else 0,
                int(s.high) if s.phase < 0 else 0,
            )
            for s in open_
        ],
        "_node long, _dim int, _phase int, _goal double, _at double, _at_text long, "
        "_low double, _high double, _lo long, _hi long",
    )
    rows = points.join(F.broadcast(ranges), "_node")
    v = _coordinate(n_dims, "_dim")
    key = F.when(F.col("_phase") == _TEXT, F.col("_text")).otherwise(F.col("_doc"))
    number = F.col("_phase") < 0
    here = (
        F.when(~number, v.between(F.col("_low"), F.col("_high")))
        .when(F.col("_phase") == _TEXT, F.coalesce(v == F.col("_at"), F.lit(True)))
        .otherwise(
            F.coalesce(v == F.col("_at"), F.lit(True)) & (F.col("_text") == F.col("_at_text"))
        )
    ) & (~number | key.between(F.col("_lo"), F.col("_hi")))
    low = F.when(number, F.col("_lo").cast("double")).otherwise(F.col("_low"))
    high = F.when(number, F.col("_hi").cast("double")).otherwise(F.col("_high"))
    at = F.when(number, key.cast("double")).otherwise(v)
    place = F.when(high > low, (at - low) / (high - low) * bins).otherwise(0.0)
    sums = (
        rows.filter(here)
        .groupBy("_node", "_goal", F.least(F.floor(place), F.lit(bins - 1)).alias("_bin"))
        .agg(
            F.sum("size").alias("bytes"),
            F.min(v).alias("low"),
            F.max(v).alias("high"),
            F.min(key).alias("lo"),
            F.max(key).alias("hi"),
        )
    )
    in_node = Window.partitionBy("_node").orderBy("_bin")
    along = sums.select(
        "*",
        (F.sum("bytes").over(in_node) - F.col("bytes")).alias("before"),
        F.lag("high").over(in_node).alias("high_before"),
        F.lag("hi").over(in_node).alias("hi_before"),
        F.row_number().over(in_node).alias("_k"),
        F.lead("_bin").over(in_node).isNull().alias("_last"),
    )
    reached = F.col("_last") | (F.col("before") + F.col("bytes") >= F.col("_goal"))
    first = (F.col("_k") == 1) | (F.col("before") < F.col("_goal"))
    return {row["_node"]: row for row in along.filter(reached & first).collect()}


def _narrow(s: _Split, found: Row, shard_bytes: float) -> None:
    """Settle a split at an edge of its median's bin, or look closer into that bin."""
    number = s.phase < 0
    low, high = (found["lo"], found["hi"]) if number else (found["low"], found["high"])
    edge_before = found["hi_before"] if number else found["high_before"]
    total = s.before + found["before"]
    under, over = s.goal - total, total + found["bytes"] - s.goal
    one_text = s.phase == _TEXT and low == high and found["bytes"] <= _WHOLE_GROUP * shard_bytes
    stuck = s.phase == _DOC and low == high
    if min(under, over) <= _TOLERANCE * shard_bytes or one_text or stuck:
        s.done = True
        # the last value on the left; with nothing on the left, a value before all of the range
        if over < under:
            edge = high
        elif edge_before is not None:
            edge = edge_before
        else:
            edge = s.low if not number else int(s.low) - 1 if s.low > _MIN else _MIN
        if s.phase >= 0:
            s.at = edge
            if over >= under and edge_before is None:
                s.text = s.doc = _MIN
        elif s.phase == _TEXT:
            s.text = edge
            if over >= under and edge_before is None:
                s.doc = _MIN
        else:
            s.doc = edge
        return
    s.before = total
    if low < high:
        s.low, s.high = low, high
    elif s.phase >= 0:
        s.at, s.phase, s.low, s.high = low, _TEXT, _MIN, _MAX
    else:
        s.text, s.phase, s.low, s.high = low, _DOC, _MIN, _MAX


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    dims: Sequence[str] = ("source", "lang"),
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every document.

    ``shards`` is the number of leaves, or all bytes over ``target_bytes`` rounded up. ``size``
    is the bytes of the text and 16 more (NULL text: 16, and no checksum). Shards are numbered
    from 0 in the order of the leaves, slots from 0 without gaps. A split falls within 0.2 % of a
    shard of its place or at the nearest document. Copies of one text lie together unless they
    hold over 1 % of a shard and a split falls among them. NULLs of a dimension are a value of
    their own. With fewer documents than shards some shards stay empty; an empty table gives no
    rows. Repeated rows are kept; a split never parts rows that are equal in id and text.
    """
    points = measured(docs, doc_id, text, dims)
    n_dims = len(dims) + 1
    placed = points

    def extents(frame: DataFrame) -> dict:
        spans = [f(f"_c{k}") for k in range(n_dims) for f in (F.min, F.max)]
        rows = frame.groupBy("_node").agg(F.sum("size"), *spans).collect()
        return {r[0]: (r[1], list(zip(r[2::2], r[3::2]))) for r in rows}

    known = extents(placed)
    total, whole = known.get(1, (0, []))
    if shards is None:
        shards = max(1, -(-total // target_bytes)) if target_bytes else 1
    shard_bytes = total / shards
    widths = [high - low for low, high in whole]
    waiting, leaves, level = {1: (shards, 0)}, {}, 0
    while waiting:
        splits = []
        for node, (n, first) in waiting.items():
            if n == 1 or node not in known:
                leaves[node] = first
                continue
            weight, spans = known[node]
            spread = [
                (high - low) / w if w > 0 else 0.0 for (low, high), w in zip(spans, widths)
            ]
            dim = max(range(n_dims), key=lambda k: spread[k])
            goal = weight * (n // 2) / n
            if spread[dim] > 0:
                s = _Split(node, n, first, goal, dim, *spans[dim], dim=dim)
            else:
                s = _Split(node, n, first, goal, _TEXT, _MIN, _MAX)
            splits.append(s)
        open_ = splits
        while open_:
            bins = max(_FEWEST, _BINS // len(open_))
            found = _median_bins(placed, open_, n_dims, bins)
            for s in open_:
                _narrow(s, found[s.node], shard_bytes)
            open_ = [s for s in open_ if not s.done]
        placed = _descend(placed, splits, n_dims)
        waiting = {}
        for s in splits:
            half = s.shards // 2
            waiting[2 * s.node] = (half, s.first)
            waiting[2 * s.node + 1] = (s.shards - half, s.first + half)
        level += 1
        more = any(n > 1 for n, _ in waiting.values())
        if more and level % _STORE_LEVELS == 0:
            placed = stored(docs.sparkSession, placed, "shard-nodes")
        known = extents(placed) if more else {}
    numbers = _inline(points, list(leaves.items()), "_node long, shard int")
    sharded = placed.join(F.broadcast(numbers), "_node")
    return _slotted(sharded).select("doc_id", "size", "text_crc32", "shard", "slot")


def _slotted(sharded: DataFrame) -> DataFrame:
    """Number each shard's rows from 0; parts of a shard are numbered apart and then moved up."""
    sharded = stored(sharded.sparkSession, sharded, "sharded")
    parts = max(1, -(-sharded.count() // _SLOT_ROWS))
    rows = sharded.withColumn("_part", F.pmod("_doc", F.lit(parts)))
    counts = rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    own = Window.partitionBy("shard", "_part").orderBy("_doc", "doc_id", "size")
    within = F.row_number().over(own) - 1
    slots = rows.withColumn("_within", within).join(
        counts.select("shard", "_part", "_before"), ["shard", "_part"]
    )
    return slots.withColumn("slot", (F.col("_before") + F.col("_within")).cast("long"))
