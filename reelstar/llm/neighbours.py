"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a unit vector to the cell of a few random projections, each a Gaussian one cut
into slots of equal width. Besides its own cell a query visits cells nearby, in the order of
the estimated chance that a neighbour lies there, until the chances add up to what the target
recall asks of each table. What the tables turn up is merged and ranked by exact cosine.

The queries are a stated set. They are taken in blocks of bounded size; a block's probes are
broadcast, and every task looks the cells of its own vectors up in them and compares those
vectors with the queries that visit their cell, and no others. So vectors are never moved and a
hot cell is shared by all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from reelstar.session import stored

TABLES, PROJECTIONS, REACH = 2, 4, 4
# vectors that are compared with a block of queries at a time, and candidates held before they
# are weighed
_ROWS, _HELD = 4096, 1 << 20
# what a task finds: the query's id, mark and copies, the same of a vector less the query itself
FOUND = StructType(
    [StructField(c, LongType()) for c in ("query_id", "query_mark", "query_copies")]
    + [StructField(c, LongType()) for c in ("vec_id", "mark", "times")]
    + [StructField("score", DoubleType())]
)
_erf = np.vectorize(math.erf, otypes=[float])


@dataclass(frozen=True)
class Hashing:
    """What is fitted: the dimension, the expected distance of a neighbour, and the projections."""

    dim: int
    near: float
    width: float
    chance: float
    directions: np.ndarray  # tables x dim x projections
    shifts: np.ndarray  # tables x projections

    def places(self, unit: np.ndarray, table: int) -> np.ndarray:
        return (unit @ self.directions[table] + self.shifts[table]) / self.width

    def cells(self, slots: np.ndarray) -> np.ndarray:
        """One number for each row of slots."""
        return slots.astype(np.int64) @ (np.int64(1) << np.arange(0, 16 * PROJECTIONS, 16))

    def probes(self, unit: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells to visit and the query of each: the likeliest cells whose chances reach the
        target. A step to a neighbour is Gaussian in every projection, so the chance of a slot
        is that of its two edges and chances of cells are products."""
        offsets = np.arange(-REACH, REACH + 1)
        grid = np.stack(np.meshgrid(*[offsets] * PROJECTIONS, indexing="ij"), -1)
        grid = grid.reshape(-1, PROJECTIONS)
        steps = self.cells(grid)
        cells, queries = [], []
        for at in range(0, len(unit), 128):
            place = self.places(unit[at : at + 128], table)
            slot = np.floor(place)
            edges = slot[..., None] + np.arange(-REACH, REACH + 2) - place[..., None]
            cdf = 0.5 * (1 + _erf(edges * self.width / (self.near * math.sqrt(2))))
            slots = np.diff(cdf, axis=-1)
            chance = slots[:, 0][:, grid[:, 0] + REACH]
            for k in range(1, PROJECTIONS):
                chance = chance * slots[:, k][:, grid[:, k] + REACH]
            order = np.argsort(-chance, axis=1)
            sums = np.cumsum(np.take_along_axis(chance, order, 1), axis=1)
            wanted = np.minimum((sums < self.chance).sum(axis=1) + 1, len(grid))
            own = self.cells(slot)
            for k in range(len(place)):
                cells.append(own[k] + steps[order[k, : wanted[k]]])
                queries.append(np.full(wanted[k], at + k))
        return np.concatenate(cells), np.concatenate(queries)


def usable(embeddings: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id``, ``vector``, ``copies`` and ``mark`` of the rows that take part: an id, and a
    vector that is not NULL or all zero and holds no NULL, infinity or NaN. Rows that agree in both
    become one with their number as ``copies``; ``mark`` tells vectors of one id apart."""
    v = F.col(vector).cast("array<double>")
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    rows = rows.filter(F.col("vec_id").isNotNull() & ~bad & some)
    counted = rows.groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies"))
    return counted.withColumn("mark", F.xxhash64("vector"))


def fit(vectors: DataFrame, k: int, recall: float, sample: int, seed: int) -> Hashing | None:
    """Fit on ``sample`` vectors at most, chosen by a hash of all ids.

    The dimension is that of most of them. The neighbour distance is such that nine in ten of
    the sample have their k-th neighbour within it; in all vectors it can only be nearer.
    """
    rows = (
        vectors.orderBy(F.xxhash64(F.lit(seed), F.col("vec_id")), "vec_id", "mark")
        .limit(sample)
        .collect()
    )
    if not rows:
        return None
    dims = [len(r["vector"]) for r in rows]
    dim = max(set(dims), key=lambda d: (dims.count(d), -d))
    x = _unit(np.array([r["vector"] for r in rows if len(r["vector"]) == dim], float))
    base = x[:512]
    near = 1.4
    if len(x) > k:
        gaps = np.sqrt(np.maximum(0, 2 - 2 * base @ x.T))
        near = float(np.quantile(np.partition(gaps, k, axis=1)[:, k], 0.9))
    near = min(max(near, 0.05), 2.0)
    rng = np.random.default_rng(seed)
    width = 0.75 * near
    return Hashing(
        dim,
        near,
        width,
        1 - (1 - recall) ** (1 / TABLES),
        rng.standard_normal((TABLES, dim, PROJECTIONS)),
        rng.uniform(0, width, (TABLES, PROJECTIONS)),
    )


def _unit(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, keepdims=True)  # squares of huge or tiny numbers overflow
    x = x / largest
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of rows, in double precision, the same for equal rows wherever they stand."""
    a, b = (v / np.abs(v).max(axis=1, keepdims=True) for v in (a, b))
    return (a * b).sum(axis=1) / (
        np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    )


@dataclass(frozen=True)
class Block:
    """Queries that are searched together: their vectors, and id, mark and copies of each."""

    raw: np.ndarray
    rows: np.ndarray  # queries x 3

    def is_own(self, query: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Whether vectors found (id, mark, ...) are the queries' own."""
        return (self.rows[query, :2] == found[:, :2]).all(axis=1)


class Nearest:
    """The k best candidates of each query so far: id, mark and number of rows, and cosine."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.least = k, np.full(queries, -np.inf)
        self.held, self.waiting = 0, []
        self.query = np.zeros(0, np.int64)
        self.found, self.score = np.zeros((0, 3), np.int64), np.zeros(0)

    def hold(self, query: np.ndarray, at: np.ndarray, rough: np.ndarray) -> None:
        """Candidates of the vectors at hand, with their rough cosine."""
        self.waiting.append((query, at, rough))
        self.held += len(query)

    def weigh(self, block: Block, own_raw: np.ndarray, own: np.ndarray) -> None:
        """Take in the held candidates that are not beaten by others, by exact cosine.

        ``own``: id, mark and copies of the vectors at hand. A query is no candidate of itself.
        """
        if not self.held:
            self.waiting = []
            return
        query, at, rough = (np.concatenate(x) for x in zip(*self.waiting))
        self.held, self.waiting = 0, []
        # tables find a pair twice; a pair stays if fewer than k others are surely before it
        order = np.lexsort([at, query])
        order = order[np.append(True, (np.diff(query[order]) != 0) | (np.diff(at[order]) != 0))]
        query, at, rough = query[order], at[order], rough[order]
        by_score = np.lexsort([-rough, query])
        first = np.searchsorted(query[by_score], query[by_score])
        kth = np.minimum(first + self.k - 1, len(by_score) - 1)
        bound = np.where(query[by_score][kth] == query[by_score], rough[by_score][kth], -np.inf)
        stay = by_score[rough[by_score] >= bound - 1e-9]
        for part in range(0, len(stay), 1 << 16):
            q, a = query[stay[part : part + (1 << 16)]], at[stay[part : part + (1 << 16)]]
            found = own[a]
            found[:, 2] -= block.is_own(q, found)
            self.add(q, found, _cosine(block.raw[q], own_raw[a]))

    def add(self, query: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        query = np.concatenate([self.query, query])
        found = np.concatenate([self.found, found])
        score = np.concatenate([self.score, score])
        order = np.lexsort([found[:, 1], found[:, 0], -score, query])
        query, found, score = query[order], found[order], score[order]
        fresh = np.ones(len(query), bool)  # both tables may find a pair
        fresh[1:] = (query[1:] != query[:-1]) | (found[1:] != found[:-1]).any(axis=1)
        query, found, score = query[fresh], found[fresh], score[fresh]
        first = np.searchsorted(query, query)
        kept = np.arange(len(query)) - first < self.k
        self.query, self.found, self.score = query[kept], found[kept], score[kept]
        last = np.arange(len(query)) - first == self.k - 1
        self.least[query[last]] = score[last]


def met(
    cells: np.ndarray, visitors: np.ndarray, own: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries that visit a cell and the vectors that lie there, cell by cell.

    ``cells``: the visited cells, ascending, next to their ``visitors``; ``own``: the vectors' cells.
    """
    order = np.argsort(own, kind="stable")
    here, first = np.unique(own[order], return_index=True)
    low, high = np.searchsorted(cells, here), np.searchsorted(cells, here, "right")
    ends = np.append(first[1:], len(own))
    for k in np.flatnonzero(high > low).tolist():
        yield visitors[low[k] : high[k]], order[first[k] : ends[k]]


def _search(held, k: int, everything: bool):
    """Vectors -> the k nearest of a task's own vectors for each query of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, rows, fields = held.value
        block, hashing = Block(raw, rows), Hashing(*fields)
        unit = _unit(raw)
        if getattr(held, "_tables", None) is None and not everything:
            tables = []
            for t in range(TABLES):
                cells, queries = hashing.probes(unit, t)
                order = np.argsort(cells, kind="stable")
                tables.append((cells[order], queries[order]))
            held._tables = tables
        best = Nearest(len(rows), k)
        for batch in batches:
            lists = batch.column(1)
            fits = pa.compute.list_value_length(lists).to_numpy(False) == hashing.dim
            named = np.stack([batch.column(c).to_numpy(False)[fits] for c in (0, 3, 2)], axis=1)
            if not len(named):
                continue
            flat = lists.filter(pa.array(fits)).flatten().to_numpy(False)
            every = flat.reshape(-1, hashing.dim)
            for first in range(0, len(every), _ROWS):
                own_raw, own_rows = every[first : first + _ROWS], named[first : first + _ROWS]
                own = _unit(own_raw)
                if everything:
                    meetings = [(np.arange(len(rows)), np.arange(len(own)))]
                else:
                    meetings = chain.from_iterable(
                        met(*held._tables[t], hashing.cells(np.floor(hashing.places(own, t))))
                        for t in range(TABLES)
                    )
                for asking, there in meetings:
                    # a rough cosine leaves out what cannot be among the best; the rest is exact
                    rough = unit[asking] @ own[there].T
                    query, at = np.nonzero(rows[asking, :1] == own_rows[there, 0])
                    itself = block.is_own(asking[query], own_rows[there[at]])
                    itself &= own_rows[there[at], 2] == 1  # of more rows the others are candidates
                    rough[query[itself], at[itself]] = -np.inf
                    least = best.least[asking]
                    if len(there) > k:
                        least = np.maximum(least, -np.partition(-rough, k - 1, axis=1)[:, k - 1])
                    hopeful = (rough >= least[:, None] - 1e-9) & (rough > -np.inf)
                    query, at = np.nonzero(hopeful)
                    best.hold(asking[query], there[at], rough[query, at])
                    if best.held > _HELD:
                        best.weigh(block, own_raw, own_rows)
                best.weigh(block, own_raw, own_rows)
        if len(best.query):
            columns = [*rows[best.query].T, *best.found.T, best.score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], FOUND.names)

    return run


def _merge(found: DataFrame, k: int) -> DataFrame:
    """Ranks from 1 to ``k``; a vector of several rows takes as many ranks."""
    order = Window.partitionBy("query_id", "query_mark").orderBy(F.desc("score"), "vec_id", "mark")
    first = found.distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    first = first.withColumn("before", F.coalesce(F.sum("times").over(earlier), F.lit(0)))
    last = F.least(F.col("before") + F.col("times"), F.lit(k))
    ranks = F.explode(F.sequence((F.col("before") + 1).cast("int"), last.cast("int")))
    return first.filter(F.col("before") < k).select(
        "query_id", "query_mark", "query_copies", ranks.alias("rank"), "vec_id", "score"
    )


def _block_search(
    vectors: DataFrame, block: Block, hashing: Hashing, k: int, everything: bool
) -> DataFrame:
    spark = vectors.sparkSession
    fields = tuple(getattr(hashing, name) for name in hashing.__dataclass_fields__)
    held = spark.sparkContext.broadcast((block.raw, block.rows, fields))
    rows = vectors.select("vec_id", "vector", "copies", "mark").mapInArrow(
        _search(held, k, everything), FOUND
    )
    return stored(spark, _merge(rows, k), "neighbours")


def nearest(
    embeddings: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    recall: float = 0.98,
    block: int = 2048,
    sample: int = 4096,
    seed: int = 41,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found.

    Nearest is largest cosine of the original vectors, ties to the smaller id, rank from 1. A
    query's candidates are all rows of ``embeddings`` but its own. Rows without an id, and
    vectors that are NULL, zero, hold NULL or non-finite components or are of another length than
    most, take no part on either side. A query that its cells give fewer than ``k`` candidates
    goes on to visit all cells, so it has fewer only where there are fewer. Rows may repeat an id:
    each is a query or a candidate of its own, and only the query's own row, one of those equal to
    it, is no candidate. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    vectors = stored(spark, usable(embeddings, vec_id, vector), "vectors")
    hashing = fit(vectors, k, recall, sample, seed)
    schema = "query_id long, rank int, vec_id long, score double"
    if hashing is None:
        return spark.createDataFrame([], schema)
    asked = usable(queries, vec_id, vector).filter(F.size("vector") == hashing.dim)
    asked = stored(spark, asked, "queries")
    blocks = max(1, -(-asked.count() // block))
    found = None
    for b in range(blocks):
        turn = F.pmod(F.xxhash64("vec_id", "mark"), F.lit(blocks)) == b
        rows = asked.filter(turn).collect()
        if not rows:
            continue
        own = Block(
            np.array([r["vector"] for r in rows], float),
            np.array([(r["vec_id"], r["mark"], r["copies"]) for r in rows], np.int64),
        )
        part = _block_search(vectors, own, hashing, k, False)
        counts = {r[:2]: r[2] for r in part.groupBy("query_id", "query_mark").count().collect()}
        few = [n for n, r in enumerate(rows) if counts.get((r["vec_id"], r["mark"]), 0) < k]
        if few:
            rest = Block(own.raw[few], own.rows[few])
            full = _block_search(vectors, rest, hashing, k, True)
            again = full.select("query_id", "query_mark").distinct()
            part = part.join(again, ["query_id", "query_mark"], "left_anti").unionByName(full)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema)
    for_each = F.explode(F.array_repeat(F.lit(0), F.col("query_copies").cast("int")))
    return found.select("query_id", "rank", "vec_id", "score", for_each.alias("_")).drop("_")
