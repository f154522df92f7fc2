"""SimHash near-duplicates, found with BK-trees.

A fingerprint is the bitwise majority of the hashes of a document's word shingles. Two documents
are linked when their fingerprints differ in few bits; a group is what links connect.

The search runs over different fingerprints, so copies cost nothing. A fingerprint is cut into
``radius + 1`` bands: two fingerprints within the radius agree on one band at least, so each band
value is a shard, and the shard's fingerprints form one BK-tree. Children are keyed by their
integer Hamming distance to the parent, and a search follows only edges within the radius of its
own distance. The trees are not broadcast: together they are as large as the corpus. Instead
a fingerprint goes to the shards that can hold its neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstar.llm.common import bounded_batches, packed, without
from reelstar.llm.components import connected_components
from reelstar.session import stored

SEED = 42
BITS = 64
# A shard beyond this many fingerprints is linked by single-bit variants instead of a tree.
TREE_LIMIT = 4096
_LANES = np.uint64(0x0101010101010101)


# -- fingerprints ----------------------------------------------------------------------------


def fingerprint(data: bytes, width: int = 3) -> int:
    """Majority of the XXH64 hashes of the shingles of ``width`` words, repeats included.

    A-Z count as lower case; words are parted by ASCII white space. A text of fewer words is one
    shingle; one without words has fingerprint 0.
    """
    words = data.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in more than half of the hashes."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 255):  # a byte lane holds 255 at most
        part = hashes[at : at + 255]
        for bit in range(8):
            lanes = ((part >> np.uint64(bit)) & _LANES).sum(dtype=np.uint64)
            total[bit::8] += np.frombuffer(lanes.tobytes(), np.uint8)
    bits = np.flatnonzero(2 * total > len(hashes))
    return sum(1 << int(b) for b in bits)


def with_fingerprint(docs: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """Add ``fp``, the fingerprint as a signed long; a NULL text has fingerprint 0."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        made = [fingerprint(t.as_py() or b"", width) for t in texts.cast(pa.binary())]
        return pa.array(np.array(made, np.uint64).view(np.int64))

    return without(docs, "fp").withColumn("fp", prints(F.coalesce(F.col(text), F.lit(""))))


# -- BK-trees --------------------------------------------------------------------------------


class BKForest:
    """BK-trees over several shards of fingerprints at once, held in arrays.

    Nodes are numbered as the fingerprints given. The children of a node are one block of a
    sorted array of (parent, distance) keys, so the edges within the radius of a distance are
    one range of it.
    """

    def __init__(self, prints: np.ndarray, shard: np.ndarray) -> None:
        """``shard``: the number of each fingerprint's shard, ascending. No repeats in a shard."""
        self.prints, self.shard = prints, shard
        n = len(prints)
        first = np.concatenate([[True], shard[1:] != shard[:-1]]) if n else np.zeros(0, bool)
        roots = np.flatnonzero(first)
        self.root = roots[np.cumsum(first) - 1] if n else roots
        waiting, parent = np.flatnonzero(~first), self.root[~first]
        keys, children = [], []
        while len(waiting):
            key = parent * (BITS + 1) + self._distance(waiting, parent)
            order = np.argsort(key, kind="stable")
            key, waiting = key[order], waiting[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            heads = waiting[new]
            keys.append(key[new])
            children.append(heads)
            parent = heads[np.cumsum(new) - 1][~new]  # go on below the child of that distance
            waiting = waiting[~new]
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.children = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(self.keys)
        self.keys, self.children = self.keys[order], self.children[order]

    def _distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.prints[a] ^ self.prints[b]).astype(np.int64)

    def links(self, radius: int, block: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) within the radius and in one shard, for blocks of queries."""
        for at in range(0, len(self.prints), block):
            query = np.arange(at, min(at + block, len(self.prints)))
            node = self.root[query]
            while len(query):
                distance = self._distance(query, node)
                near = distance <= radius
                yield query[near], node[near]
                base = node * (BITS + 1)
                low = np.searchsorted(self.keys, base + np.maximum(distance - radius, 0))
                high = np.searchsorted(
                    self.keys, base + np.minimum(distance + radius, BITS), "right"
                )
                width = high - low
                ends = np.cumsum(width)
                within = np.arange(ends[-1]) - np.repeat(ends - width, width)
                node = self.children[np.repeat(low, width) + within]
                query = np.repeat(query, width)

    def groups(self, radius: int) -> np.ndarray:
        """For each node the first node it is connected with by links."""
        label = np.arange(len(self.prints))

        def find(x: int) -> int:
            while label[x] != x:
                label[x] = label[label[x]]
                x = label[x]
            return x

        for query, node in self.links(radius):
            # a link that is known already changes nothing; the rest are few
            unlike = label[query] != label[node]
            for a, b in zip(query[unlike].tolist(), node[unlike].tolist()):
                a, b = find(a), find(b)
                if a != b:
                    label[max(a, b)] = min(a, b)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                return label
            label = up


def _linked(radius: int, limit: int):
    """Rows (band, key, fp) sorted by shard -> (a, b, crowded): links to a group's first member,
    or, for shards beyond the limit, the fingerprints themselves."""
    columns = ["a", "b", "crowded"]

    def batch(a: np.ndarray, b: np.ndarray, crowded: bool) -> pa.RecordBatch:
        flags = pa.array(np.full(len(a), crowded))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), flags], columns)

    def solve(shard: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        number = np.cumsum(np.concatenate([[True], shard[1:] != shard[:-1]])) - 1
        size = np.bincount(number)[number]
        forest = BKForest(prints[size > 1].view(np.uint64), number[size > 1])
        group = forest.groups(radius)
        other = group != np.arange(len(group))
        own = forest.prints.view(np.int64)
        if other.any():
            yield batch(own[other], own[group[other]], False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
        crowded = None  # the shard that is being passed on
        for rows in batches:
            shard = rows.column(0).to_numpy(zero_copy_only=False)
            fp = rows.column(1).to_numpy(zero_copy_only=False)
            if crowded is not None:
                more = shard == crowded
                if more.any():
                    yield batch(fp[more], fp[more], True)
                shard, fp = shard[~more], fp[~more]
            shards, prints = np.concatenate([shards, shard]), np.concatenate([prints, fp])
            if not len(shards):
                continue
            last = np.searchsorted(shards == shards[-1], True)  # the last shard may go on
            if last:
                yield from solve(shards[:last], prints[:last])
            shards, prints = shards[last:], prints[last:]
            if len(shards) > limit:
                crowded = shards[0]
                yield batch(prints, prints, True)
                shards, prints = shards[:0], prints[:0]
        if len(shards):
            yield from solve(shards, prints)

    return run


def fingerprint_links(prints: DataFrame, radius: int = 2, limit: int = TREE_LIMIT) -> DataFrame:
    """Links (``a``, ``b``) that connect different fingerprints ``fp`` as all pairs within the
    radius do.

    Shards are found by band and value. One holding more than ``limit`` fingerprints, as many
    near copies of one text can, would be one long task; its fingerprints are linked exactly by
    variants instead: two that differ in two bits share a fingerprint one bit from both, so
    the at most 65 holders of a variant are linked to the least of them. That serves radius 2
    and below.
    """
    if not 0 <= radius <= 2:
        raise ValueError("a radius of 0, 1 or 2 bits")
    spark = prints.sparkSession
    bands = radius + 1
    cuts = [BITS * k // bands for k in range(bands + 1)]
    shards = [
        # the band's number in the low bits keeps shards of different bands apart
        F.shiftrightunsigned(F.shiftleft("fp", BITS - high), BITS - high + low)
        * bands
        + k
        for k, (low, high) in enumerate(zip(cuts, cuts[1:]))
    ]
    if radius == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    routed = prints.select("fp", F.explode(F.array(*shards)).alias("shard")).select("shard", "fp")
    found = (
        routed.repartition("shard")
        .sortWithinPartitions("shard", "fp")
        .mapInArrow(_linked(radius, limit), "a long, b long, crowded boolean")
    )
    found = stored(spark, found, "fingerprint-links")
    near = found.filter("NOT crowded").select("a", "b")
    flips = F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(BITS)])
    variants = (
        found.filter("crowded")
        .select("a")
        .distinct()
        .select("a", F.explode(F.concat(F.array(F.lit(0)), flips)).alias("flip"))
        .select("a", F.col("a").bitwiseXOR(F.col("flip")).alias("variant"))
    )
    if radius == 1:  # a variant's holders may be two bits apart: keep those of the centre
        held = variants.filter("variant <> a")
        near_crowded = held.join(
            variants.filter("variant = a").select("variant"), "variant", "left_semi"
        ).select("a", F.col("variant").alias("b"))
    else:
        holders = variants.groupBy("variant").agg(F.collect_list("a").alias("held"))
        near_crowded = holders.filter(F.size("held") > 1).select(
            F.explode("held").alias("a"), F.array_min("held").alias("b")
        )
    return near.unionByName(near_crowded.filter("a <> b"))


# -- documents -------------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 3,
    radius: int = 2,
    limit: int = TREE_LIMIT,
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every document.

    ``component_id`` is the least document id reachable by links, the document's own included.
    Equal fingerprints are linked; texts without words (NULL, empty, white space) share
    fingerprint 0. A row without an id belongs to its component but does not name it; it is
    NULL where no row has an id. Repeated rows are kept.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    marked = with_fingerprint(keyed, "_text", width).select("doc_id", "fp")
    marked = stored(spark, marked, "fingerprints")
    prints = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = fingerprint_links(prints.select("fp"), radius, limit)
    roots = connected_components(links).withColumnRenamed("node", "fp")
    placed = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def one_per_group(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    groups: Callable[[DataFrame, str, str], DataFrame] = near_duplicates,
) -> DataFrame:
    """The documents whose id names their group, with all their columns.

    ``groups`` finds ``doc_id`` and ``component_id`` of the documents. Of rows that repeat that id
    one stays, by a hash of the text. Rows without an id stay as they are: nothing tells them
    apart, so none can be called the copy of another.
    """
    kept = groups(docs, doc_id, text).filter(F.col("doc_id") == F.col("component_id"))
    rows = packed(docs, id=doc_id, text=text)
    named = rows.join(kept.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
    of_id = Window.partitionBy("id").orderBy(F.xxhash64("text"))
    one = named.withColumn("n", F.row_number().over(of_id)).filter("n = 1")
    return one.select("_row.*").unionByName(docs.filter(F.col(doc_id).isNull()))
