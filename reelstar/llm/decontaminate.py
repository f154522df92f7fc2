"""Benchmark decontamination under edit distance.

A document is contaminated by an item when some stretch of its words is within a small edit
distance of the item. The CGK embedding turns edits into substitutions: a walk over the words
puts out the current word at each step and moves on or stays by a random bit of step and word.
After an edit two walks soon fall into step again, so texts at a small edit distance get
embeddings at a small Hamming distance, which bit sampling finds: a band is a hash of a few
random steps, and near embeddings agree on some band. Walks and bands are repeated until the
target recall is reached. What agrees on a band is then compared with the item exactly.

Windows are as long as the items, up to a factor of one and a half: items are put in classes by
length. A document's windows begin at every fourth word and an item's at every word, so that
some window of a passage meets one of the item's wherever it stands. Windows that hold too few
pairs of neighbouring words of any item, for all the edits allowed, are passed over before they
are embedded. Items too short for edits are looked up whole, by a hash of their words.

The benchmark is cut into blocks of bounded size. All documents are read once for each block,
and only the block's index is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import bounded_batches, packed
from reelstar.llm.words import WordHasher, mixed
from reelstar.session import stored

STRIDE = 4
_SHORTEST = 5
_GROWTH = 1.5
_BANDS = 6
_SAMPLES = 4
_FILTER_BITS = 18
_CHUNK = 1 << 14
_PAIR_BITS = 23
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Walk:
    """One random walk: steps, and what is sampled at them. ``samples[j]``: (slot, factor)."""

    factor: int
    steps: int
    samples: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    slots: int = 0


def window_class(words: int) -> int:
    """Window length for items of so many words: the largest of a geometric row that leaves
    room for every place a window may begin at."""
    size = _SHORTEST
    while math.ceil(size * _GROWTH) <= words - STRIDE + 1:
        size = math.ceil(size * _GROWTH)
    return size


def make_walk(seed: int, sizes: list[int]) -> Walk:
    rng = np.random.default_rng([29, seed])
    odd = lambda: int(rng.integers(1 << 62)) * 2 + 1
    reach = [math.ceil(1.5 * size) for size in sizes]
    walk = Walk(odd(), max(reach), slots=len(sizes) * _BANDS)
    for k, steps in enumerate(reach):
        for band in range(_BANDS):
            for j in rng.choice(steps, _SAMPLES, replace=False):
                walk.samples.setdefault(int(j), []).append((k * _BANDS + band, odd()))
    return walk


def embed(tokens: np.ndarray, starts: np.ndarray, walk: Walk) -> np.ndarray:
    """Band hashes, slots x starts. ``tokens`` goes on past every start by the walk's steps."""
    words = mixed(tokens * np.uint64(walk.factor))
    at = starts.copy()
    sums = np.zeros((walk.slots, len(starts)), np.uint64)
    word, scratch = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
    one = np.uint64(1)
    for j in range(walk.steps):
        np.take(words, at, out=word, mode="clip")
        for slot, factor in walk.samples.get(j, ()):
            np.multiply(word, np.uint64(factor), out=scratch)
            sums[slot] += scratch
        if j and j % 64 == 0:  # the bits of a word are used up
            words = mixed(words)
            np.take(words, at, out=word, mode="clip")
        np.right_shift(word, np.uint64(j % 64), out=scratch)
        np.bitwise_and(scratch, one, out=scratch)
        at += scratch.view(np.int64)
    return sums


@dataclass
class Index:
    """A block of items: their words, the walks, and the band hashes of their windows."""

    ids: list
    words: list[np.ndarray]
    edits: list[int]
    walks: list[Walk]
    # for each walk and slot: ascending hashes, and the item and offset of each
    tables: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]
    # for each class of windows: size, and pairs of item words that a window has at least
    least: list[tuple[int, int]]
    # bit map of the hashes of the items' pairs of neighbouring words
    pairs: np.ndarray
    # items too short for edits: for each number of words, ascending hashes and the item of each
    short: dict[int, tuple[np.ndarray, np.ndarray]]


def _windows(words: list[np.ndarray], sizes: list[int]) -> tuple[np.ndarray, ...]:
    """Words with padding, and item, offset, place and class number of every item window."""
    pad = np.zeros(math.ceil(1.5 * max(sizes)) + 1, np.uint64)
    tokens, found, place = [], [], 0
    for item, own in enumerate(words):
        size = window_class(len(own))
        last = max(len(own) - size, STRIDE - 1)
        for offset in range(last + 1):
            found.append((item, offset, place + offset, sizes.index(size)))
        tokens += [own, pad]
        place += len(own) + len(pad)
    return np.concatenate(tokens), *np.array(found, np.int64).T


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """A copy with so many words replaced, dropped or put in."""
    out = words.tolist()
    for _ in range(edits):
        at, kind = int(rng.integers(len(out))), int(rng.integers(3))
        new = [] if kind == 1 else [int(rng.integers(1, 1 << 63))]
        out[at : at + (kind < 2)] = new
        out = out or [1]
    return np.array(out, np.uint64)


def repeats_needed(
    words: list[np.ndarray], edits: list[int], recall: float, tries: int = 6
) -> dict[int, int]:
    """For each class of windows, the walks after which an item with all its allowed edits is
    found with the target recall.

    The chance that one walk finds a copy is measured on edited copies of the items themselves.
    """
    rng = np.random.default_rng(31)
    sizes = sorted({window_class(len(w)) for w in words})
    need = {}
    for size in sizes:
        own = [k for k, w in enumerate(words) if window_class(len(w)) == size]
        picks = [own[k % len(own)] for k in range(max(48, min(len(own), 192)))]
        base = [words[k] for k in picks]
        copies = [edited(words[k], edits[k], rng) for k in picks]
        seen = np.zeros(len(picks))
        for t in range(tries):
            walk = make_walk(1000 + t, [size])
            hashes = []
            for texts, first, step in ((base, None, 1), (copies, rng, STRIDE)):
                pad = np.zeros(walk.steps + 1, np.uint64)
                tokens = np.concatenate([x for w in texts for x in (w, pad)])
                place, rows = 0, []
                for w in texts:
                    begin = 0 if first is None else int(first.integers(STRIDE))
                    places = np.arange(begin, max(len(w) - size, STRIDE - 1) + 1, step) + place
                    rows.append(places)
                    place += len(w) + len(pad)
                flat = embed(tokens, np.concatenate(rows), walk)
                hashes.append(np.split(flat, np.cumsum([len(r) for r in rows])[:-1], axis=1))
            for k, (a, b) in enumerate(zip(*hashes)):
                seen[k] += any(np.isin(a[s], b[s]).any() for s in range(walk.slots))
        # the mean over copies of what is missed after r walks, for the least r that will do
        p = seen / tries
        p = np.clip(p, 0.25 / tries, 1 - 0.25 / tries)
        r = 1
        while ((1 - p) ** r).mean() > 1 - recall:
            r += 1
        need[size] = r
    return need


def neighbour_pairs(words: np.ndarray) -> np.ndarray:
    """Place in the bit map of every word and the next."""
    return (mixed(words[:-1] * _FACTOR + words[1:]) >> np.uint64(64 - _PAIR_BITS)).view(np.int64)


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of so many words."""
    total = np.zeros(max(0, len(words) - length + 1), np.uint64)
    for k in range(length):
        total = total * _FACTOR + words[k : k + len(total)]
    return mixed(total)


def least_pairs(size: int, words: int, edits: int) -> int:
    """Pairs of the item's neighbouring words in a window of a passage within the edits.

    An edit makes two pairs at most that are not the item's. Windows are taken up to the end of
    a passage that edits have made shorter, and may reach beyond it.
    """
    beyond = max(0, size + STRIDE - 1 - (words - edits))
    return size - 1 - 2 * edits - beyond


def build_index(
    items: list[tuple[object, str]], max_edit: float, min_words: int, recall: float
) -> Index | None:
    """Index of a block of items, or nothing if none of them has a word."""
    hasher = WordHasher(characters=True)
    kept = [(i, hasher.of([t.encode()])[0]) for i, t in items]
    kept = [(i, w) for i, w in kept if len(w)]
    if not kept:
        return None
    ids, words = [i for i, _ in kept], [w for _, w in kept]
    edits = [int(max_edit * len(w) + 1e-9) for w in words]
    short = {}
    for length in {len(w) for w in words if len(w) < min_words}:
        own = [k for k, w in enumerate(words) if len(w) == length]
        hashes = np.concatenate([run_hashes(words[k], length) for k in own])
        order = np.argsort(hashes)
        short[length] = hashes[order], np.array(own)[order]
    long = [k for k, w in enumerate(words) if len(w) >= min_words]
    need = repeats_needed([words[k] for k in long], [edits[k] for k in long], recall) if long else {}
    pairs = np.zeros(1 << _PAIR_BITS, np.bool_)
    for k in long:
        pairs[neighbour_pairs(words[k])] = True
    least = [
        (size, min(least_pairs(size, len(words[k]), edits[k]) for k in long if window_class(len(words[k])) == size))
        for size in sorted(need)
    ]
    walks, tables = [], []
    for r in range(max(need.values(), default=0)):
        sizes = [size for size in sorted(need) if need[size] > r]
        walk = make_walk(r, sizes)
        own = [k for k in long if window_class(len(words[k])) in sizes]
        tokens, item, offset, place, kind = _windows([words[k] for k in own], sizes)
        sums = embed(tokens, place, walk)
        slots = []
        for slot in range(walk.slots):
            mine = kind == slot // _BANDS
            hashes, whose, where = sums[slot][mine], np.array(own)[item[mine]], offset[mine]
            order = np.argsort(hashes)
            slots.append((hashes[order], whose[order], where[order]))
        walks.append(walk)
        tables.append(slots)
    return Index(ids, words, edits, walks, tables, least, np.packbits(pairs), short)


def hopeful(tokens: np.ndarray, starts: np.ndarray, index: Index) -> np.ndarray:
    """The starts whose window, of one of the classes, holds the pairs that it needs."""
    own = neighbour_pairs(tokens)
    known = (index.pairs[own >> 3] >> (7 - (own & 7)).astype(np.uint8)) & 1
    sums = np.concatenate([[0], np.cumsum(known, dtype=np.int32)])
    keep = np.zeros(len(starts), np.bool_)
    for size, least in index.least:
        keep |= sums[np.minimum(starts + size - 1, len(own))] - sums[starts] >= least
    return starts[keep]


def candidates(
    tokens: np.ndarray, starts: np.ndarray, index: Index
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows that agree with one of an item's on a band: start, item, offset in the item."""
    shift = np.uint64(64 - _FILTER_BITS)
    filters = getattr(index, "filters", None)
    if filters is None:
        filters = []
        for slots in index.tables:
            row = np.zeros((len(slots), 1 << _FILTER_BITS), np.bool_)
            for k, (hashes, _, _) in enumerate(slots):
                row[k, hashes >> shift] = True
            filters.append(row)
        index.filters = filters
    for walk, slots, maybe in zip(index.walks, index.tables, filters):
        for at in range(0, len(starts), _CHUNK):
            part = starts[at : at + _CHUNK]
            sums = embed(tokens[part[0] : part[-1] + walk.steps + 1], part - part[0], walk)
            for slot, (hashes, whose, where) in enumerate(slots):
                own = sums[slot]
                few = np.flatnonzero(np.take(maybe[slot], (own >> shift).view(np.int64)))
                low = np.searchsorted(hashes, own[few])
                high = np.searchsorted(hashes, own[few], "right")
                width = high - low
                if not width.any():
                    continue
                ends = np.cumsum(width)
                row = np.arange(ends[-1]) - np.repeat(ends - width, width)
                row += np.repeat(low, width)
                yield np.repeat(part[few], width), whose[row], where[row]


class Pattern:
    """An item made ready for comparison."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words.tolist()
        self.places: dict[int, int] = {}
        for k, w in enumerate(self.words):
            self.places[w] = self.places.get(w, 0) | 1 << k

    def may_be_within(self, edits: int, words: list[int]) -> bool:
        """False if more of the item's words than can be edited do not occur at all."""
        have = set(words)
        return sum(w in have for w in self.words) >= len(self.words) - edits


def nearest_stretch(item: Pattern, words: list[int]) -> tuple[int, int]:
    """Least edit distance between the item and any stretch of the words, and where it ends.

    The bit-parallel form of the dynamic programme, with a free begin.
    """
    n, places = len(item.words), item.places
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, end = n, 0
    for k, w in enumerate(words):
        equal = places.get(w, 0)
        across = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(across | plus))
        down = plus & across
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        held = equal | minus
        plus = down | (full & ~(held | up))
        minus = up & held
        if score < best:
            best, end = score, k + 1
    return best, end


def short_leaks(
    hashes: np.ndarray, begins: np.ndarray, index: Index
) -> Iterator[tuple[int, int, int, int, int]]:
    """Leaks of the items that are looked up whole: the first of each text and item."""
    for length, (known, whose) in index.short.items():
        runs = run_hashes(hashes, length)
        low, high = np.searchsorted(known, runs), np.searchsorted(known, runs, "right")
        at = np.flatnonzero(high > low)
        text = np.searchsorted(begins, at, "right") - 1
        inside = at + length <= begins[text + 1]
        seen = set()
        for place, d in zip(at[inside].tolist(), text[inside].tolist()):
            for i in whose[low[place] : high[place]].tolist():
                same = np.array_equal(index.words[i], hashes[place : place + length])
                if same and (d, i) not in seen:
                    seen.add((d, i))
                    yield d, i, 0, place - int(begins[d]) + length, length


def leaks_in(
    texts: list[bytes], index: Index, hasher: WordHasher
) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, edits, last word of the passage, words of the item) of every leak."""
    hashes, begins = hasher.of(texts)
    yield from short_leaks(hashes, begins, index)
    if not index.walks:
        return
    reach = max(w.steps for w in index.walks) + 2
    tokens = np.concatenate([hashes, np.zeros(reach, np.uint64)])
    starts = np.concatenate(
        [np.arange(a, b, STRIDE) for a, b in zip(begins[:-1], begins[1:])] or [begins[:0]]
    )
    starts = hopeful(tokens, starts, index)
    if not len(starts):
        return
    found = list(candidates(tokens, starts, index))
    if not found:
        return
    start, item, offset = (np.concatenate(x) for x in zip(*found))
    doc = np.searchsorted(begins, start, "right") - 1
    # where the item would begin; windows of one passage agree on it up to their edits
    rows = np.unique(np.stack([doc, item, (start - offset)], 1), axis=0)
    if getattr(index, "patterns", None) is None:
        index.patterns = [Pattern(w) for w in index.words]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    covered: dict[tuple[int, int], int] = {}
    for d, i, at in rows.tolist():
        own, edits = index.words[i], index.edits[i]
        if covered.get((d, i), -1) >= at or best.get((d, i), (1, 0))[0] == 0:
            continue
        low = max(begins[d], at - edits)
        high = min(begins[d + 1], at + len(own) + 3 * edits + STRIDE)
        covered[d, i] = at + edits  # a passage that begins up to here lies within
        words, pattern = hashes[low:high].tolist(), index.patterns[i]
        if not pattern.may_be_within(edits, words):
            continue
        distance, end = nearest_stretch(pattern, words)
        if distance <= edits and distance < best.get((d, i), (edits + 1, 0))[0]:
            best[d, i] = distance, int(low - begins[d]) + end
    for (d, i), (distance, end) in best.items():
        yield d, i, distance, end, len(index.words[i])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_edit: float = 0.2,
    min_words: int = 8,
    recall: float = 0.98,
    block_items: int = 20_000,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``edits``, ``last_word`` and ``item_words`` of every leak found.

    A leak is a document and an item of which some stretch of the document's words is within
    ``max_edit`` times the item's words in edit distance over words; words are runs of letters
    and digits, ASCII letters in any case, and single characters of scripts written without blanks.
    Every leak reported is exact; one with all its allowed edits is found with probability
    ``recall``, one without edits always. ``last_word`` is the number of words up to its end. Each
    pair is reported once for each row of the document; repeated rows of an item once. Items
    under ``min_words`` words allow no edits; an item of one common word is held by many texts,
    so leave such items out of the benchmark if that is not meant. NULL or empty texts contain nothing and are nothing to search for; an empty
    table on either side gives no rows. Ids may be NULL.
    """
    spark = docs.sparkSession
    bounded_batches(spark, 256)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.filter(F.col("text").isNotNull())
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    items = items.filter(F.col("text").isNotNull()).distinct()
    id_types = dict(rows.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    schema = (
        f"doc_id {id_types[0]}, item_id {id_types[1]}, edits int, last_word int, item_words int"
    )
    found = None
    for block in _blocks(items, block_items):
        index = build_index(block, max_edit, min_words, recall)
        if index is None:
            continue
        held = spark.sparkContext.broadcast(_plain(index))
        part = stored(spark, rows.mapInArrow(_search(held), schema), "leaks")
        found = part if found is None else found.unionByName(part)
        held.unpersist()
    if found is None:
        return spark.createDataFrame([], schema)
    return found


def _blocks(items: DataFrame, size: int) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of bounded number, each read by a job of its own."""
    n = items.count()
    blocks = -(-n // size)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    for k in range(blocks):
        rows = items.filter(place == k).collect() if blocks > 1 else items.collect()
        yield sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, str(r[0]), r[1]))


def _plain(index: Index) -> tuple:
    walks = [(w.factor, w.steps, w.samples, w.slots) for w in index.walks]
    return index.ids, index.words, index.edits, walks, index.tables, index.least, index.pairs, index.short


def _search(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if getattr(held, "_index", None) is None:
            ids, words, edits, walks, *rest = held.value
            held._index = Index(ids, words, edits, [Walk(*w) for w in walks], *rest)
        index, hasher = held._index, WordHasher(characters=True)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            at, n = 0, len(texts)
            sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
            while at < n:  # about a megabyte at a time
                end = at + 1 + int(np.searchsorted(np.cumsum(sizes[at + 1 :]), 1 << 20))
                part = texts[at:end].to_pylist()
                leaks = list(leaks_in(part, index, hasher))
                if leaks:
                    doc, item, edits, last, words = zip(*leaks)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array([at + d for d in doc])),
                            pa.array([index.ids[i] for i in item]),
                            pa.array(edits, pa.int32()),
                            pa.array(last, pa.int32()),
                            pa.array(words, pa.int32()),
                        ],
                        ["doc_id", "item_id", "edits", "last_word", "item_words"],
                    )
                at = end

    return run


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents without a leak, with their own columns; rows without an id are matched by
    their text."""
    rows = packed(docs, id=doc_id, text=options.pop("text", "text"))
    marked = rows.withColumn("mark", F.xxhash64("id", "text"))
    found = contaminated(marked, benchmark, doc_id="mark", **options)
    leaky = found.select(F.col("doc_id").alias("mark")).distinct()
    return marked.join(leaky, "mark", "left_anti").select("_row.*")
