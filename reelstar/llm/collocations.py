"""Phrase collocations, counted with HAT-tries.

A task counts the phrases of its texts in a trie over word ids: a hash container holds packed
phrases until it is too large, then bursts into a node that branches on the next word, with a
container for each. When the tries of a task outgrow their bound, whole subtrees leave as
sorted runs, the largest first. Spark deals the runs to prefix partitions, by the first word of a
phrase and, as one word may begin a third of all phrases, by a few bits of the whole of it; there
they are merged into the counts of the corpus.

Texts are read twice: for words and pairs, then for phrases of three and four words, which can be
frequent only where their pairs are. The frequent pairs go to the tasks as a bit map of bounded
size. It may let others through, never keep one back, so counts are exact at any size; a corpus
whose frequent pairs fill the map only sends more runs.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelstar.llm.common import bounded_batches
from reelstar.llm.words import mixed
from reelstar.session import stored

LONGEST = 4  # words of a phrase
BURST = 1 << 14  # entries of a container that bursts
ENTRIES = 1 << 20  # phrases and words that a task holds
SEGMENT = 1 << 20  # bytes of text at a time
BITS_A_PAIR, MOST_BITS = 16, 1 << 28
_BLOCK = 1 << 15  # bits of one row of the map
_STARTS = 1 << 14  # a slice of starts has fewer words than 16 bits can number

# ASCII letters in lower case; every mark that ends a piece is a full stop, a tab is a blank
_FORM = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\x0a\x0b\x0c\x0d\x09",
    b"abcdefghijklmnopqrstuvwxyz......... ",
)
_END = b"."


class Node:
    """A branch of a trie: a subtree for each word that has many phrases here, and one container
    that the other words share."""

    def __init__(self, shared: Counter, limit: int) -> None:
        self.words = np.zeros(0, np.uint64)  # ascending; the packed words down to this one
        self.below: list[Counter | Node] = []
        self.shared, self.limit = shared, limit


class HatTrie:
    """Counts of phrases, each packed as ``depth`` word ids of ``bits`` bits in one number.

    A container that is beyond ``burst`` phrases bursts: words with a sixteenth of that or more
    get a container of their own, and one that outgrows its bound bursts in turn at the next
    word. A shared container of rare words only may double before it is looked through again.
    """

    def __init__(self, depth: int, bits: int, burst: int = BURST) -> None:
        self.depth, self.bits, self.burst = depth, bits, burst
        self.root = Node(Counter(), burst)
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self._add(self.root, keys, 0)

    def _word(self, keys: np.ndarray, level: int) -> np.ndarray:
        return keys >> np.uint64(self.bits * (self.depth - 1 - level))

    def _add(self, node: Counter | Node, keys: np.ndarray, level: int) -> Counter | Node:
        if isinstance(node, Counter):
            self._count(node, keys)
            if len(node) <= self.burst or level == self.depth - 1:
                return node
            node = Node(node, self.burst)
            self._burst(node, level)
            return node
        if len(node.words):
            word = self._word(keys, level)
            at = np.minimum(np.searchsorted(node.words, word), len(node.words) - 1)
            own = node.words[at] == word
            order = np.argsort(at[own], kind="stable")
            below, numbers = keys[own][order], at[own][order]
            cuts = np.flatnonzero(numbers[1:] != numbers[:-1]) + 1
            for part, n in zip(np.split(below, cuts), numbers[np.append(0, cuts)] if len(below) else ()):
                node.below[n] = self._add(node.below[n], part, level + 1)
            keys = keys[~own]
        self._count(node.shared, keys)
        if len(node.shared) > node.limit:
            self._burst(node, level)
        return node

    def _count(self, container: Counter, keys: np.ndarray) -> None:
        before = len(container)
        container.update(keys.tolist())
        self.size += len(container) - before

    def _burst(self, node: Node, level: int) -> None:
        keys, counts = _sorted([_arrays(node.shared)])
        word = self._word(keys, level)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        many = np.diff(np.append(first, len(keys))) >= max(2, self.burst // 16)
        new = []
        for low, high in zip(first[many], np.append(first[1:], len(keys))[many]):
            new.append(Counter(dict(zip(keys[low:high].tolist(), counts[low:high].tolist()))))
        rare = ~np.isin(word, word[first[many]])
        node.shared = Counter(dict(zip(keys[rare].tolist(), counts[rare].tolist())))
        words = np.concatenate([node.words, word[first[many]]])
        below, order = node.below + new, np.argsort(words)
        node.words, node.below = words[order], [below[k] for k in order]
        node.limit = max(self.burst, 2 * len(node.shared))

    def spill(self, keep: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out whole subtrees, the largest first, until ``keep`` phrases or fewer are left."""
        root, left, taken, parts, size = self.root, self.size, set(), [], 0
        trees = [root.shared, *root.below]
        sizes = [_size(t) for t in trees]
        for k in sorted(range(len(trees)), key=lambda k: -sizes[k]):
            if left <= keep or not sizes[k]:
                break
            left -= sizes[k]
            size += sizes[k]
            taken.add(k)
            parts += _gather(trees[k])
            if size > self.burst:  # small subtrees share a run
                yield _sorted(parts)
                parts, size = [], 0
        if parts:
            yield _sorted(parts)
        self.root = Node(Counter() if 0 in taken else root.shared, root.limit)
        stay = [k for k in range(len(root.below)) if k + 1 not in taken]
        self.root.words, self.root.below = root.words[stay], [root.below[k] for k in stay]
        self.size = left


def _arrays(counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    n = len(counts)
    return np.fromiter(counts.keys(), np.uint64, n), np.fromiter(counts.values(), np.int64, n)


def _sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    return keys[order], counts[order]


def _size(node: Counter | Node) -> int:
    if isinstance(node, Counter):
        return len(node)
    return len(node.shared) + sum(map(_size, node.below))


def _gather(node: Counter | Node) -> list[tuple[np.ndarray, np.ndarray]]:
    """All phrases of a subtree, by container; they differ."""
    if isinstance(node, Counter):
        return [_arrays(node)]
    return [_arrays(node.shared), *(part for below in node.below for part in _gather(below))]


def pair_bits(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Place of pairs of word hashes in a map of so many bits, a power of two."""
    pair = mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)
    return (mixed(pair) >> np.uint64(65 - bits.bit_length())).astype(np.int64)


class Language:
    """The phrases of one language that a task has seen and not yet sent."""

    def __init__(self, lang: str, lengths: Sequence[int]) -> None:
        self.lang, self.lengths = lang, lengths
        self.depth = max(lengths)
        self.bits = 64 // self.depth
        self.trie = HatTrie(self.depth, self.bits)
        self.seed = xxhash.xxh64_intdigest(lang.encode())
        self.n_words = 0
        self._forget()

    def _forget(self) -> None:
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__  # a new word gets the next number
        self.ids[_END] = 0
        self.hashes = np.zeros(1, np.uint64)
        self.words: list[bytes] = [b""]
        self.single = np.zeros(1, np.int64)  # counts of single words
        self.short: np.ndarray = np.zeros(1, np.int64)  # ids of 16 bits, of words that may count
        self.long: list[int] = [0]

    @property
    def size(self) -> int:
        return self.trie.size + len(self.words)

    def feed(self, text: bytes, pairs: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """Count a text, cut between words; phrases across a cut are counted with what follows."""
        text = text.translate(_FORM)
        at, before = 0, []
        while at < len(text):
            end = min(at + SEGMENT, len(text))
            if end < len(text):
                cut = max(text.rfind(b" ", at, end), text.rfind(_END, at, end)) + 1
                if cut <= at:  # a word longer than a segment
                    ends = [x for x in (text.find(b" ", end), text.find(_END, end)) if x >= 0]
                    cut = min(ends, default=len(text))
                end = cut
            tokens = text[at:end].replace(_END, b" . ").split()
            yield from self._count(before + tokens, len(before), pairs)
            before = (before + tokens)[1 - LONGEST :]
            at = end

    def _count(self, tokens: list[bytes], done: int, pairs: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if len(self.words) > ENTRIES // 2:
            yield from self.empty()
        ids = np.array(list(map(self.ids.__getitem__, tokens)), np.int64)
        if len(self.ids) > len(self.words):
            self.words += islice(self.ids, len(self.words), None)
        self.n_words += int(np.count_nonzero(ids[done:]))
        real = ids != 0
        if pairs is None:
            self.single.resize(len(self.words))
            self.single += np.bincount(ids[done:], minlength=len(self.words))
            begins = np.flatnonzero(real[:-1] & real[1:])
            begins = begins[begins + 2 > done]
            self.trie.add((ids[begins] << 32 | ids[begins + 1]).astype(np.uint64))
            return
        if len(self.words) > len(self.hashes):
            new = [xxhash.xxh64_intdigest(w, self.seed) for w in self.words[len(self.hashes) :]]
            self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
            self.short = np.concatenate([self.short, np.zeros(len(new), np.int64)])
        if len(ids) < 3:
            return
        own = self.hashes[ids]
        place = pair_bits(own[:-1], own[1:], 8 * len(pairs))
        maybe = (pairs[place >> 3] >> (place & 7).astype(np.uint8)) & 1
        pair = maybe.astype(bool) & real[:-1] & real[1:]
        three = pair[:-1] & pair[1:]
        four = three[:-1] & pair[2:]
        for length, found in ((3, three), (4, four)):
            begins = np.flatnonzero(found)
            begins = begins[begins + length > done]
            for low in range(0, len(begins), _STARTS):
                yield from self._add_long(ids, begins[low : low + _STARTS], length)

    def _add_long(self, ids: np.ndarray, begins: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
        """Count phrases of three or four words, by word ids of 16 bits."""
        words = ids[begins[:, None] + np.arange(length)]
        new = np.unique(words[self.short[words] == 0])
        if len(self.long) + len(new) > 1 << self.bits:
            yield from self.runs(0)
            self.short[:], self.long = 0, [0]
            new = np.unique(words)
        self.short[new] = np.arange(len(self.long), len(self.long) + len(new))
        self.long += new.tolist()
        keys = np.zeros(len(words), np.uint64)
        for k in range(length):
            shift = np.uint64(self.bits * (self.depth - 1 - k))
            keys |= self.short[words[:, k]].astype(np.uint64) << shift
        self.trie.add(keys)

    def runs(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Subtrees as sorted runs of phrases and counts."""
        words = None
        mask = np.uint64((1 << self.bits) - 1)
        for keys, counts in self.trie.spill(keep):
            if words is None:
                words = pa.array(self.words, pa.binary()).cast(pa.string())
                if self.depth == LONGEST:
                    words = words.take(pa.array(self.long))
            columns = [
                (keys >> np.uint64(self.bits * (self.depth - 1 - k))) & mask for k in range(self.depth)
            ]
            for length in self.lengths:
                if length == 1:
                    continue  # counted beside the trie
                own = columns[length - 1] != 0
                if length < self.depth:
                    own &= columns[length] == 0
                if not own.any():
                    continue
                parts = [words.take(pa.array(c[own].astype(np.int64))) for c in columns[:length]]
                yield self.batch(pc.binary_join_element_wise(*parts, " "), pa.array(counts[own]))

    def empty(self) -> Iterator[pa.RecordBatch]:
        """Send all phrases and begin anew with no words."""
        yield from self.runs(0)
        self.single[0] = 0  # ends of pieces are no words
        seen = np.flatnonzero(self.single)
        if len(seen):
            words = pa.array([self.words[k] for k in seen], pa.binary()).cast(pa.string())
            yield self.batch(words, pa.array(self.single[seen]))
        self._forget()

    def batch(self, phrases: pa.Array, counts: pa.Array) -> pa.RecordBatch:
        lang = pa.array([self.lang], pa.string()).take(pa.array(np.zeros(len(counts), np.int64)))
        return pa.RecordBatch.from_arrays([lang, phrases, counts], ["lang", "phrase", "n"])


def _counting(lengths: Sequence[int], held=None):
    """Rows (lang, text) -> runs (lang, phrase, n). The phrase '' has the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = None if held is None else np.frombuffer(held.value, np.uint8)
        seen: dict[str, Language] = {}
        for batch in batches:
            langs, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for lang in pc.unique(langs).to_pylist():
                own = texts.filter(pc.equal(langs, lang)).to_pylist()
                if lang not in seen:
                    seen[lang] = Language(lang, lengths)
                yield from seen[lang].feed(_END.join(own), pairs)
                if sum(s.size for s in seen.values()) > ENTRIES:
                    for s in sorted(seen.values(), key=lambda s: -s.size):
                        if sum(x.size for x in seen.values()) <= ENTRIES // 2:
                            break
                        if len(s.words) > s.trie.size:
                            yield from s.empty()
                        else:
                            yield from s.runs(s.trie.size // 4)
        for s in seen.values():
            yield from s.empty()
            if pairs is None and s.n_words:
                yield s.batch(pa.array([""]), pa.array([s.n_words]))

    return run


def _merged(runs: DataFrame, min_count: int) -> DataFrame:
    """Counts of the corpus, of the frequent phrases; runs meet in prefix partitions."""
    first = F.xxhash64("lang", F.substring_index("phrase", " ", 1))
    prefix = F.pmod(first + F.pmod(F.xxhash64("phrase"), F.lit(64)), F.lit(1 << 30)).cast("int")
    dealt = runs.withColumn("prefix", prefix).repartition("prefix")
    counts = dealt.groupBy("prefix", "lang", "phrase").agg(F.sum("n").alias("n"))
    return counts.filter((F.col("n") >= min_count) | (F.col("phrase") == "")).drop("prefix")


def _pair_map(pairs: DataFrame) -> bytes:
    """Bit map of the pairs: 16 bits for each, so one in 16 others passes, 32 MB at most."""
    n = pairs.count()
    bits = min(MOST_BITS, max(_BLOCK, 1 << (BITS_A_PAIR * n).bit_length()))

    @F.arrow_udf("long")
    def place(langs: pa.Array, phrases: pa.Array) -> pa.Array:
        seeds = {x: xxhash.xxh64_intdigest(x.encode()) for x in pc.unique(langs).to_pylist()}
        found = np.zeros((2, len(phrases)), np.uint64)
        for k, (lang, phrase) in enumerate(zip(langs.to_pylist(), phrases.to_pylist())):
            found[:, k] = [xxhash.xxh64_intdigest(w, seeds[lang]) for w in phrase.encode().split()]
        return pa.array(pair_bits(found[0], found[1], bits))

    placed = pairs.select(place("lang", "phrase").alias("at"))
    rows = placed.groupBy(F.floor(F.col("at") / _BLOCK).alias("block")).agg(
        F.bitmap_construct_agg(F.pmod("at", F.lit(_BLOCK))).alias("bits")
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in rows.toLocalIterator():  # 8192 rows of 4 kB at most
        at = row["block"] * (_BLOCK // 8)
        out[at : at + _BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()


def _exact(left: str, factor: int) -> Column:
    """A product of counts, which may pass 64 bits."""
    return F.expr(f"CAST({factor} AS decimal(38,0)) * {left}")


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = 30) -> DataFrame:
    """``lang``, ``phrase``, ``n`` and ``words`` of every phrase of one to four words that occurs
    ``min_count`` times in its language; the phrase of no words has the number of all words."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text")
    ).filter("text IS NOT NULL")
    schema = "lang string, phrase string, n long"
    short = stored(spark, _merged(rows.mapInArrow(_counting((1, 2)), schema), min_count), "short-phrases")
    held = spark.sparkContext.broadcast(_pair_map(short.filter("instr(phrase, ' ') > 0")))
    long = stored(spark, _merged(rows.mapInArrow(_counting((3, 4), held), schema), min_count), "long-phrases")
    held.unpersist()
    words = F.expr("IF(phrase = '', 0, length(phrase) - length(replace(phrase, ' ', '')) + 1)")
    return short.unionByName(long).withColumn("words", words)


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    min_count: int = 30,
    inside_pct: int = 80,
    top: int = 2000,
) -> DataFrame:
    """The best phrases of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``
    and ``score``.

    A text is cut into pieces at ``. , ; : ! ?`` and line ends, a piece into words at blanks and
    tabs; A-Z count as a-z. ``a`` is how often a phrase of two to four words occurs, overlaps
    included, ``l`` and ``r`` the same of its two parts at the cut that scores least (of equal ones
    the first), ``n`` all words of the language, ``score`` the whole part of
    ``2000000 * a / (l + r)``. Phrases under ``min_count`` are no candidates, and a candidate goes
    that lies in a longer one occurring ``inside_pct`` per cent as often or more. Ranks are by
    score, then count, then phrase; ``top`` is the feature, nothing else is cut off.

    A NULL language is ``und``. NULL and empty texts hold no words; a word may be of any length.
    Repeated rows count as often as they come. No documents, or no candidates, give no rows.
    """
    counts = stored(docs.sparkSession, phrase_counts(docs, lang, text, min_count), "phrases")
    phrases = counts.filter("words >= 1").select("lang", "phrase", "n")
    of_all = counts.filter("words = 0").select("lang", F.col("n").alias("of_lang"))
    candidates = counts.filter("words >= 2").select(
        "lang", "phrase", F.split("phrase", " ").alias("w"), F.col("n").alias("a")
    )

    def part(begin: Column, length: Column) -> Column:
        return F.array_join(F.slice("w", begin, length), " ")

    inner = (
        candidates.filter("size(w) > 2")
        .select("lang", "a", "w", F.explode(F.expr("sequence(2, size(w) - 1)")).alias("m"))
        .select("lang", "a", "w", "m", F.explode(F.expr("sequence(1, size(w) - m + 1)")).alias("at"))
        .groupBy("lang", part(F.col("at"), F.col("m")).alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    inside = F.coalesce(_exact("longer", 100) >= _exact("a", inside_pct), F.lit(False))
    kept = candidates.join(inner, ["lang", "phrase"], "left").filter(~inside)
    cuts = kept.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        part(F.lit(1), F.col("k")).alias("first"),
        part(F.col("k") + 1, F.size("w")).alias("rest"),
    )
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("CAST((CAST(2000000 AS decimal(38,0)) * a) div (l + r) AS long)")
    best = scored.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(of_all, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("of_lang").alias("n"), "score",
    )
