"""Alignment of two tokenizers by sparse matrices.

The tokens of a text and its bytes make an incidence matrix for each tokenizer, in compressed
rows (CSR): row *i* has a one for every byte of token *i*. The product ``A Bᵀ``, row by row as
Gustavson does it, has an entry wherever a token of A and one of B share bytes: an overlap link. Byte
offsets where tokens of both end cut the text into groups; the incidence of tokens and groups,
multiplied alike, links tokens that share a group. Those links are counted from the rows' sizes
and not made: a text whose tokens end nowhere together is one group, and has the product of its
token counts.

How often an id pair is linked in the corpus is counted in a second step. A text keeps its
different pairs and their multiplicities, so it is encoded once. The counts are a vector over id
pairs, which the vocabularies bound, not the corpus; it goes to the tasks in blocks of bounded
size, and each block is multiplied with the texts' pairs.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import bounded_batches
from reelstar.session import scratch_dir, stored

TOKENIZERS = "/opt/tokenizers"
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
PIECE_BYTES = 1 << 20  # text that is multiplied at a time
PAIRS = 1 << 20  # id pairs a task counts before it sends them
BLOCK = 1 << 22  # id pairs whose counts go to the tasks at once
# The pattern that parts a text before the merges of the byte-level vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# -- tokenizers ------------------------------------------------------------------------------


def _byte_of() -> dict[str, int]:
    """The byte for which each character stands in a byte-level vocabulary: printable Latin-1
    characters for themselves, the rest, in order, as characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level vocabulary; encodes a text after a blank, with no special tokens.

    Where every merge makes the next id, as it usually does, ids are merge ranks, and the faster
    of two libraries gives the same tokens from the same table.
    """

    def __init__(self, source: bytes) -> None:
        table = json.loads(source)
        vocabulary, merges = table["model"]["vocab"], table["model"]["merges"]
        byte_of = _byte_of()
        special = {vocabulary[t["content"]] for t in table["added_tokens"] if t["content"] in vocabulary}
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            spelt = number not in special and all(c in byte_of for c in token)
            self.pieces[number] = bytes(byte_of[c] for c in token) if spelt else token.encode()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        in_order = all(vocabulary.get(a + b) == 256 + k for k, (a, b) in enumerate(pairs))
        plain = table["normalizer"] is None and table["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
        }
        if in_order and plain:
            import tiktoken

            ranks = {p: k for k, p in enumerate(self.pieces) if k not in special}
            own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._encode = lambda texts: [own.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_buffer(source)
            whole.encode_special_tokens = True
            self._encode = lambda texts: [
                e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)
            ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._encode([" " + t for t in texts])


class Pieces:
    """A sentence-piece vocabulary; it puts the blank before a text itself."""

    def __init__(self, source: bytes) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=source)
        self.pieces = [self._bytes(k) for k in range(self._model.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        piece = self._model.id_to_piece(number)
        if self._model.is_byte(number):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def _tokenizer(name: str, source: bytes) -> ByteLevel | Pieces:
    return ByteLevel(source) if name.endswith(".json") else Pieces(source)


# -- sparse matrices -------------------------------------------------------------------------


def incidence(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CSR rows of tokens over bytes: where each row begins, and its columns."""
    begins = np.concatenate([[0], np.cumsum(lengths)])
    return begins, np.arange(begins[-1])


def transposed(begins: np.ndarray, columns: np.ndarray, n_columns: int) -> tuple[np.ndarray, np.ndarray]:
    """CSR of the transpose: counting sort by column."""
    rows = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    counts = np.bincount(columns, minlength=n_columns)
    return np.concatenate([[0], np.cumsum(counts)]), rows[np.argsort(columns, kind="stable")]


def product(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of a product of matrices of ones: every row of ``a`` gathers the
    rows of ``b`` that its columns name, and adds up what falls on one column."""
    (a_begins, a_columns), (b_begins, b_columns) = a, b
    width = np.diff(b_begins)[a_columns]
    rows = np.repeat(np.repeat(np.arange(len(a_begins) - 1), np.diff(a_begins)), width)
    ends = np.cumsum(width)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) - np.repeat(ends - width - b_begins[a_columns], width)
    columns = b_columns[at]
    if not total:
        return rows, columns, columns
    new = (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])
    if (rows[1:][~new] < rows[:-1][~new]).any() or ((columns[1:] < columns[:-1]) & ~(rows[1:] > rows[:-1])).any():
        order = np.lexsort([columns, rows])
        rows, columns = rows[order], columns[order]
        new = (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])
    first = np.concatenate([[0], np.flatnonzero(new) + 1])
    return rows[first], columns[first], np.diff(np.append(first, total))


def _joined(pieces: pa.Array, at: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """Chosen pieces one after another: where each begins and ends, and the bytes."""
    if not len(at):
        return np.zeros(1, np.int64), memoryview(b"")
    chosen = pieces.take(pa.array(at)).cast(pa.large_binary())
    _, ends, data = chosen.buffers()
    return np.frombuffer(ends, np.int64)[: len(at) + 1], memoryview(data or b"").cast("B")


@dataclass
class Texts:
    """Texts that both tokenizers cover, encoded: ids, token lengths and, for each text, where its
    tokens begin among them."""

    ids: tuple[np.ndarray, np.ndarray]
    lengths: tuple[np.ndarray, np.ndarray]
    begins: tuple[np.ndarray, np.ndarray]


class Encoder:
    def __init__(self, tokenizers: Sequence[ByteLevel | Pieces]) -> None:
        self.tokenizers = tokenizers
        self.pieces = [pa.array(t.pieces, pa.binary()) for t in tokenizers]
        self.lengths = [np.array([len(p) for p in t.pieces], np.int64) for t in tokenizers]
        marks = ((",", "|"), (",", ";"))
        # an id and what follows it in a list of groups: a comma, or the end of its side
        self.shown = pa.concat_arrays([
            pa.array([f"{k}{mark}" for k in range(len(t.pieces))], pa.binary())
            for t, own in zip(tokenizers, marks) for mark in own
        ])
        sizes = [len(t.pieces) for t in tokenizers]
        self.shown_at = (0, sizes[0], 2 * sizes[0], 2 * sizes[0] + sizes[1])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, Texts]:
        """Which texts have tokens, and those texts encoded."""
        whole = [b" " + t.encode() for t in texts]
        ok = np.array([len(w) > 1 for w in whole], bool)
        sides = []
        for tokenizer, pieces in zip(self.tokenizers, self.pieces):
            lists = tokenizer.encode(texts)
            begins = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            ids = np.fromiter(chain.from_iterable(lists), np.int64, begins[-1])
            # the bytes of all tokens, one after another
            ends, data = _joined(pieces, ids)
            for k, want in enumerate(whole):
                ok[k] &= data[ends[begins[k]] : ends[begins[k + 1]]] == want
            sides.append((ids, begins))
        out_ids, out_lengths, out_begins = [], [], []
        for (ids, begins), lengths in zip(sides, self.lengths):
            kept = ids[np.repeat(ok, np.diff(begins))]
            out_ids.append(kept)
            out_lengths.append(lengths[kept])
            out_begins.append(np.concatenate([[0], np.cumsum(np.diff(begins)[ok])]))
        return ok, Texts(tuple(out_ids), tuple(out_lengths), tuple(out_begins))


@dataclass
class Aligned:
    """What the matrices of some texts say. Links are in the order of the texts."""

    groups: np.ndarray  # number of groups of each text
    shared: np.ndarray  # links of tokens that share a group, of each text
    link_begins: np.ndarray  # where each text's links begin
    pairs: np.ndarray  # ids of every link, A's times the size of B's vocabulary plus B's
    shown: list[bytes]  # the groups of each text, as ``a1,a2|b1;a3|b2,b3``


def align_texts(texts: Texts, encoder: Encoder) -> Aligned:
    """Links and groups of encoded texts that lie one after another."""
    sides = [incidence(lengths) for lengths in texts.lengths]
    n_bytes = int(sides[0][0][-1])
    of_byte = transposed(*sides[1], n_bytes)
    a, b, _ = product(sides[0], of_byte)
    pairs = texts.ids[0][a] * len(encoder.lengths[1]) + texts.ids[1][b]
    link_begins = np.searchsorted(a, texts.begins[0])

    # a group ends where tokens of both do; tokens of one side in each group
    ends = np.intersect1d(sides[0][0][1:], sides[1][0][1:], assume_unique=False)
    group_of = [np.searchsorted(ends, begins[1:]) for begins, _ in sides]
    sizes = [np.bincount(g, minlength=len(ends)) for g in group_of]
    of_text = sides[0][0][texts.begins[0]]
    group_begins = np.searchsorted(ends, of_text[:-1], "right")
    group_begins = np.append(group_begins, len(ends))
    # the symbolic half of the product of both incidences: a row of A's has as many entries as
    # B has tokens in its group
    shared = np.concatenate([[0], np.cumsum(sizes[0] * sizes[1])])
    return Aligned(
        np.diff(group_begins),
        np.diff(shared[group_begins]),
        link_begins,
        pairs,
        _shown(texts, group_of, encoder),
    )


def _shown(texts: Texts, group_of: list[np.ndarray], encoder: Encoder) -> list[bytes]:
    codes = []
    for side, (ids, group) in enumerate(zip(texts.ids, group_of)):
        last = np.append(group[1:] != group[:-1], True)[: len(group)]
        inner, end = encoder.shown_at[2 * side : 2 * side + 2]
        codes.append(ids + np.where(last, end, inner))
    # both sides in one row, a group's tokens of A before those of B
    order = np.argsort(np.concatenate([2 * group_of[0], 2 * group_of[1] + 1]), kind="stable")
    ends, data = _joined(encoder.shown, np.concatenate(codes)[order])
    at = ends[texts.begins[0] + texts.begins[1]]
    # the last semicolon of a text is not part of it
    return [bytes(data[x : y - 1]) for x, y in zip(at[:-1], at[1:])]


# -- the corpus ------------------------------------------------------------------------------

_LINE = "n_a long, n_b long, n_groups long, n_links long, n_shared long, groups string, links binary"


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows of a batch in slices of about a megabyte of text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at, n = 0, len(texts)
    while at < n:
        end = at + 1 + int(np.searchsorted(np.cumsum(sizes[at + 1 :]), PIECE_BYTES))
        yield at, min(end, n)
        at = end


def _pack(pairs: np.ndarray, kind: type) -> bytes:
    """Different pairs of one text and how often each comes: gaps between sorted pairs, counts."""
    keys, counts = np.unique(pairs, return_counts=True)
    return np.concatenate([np.diff(keys, prepend=0), counts]).astype(kind).tobytes()


def _unpack(links: bytes, kind: type) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(links, kind).astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


class PairCounts:
    """How often id pairs are linked, for the texts of a task."""

    def __init__(self) -> None:
        self.size, self.waiting = 0, []

    def add(self, pairs: np.ndarray) -> None:
        found = np.unique(pairs, return_counts=True)
        self.waiting.append(found)
        self.size += len(found[0])

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*self.waiting))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.size, self.waiting = 0, []
        return keys[first], np.add.reduceat(counts[order], first)


def _encoding(held, kind: type):
    """Rows (doc_id, text) -> a line for every text, and lines (pair, n) that count id pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if getattr(held, "_encoder", None) is None:
            held._encoder = Encoder([_tokenizer(*t) for t in held.value])
        encoder, counts = held._encoder, PairCounts()
        names = ["doc_id", *[f.split(" ")[0] for f in _LINE.split(", ")], "pair", "n"]
        types = [pa.null(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.int64(), pa.int64()]

        def rows(columns: list[pa.Array], n: int, first: int) -> pa.RecordBatch:
            """Columns from the given place on; the others are NULL."""
            every = [pa.nulls(n, t) for t in types]
            every[first : first + len(columns)] = columns
            return pa.RecordBatch.from_arrays(every, names)

        def counted() -> pa.RecordBatch:
            keys, n = counts.take()
            return rows([pa.array(keys), pa.array(n)], len(keys), len(types) - 2)

        for batch in batches:
            types[0] = batch.schema.types[0]
            for low, high in _slices(batch.column(1)):
                texts = [t or "" for t in batch.column(1)[low:high].to_pylist()]
                ok, own = encoder.encode(texts)
                found = align_texts(own, encoder)
                numbers = np.zeros((5, len(texts)), np.int64)
                numbers[:, ok] = [
                    *map(np.diff, own.begins), found.groups, np.diff(found.link_begins), found.shared
                ]
                cuts = zip(found.link_begins[:-1], found.link_begins[1:])
                shown = iter([(g, _pack(found.pairs[x:y], kind)) for g, (x, y) in zip(found.shown, cuts)])
                groups, links = zip(*[next(shown) if x else (b"", b"") for x in ok])
                line = [
                    batch.column(0)[low:high], *map(pa.array, numbers),
                    pa.array(groups, pa.binary()).cast(pa.string()), pa.array(links, pa.binary()),
                ]
                yield rows(line, len(texts), 0)
                counts.add(found.pairs)
                if counts.size > PAIRS:
                    yield counted()
        if counts.size:
            yield counted()

    return run


def _weighing(held, kind: type):
    """Lines (row, links) -> the links of each text that are best for their B id, and the sum of
    the corpus counts over its links, as far as the block of pairs goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = held.value
        for batch in batches:
            out = np.zeros((2, batch.num_rows), np.int64)
            for k, links in enumerate(batch.column(1).to_pylist()):
                pairs, times = _unpack(links, kind)
                at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
                known = keys[at] == pairs
                at, times = at[known], times[known]
                out[:, k] = times[best[at]].sum(), (times * counts[at]).sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, out)], ["row", "n_best", "count_sum"]
            )

    return run


def _blocks(counts: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The counted pairs in blocks of bounded number: ascending pairs, counts, best flags."""
    blocks = -(-counts.count() // size)
    place = F.pmod(F.xxhash64("pair"), F.lit(max(1, blocks)))
    for k in range(blocks):
        rows = counts.filter(place == k).toArrow().sort_by("pair")
        if rows.num_rows:
            yield tuple(rows.column(c).to_numpy() for c in ("pair", "n", "best"))


def _kept(df: DataFrame, label: str) -> DataFrame:
    """As ``stored``, in less room: packed links are most of what this operator writes."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def align(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    folder: str = TOKENIZERS,
    a: str = TOKENIZER_A,
    b: str = TOKENIZER_B,
    shown: Callable[[Column], Column] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """How the tokens of every document by two tokenizers align; no special tokens.

    ``doc_id``; ``n_a`` and ``n_b`` count tokens, ``n_groups`` the stretches between byte offsets
    where tokens of both end, ``n_links`` pairs of token occurrences that share bytes, ``n_shared``
    pairs that share a group. An id pair's count is how many links of the corpus join it:
    ``n_best`` counts the links whose pair has the highest count of its B id, ties included,
    ``count_sum`` adds up the counts over all links. ``groups`` spells the groups as
    ``a1,a2|b1;a3|b2,b3``, or is what ``shown`` makes of that before it is stored.

    ``folder`` holds the tokenizers' files on the driver's machine. Texts that are NULL or empty,
    or that the tokens of A or B do not spell byte for byte, have no tokens: zeros and no
    groups. Repeated rows count as often as they come; other columns are not looked at. Texts of
    any length are encoded whole, about a megabyte or one text at a time. No documents give none.
    """
    spark = docs.sparkSession
    bounded_batches(spark, 256)
    sources = [(name, Path(folder, name).read_bytes()) for name in (a, b)]
    sizes = [len(_tokenizer(*s).pieces) for s in sources]
    kind = np.uint32 if sizes[0] * sizes[1] < 1 << 32 else np.uint64
    held = spark.sparkContext.broadcast(sources)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {rows.schema[0].dataType.simpleString()}, {_LINE}, pair long, n long"
    encoded = rows.mapInArrow(_encoding(held, kind), schema)
    if shown is not None:
        encoded = encoded.withColumn("groups", shown(F.col("groups")))
    encoded = _kept(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded")
    held.unpersist()
    lines = encoded.filter("pair IS NULL").drop("pair", "n")

    counts = encoded.filter("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n"))
    of_b = (F.col("pair") % sizes[1]).alias("b")
    counts = stored(spark, counts.select("pair", "n", of_b), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    marked = counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    marked = stored(spark, marked, "best-pairs")
    found = spark.createDataFrame([], "row long, n_best long, count_sum long")
    for part in _blocks(marked, block):
        held = spark.sparkContext.broadcast(part)
        weighed = lines.select("row", "links").mapInArrow(_weighing(held, kind), found.schema)
        found = found.unionByName(stored(spark, weighed, "weighed"))
        held.unpersist()
    sums = found.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return lines.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups",
    )
