"""Token alignment against sets of byte ranges, and the matrices it is made of."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from conftest import SMALL
from llm_data import awkward, awkward_rows, no_docs
from tokenizers import Tokenizer

from reelstar.llm import alignment
from reelstar.llm.queries import llm_queries

FOLDER = Path(alignment.TOKENIZERS)
ODD = [
    (1, "plain words, and  two  blanks"), (2, None), (3, ""), (4, " "), (5, "<s> <|endoftext|> </s> <0x41>"),
    (6, "日本語のテキスト 🙂 e\u0301 \u3000 x\x00y\r\n\ttab"), (7, "▁ is a mark"), (8, "ﬁ ½ Ⅷ"), (9, "a"), (9, "a"),
    (None, "no id"), (10, "it's we'll 've 12345  \n\n end  "),
]


def byte_characters():
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    table, more = {chr(b): b for b in shown}, 256
    for b in range(256):
        if b not in shown:
            table[chr(more)] = b
            more += 1
    return table


def plain(rows):
    """Rows of the contract's query, from the libraries' own encoders and ranges of bytes."""
    whole = Tokenizer.from_file(str(FOLDER / alignment.TOKENIZER_A))
    whole.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=str(FOLDER / alignment.TOKENIZER_B))
    table, encoded, links_of, total = byte_characters(), [], [], Counter()
    for _, text in rows:
        want = (" " + (text or "")).encode()
        a = whole.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pieces.encode(text or "")
        bytes_a = [bytes(table[c] for c in whole.id_to_token(i)) for i in a]
        bytes_b = [
            bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i)
            else pieces.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            a = b = bytes_a = bytes_b = []
        ranges = []
        for side in (bytes_a, bytes_b):
            ends = np.cumsum([len(x) for x in side]).tolist()
            ranges.append(list(zip([0, *ends[:-1]], ends)))
        links = [
            (a[i], b[j])
            for i, (x, y) in enumerate(ranges[0])
            for j, (u, v) in enumerate(ranges[1])
            if x < v and u < y
        ]
        shared = {y for _, y in ranges[0]} & {y for _, y in ranges[1]}
        groups, low = [], 0
        for end in sorted(shared):
            mine = [[i for i, (x, y) in zip(ids, r) if low <= x and y <= end] for ids, r in zip((a, b), ranges)]
            groups.append(mine)
            low = end
        encoded.append((a, b, groups))
        links_of.append(links)
        total.update(links)
    highest = {}
    for (_, b), n in total.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for (doc_id, _), (a, b, groups), links in zip(rows, encoded, links_of):
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((
            doc_id, len(a), len(b), len(groups), len(links),
            sum(total[x] == highest[x[1]] for x in links), sum(total[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if a else "",
        ))
    return Counter(out)


def digests(df):
    from pyspark.sql import functions as F

    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    shown = df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)
    return Counter(tuple(r) for r in shown.collect())


@pytest.mark.parametrize("block", [alignment.BLOCK, 50])
def test_against_ranges(spark, block):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").repartition(2)
    assert digests(alignment.align(docs, block=block)) == plain(ODD)


def test_query_against_ranges(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1] or "") < 3000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert digests(alignment.align(docs)) == plain(rows)
    query = llm_queries()["op11_alignment"](spark, SMALL)
    assert query.columns[-1] == "groups_sha256"
    assert query.filter("n_links < greatest(n_a, n_b) OR n_groups > least(n_a, n_b)").count() == 0
    assert query.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_awkward_documents(spark):
    found = alignment.align(awkward(spark, clash=True)).collect()
    assert len(found) == len(awkward_rows())
    long = next(r for r in found if r["doc_id"] == 205)  # one word of 300,000 letters
    assert long["n_groups"] >= 1 and long["n_links"] >= max(long["n_a"], long["n_b"])
    assert all(r["groups"] == "" and r["n_a"] == 0 for r in found if r["doc_id"] in (200, 201))
    assert alignment.align(no_docs(spark)).count() == 0


def test_both_libraries_agree():
    """Ids are merge ranks in the given vocabulary, so the faster library stands in for the other."""
    source = (FOLDER / alignment.TOKENIZER_A).read_bytes()
    fast = alignment.ByteLevel(source)
    whole = Tokenizer.from_buffer(source)
    whole.encode_special_tokens = True
    rng = random.Random(4)
    letters = "ab eé's\n\t 12٣,.!<|>ßÄ日本🙂\u00a0\u2028\u0301\u200d\x00x"
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(3000)]
    texts += [t for _, t in ODD if t]
    slow = [e.ids for e in whole.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert fast.encode(texts) == slow


def test_product_against_dense():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.random((rng.integers(1, 9), 7)) < 0.4, rng.random((7, rng.integers(1, 9))) < 0.4
        csr = lambda m: (np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1])
        rows, columns, values = alignment.product(csr(a), csr(b))
        dense = np.zeros((len(a), b.shape[1]), int)
        dense[rows, columns] = values
        assert (dense == a.astype(int) @ b.astype(int)).all() and (values > 0).all()
        begins, index = alignment.transposed(*csr(b), b.shape[1])
        back = np.zeros((b.shape[1], 7), bool)
        back[np.repeat(np.arange(b.shape[1]), np.diff(begins)), index] = True
        assert (back == b.T).all()
