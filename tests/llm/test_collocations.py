"""Phrases against counting them one by one; tries that burst and spill."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from llm_data import DOCS, awkward, awkward_rows, no_docs

from reelstar.llm import collocations as co


def plain_counts(rows):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in (1, 2, 3, 4):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    return counts, n


def plain(rows, min_count=30, pct=80, top=2000):
    counts, n = plain_counts(rows)
    out = set()
    for lang, of in counts.items():
        cand = {p: a for p, a in of.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in cand.items():
            if any(
                len(q) > len(p) and 100 * f >= pct * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, f in cand.items()
            ):
                continue
            cuts = [(2000000 * a // (of[p[:k]] + of[p[k:]]), k, of[p[:k]], of[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


def texts(seed=3, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "É", "é", "a\x00b", "new", "york", "city", "x" * 50, "to", "be", "or", "not"]
    weights = [8, 3, 6, 2, 2, 1, 4, 4, 4, 1, 3, 3, 3, 3]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! ", "\x0b", "; "]
    rows = []
    for i in range(n):
        text = "".join(w + rng.choice(ends) for w in rng.choices(words, weights, k=rng.randint(0, 80)))
        text += rng.choice(["", "new york city hall", "to be or not to be.", "new york"])
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und", "a b"]), "s", 0))
    return rows


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return {tuple(r) for r in df.collect()}


def test_against_counting(spark):
    rows = texts(n=1200)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    want = plain([(r[1], r[2]) for r in rows])
    assert len(want) > 50 and found(co.collocations(docs)) == want
    few = plain([(r[1], r[2]) for r in rows], 5, 60, 7)
    assert found(co.collocations(docs, min_count=5, inside_pct=60, top=7)) == few


def test_awkward_documents(spark):
    want = plain([(r[1], r[2]) for r in awkward_rows()])
    assert want and found(co.collocations(awkward(spark, clash=True))) == want
    assert co.collocations(no_docs(spark)).count() == 0
    assert co.collocations(awkward(spark).filter("doc_id = 205")).count() == 0


def counted(rows, lengths, pairs=None):
    """Runs of one task, added up as Spark does."""
    class Held:
        value = pairs

    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([r[2] or "und" for r in part], pa.string()), pa.array([r[1] for r in part], pa.string())],
            ["lang", "text"],
        )
        for part in (rows[i : i + 7] for i in range(0, len(rows), 7))
    ]
    total, sizes = Counter(), []
    for run in co._counting(lengths, None if pairs is None else Held)(iter(batches)):
        sizes.append(run.num_rows)
        for lang, phrase, n in zip(*(c.to_pylist() for c in run.columns)):
            total[lang, phrase] += n
    return total, sizes


def test_tries_that_burst_and_spill(monkeypatch):
    rng = random.Random(8)
    rows = texts(5, 60) + [
        (i, " ".join(f"w{rng.randint(0, 400)}" for _ in range(300)), rng.choice("xyz"), "s", 0) for i in range(60)
    ]
    plain_of, n = plain_counts([(r[1], r[2]) for r in rows])
    want = {(lang, " ".join(p)): c for lang, of in plain_of.items() for p, c in of.items()}
    short = {k: c for k, c in want.items() if len(k[1].split(" ")) < 3} | {(lang, ""): c for lang, c in n.items() if c}
    long = {k: c for k, c in want.items() if len(k[1].split(" ")) > 2}
    open_map = b"\xff" * 64
    whole = counted(rows, (1, 2))
    assert whole[0] == short and counted(rows, (3, 4), open_map)[0] == long
    monkeypatch.setattr(co, "ENTRIES", 2000)
    monkeypatch.setattr(co, "SEGMENT", 97)
    monkeypatch.setattr(co, "_STARTS", 50)
    monkeypatch.setattr(co.HatTrie.__init__, "__defaults__", (64,))
    spilt = counted(rows, (1, 2))
    assert spilt[0] == short and len(spilt[1]) > len(whole[1])
    assert counted(rows, (3, 4), open_map)[0] == long


def test_no_frequent_pair_is_kept_back(spark):
    rows = [("en", f"a{i} b{i * 7 % 50}", 40) for i in range(500)]
    bits = np.frombuffer(co._pair_map(spark.createDataFrame(rows, "lang string, phrase string, n long")), np.uint8)
    language = co.Language("en", (3, 4))
    for _, phrase, _ in rows:
        text = f"{phrase} {phrase}".encode()
        list(language.feed(text, bits))
        assert (np.unpackbits(bits).mean()) < 0.1
    first = [
        co.xxhash.xxh64_intdigest(w.encode(), language.seed) for _, p, _ in rows for w in p.split()
    ]
    at = co.pair_bits(np.array(first[::2], np.uint64), np.array(first[1::2], np.uint64), 8 * len(bits))
    assert ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all()


def test_trie_sizes():
    rng = np.random.default_rng(1)
    trie, total = co.HatTrie(2, 32, burst=50), Counter()
    for _ in range(20):
        keys = (rng.integers(1, 40, 300) << 32 | rng.integers(0, 60, 300)).astype(np.uint64)
        total.update(keys.tolist())
        trie.add(keys)
    assert trie.size == len(total) and len(trie.root.words) > 5
    seen = Counter()
    for keep in (len(total) // 2, 0):
        for keys, counts in trie.spill(keep):
            assert (keys[1:] > keys[:-1]).all()
            assert not set(keys.tolist()) & set(seen)
            seen.update(dict(zip(keys.tolist(), counts.tolist())))
        assert trie.size == len(total) - len(seen) <= keep
    assert seen == total
