"""Small tables with everything that may go wrong in a row."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns an operator may add or use inside; an input may have them already
CLASHES = (
    "size", "score", "lang_pred", "lang_rejected", "source_size", "target", "copies", "taken",
    "fp", "digest", "licence", "n_lines", "lines_removed", "_mark", "_text", "_source", "_d", "_h",
    "_id", "_hash", "_order", "_tie", "_kept",
)

WORDS = {
    "en": "the house and a river with many small stones under that old bridge where children play",
    "de": "das haus und ein fluss mit vielen kleinen steinen unter der alten brücke wo kinder spielen",
}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choices(WORDS[lang].split(), k=n))


def awkward_rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        text = sentence(rng, lang, rng.randint(1, 80))
        rows.append((i, text, lang, f"s{i % 4}" if i % 3 else "hot", len(text)))
    copy = sentence(rng, "en", 50)
    rows += [(100 + i, copy, "en", "hot", len(copy)) for i in range(30)]  # a group of copies
    rows += [rows[0], rows[0]]  # repeated rows
    rows += [
        (200, None, "en", "s1", None),
        (201, "", None, None, 0),
        (202, " \n\t ", "de", None, 3),
        (203, "1234 !!! ###", None, "s2", 12),
        (None, sentence(rng, "en", 20), "en", None, None),
        (None, None, None, None, None),
        (None, copy, None, "s3", None),
        (204, sentence(rng, "de", 60_000), "de", "s1", None),  # very long
        (205, "x" * 300_000, "en", "s1", None),
    ]
    return rows


def awkward(spark, clash: bool = False):
    df = spark.createDataFrame(awkward_rows(), DOCS).repartition(3)
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    return df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
