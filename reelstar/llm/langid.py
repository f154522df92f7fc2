"""Language identification by compression.

Every language has a zstandard dictionary of raw sample text. A text is compressed with each of
them, and the language whose dictionary makes it smallest wins: text shares more long matches
with its own language. The margin is how much smaller it is than the runner-up; a narrow margin
means the text could be either and is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstar.llm.common import bounded_batches, packed, unpacked

UNDETERMINED = "und"
RESULT = ("lang_pred", "score", "lang_rejected")

# ASCII letters in lower case, bytes of other scripts as they are, all else a blank
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)
)
# A long text is cut into blocks, each compressed alone: within a whole long text its own earlier
# words would matter more than the dictionary.
_BLOCK = 4096
# Every block goes behind the first bytes of the language's own sample, which cost nearly nothing:
# zstandard stores a short text as it is where compression gains a few bytes only, and then all
# languages would tie.
_LEAD = 256
# Parts of a language's rows, by hash, among which its sample is sought
_PARTS = 64


@dataclass(frozen=True)
class LanguageModel:
    """Sample text per language, in the order of the languages' names."""

    langs: tuple[str, ...]
    samples: tuple[bytes, ...]


def _coders(samples: tuple[bytes, ...]) -> list[tuple[zstandard.ZstdCompressor, bytes, int]]:
    """For each language its coder, its lead, and the size of the lead alone."""
    params = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY, window_log=18, hash_log=14, chain_log=15,
        search_log=3, min_match=4, write_content_size=0,
    )
    made = []
    for sample in samples:
        words = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=params)
        coder = zstandard.ZstdCompressor(compression_params=params, dict_data=words)
        lead = sample[:_LEAD] + b" "
        made.append((coder, lead, len(coder.compress(lead))))
    return made


def _size(data: bytes, coder: zstandard.ZstdCompressor, lead: bytes, alone: int) -> int:
    blocks = [data[i : i + _BLOCK] for i in range(0, len(data), _BLOCK)]
    return max(1, sum(len(coder.compress(lead + block)) - alone for block in blocks))


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    docs_per_lang: int = 128,
    chars_per_doc: int = 500,
    max_langs: int = 256,
    seed: int = 11,
) -> LanguageModel:
    """Collect a bounded sample of each labelled language.

    The bound: the ``max_langs`` languages with the most rows, ``docs_per_lang`` different texts
    of each, chosen by a seeded hash of the text over all labelled rows, and the first
    ``chars_per_doc`` characters of each. Rows without text, letters or label teach nothing.
    Copies of a text count once. A language is cut into ``_PARTS`` parts by that hash, which give
    their least hashes first, so a language with most of the rows is no task of its own.
    """
    rows = labelled.filter(
        F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}")
    ).select(
        F.col(lang).alias("lang"),
        F.col(text).alias("text"),
        F.xxhash64(F.lit(seed), F.col(text)).alias("h"),
    )
    langs = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs)
    least = (
        rows.select("lang", "h")
        .distinct()
        .join(F.broadcast(langs.select("lang")), "lang")
        .withColumn("part", F.pmod("h", F.lit(_PARTS)))
    )
    # of a part, then of the language: the second sees _PARTS x docs_per_lang rows at most
    for keys in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("h")
        least = least.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= docs_per_lang)
    chosen = least.select("lang", "h")
    # chosen has max_langs x docs_per_lang rows at most
    found = (
        rows.join(F.broadcast(chosen), ["lang", "h"])
        .groupBy("lang", "h")
        .agg(F.min(F.substring("text", 1, chars_per_doc)).alias("text"))
        .collect()
    )
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for row in found:
        by_lang.setdefault(row["lang"], []).append((row["h"], row["text"]))
    names = sorted(by_lang)
    samples = [
        b"\n".join(t.encode().translate(_FOLD) for _, t in sorted(by_lang[name])) for name in names
    ]
    return LanguageModel(tuple(names), tuple(samples))


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", min_margin: float = 0.002
) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``lang_rejected``.

    ``score`` is the margin: one less the smallest size over the second smallest, 0 to 1. A text
    is rejected below ``min_margin``. A NULL text, one without a letter, and any text under a
    model without languages is ``und`` with score 0 and rejected. With one language only, the
    score is 1. Equal sizes go to the language first in name. Columns of the three names are
    replaced; all other columns are kept.
    """
    bounded_batches(docs.sparkSession)
    langs = model.langs
    broadcast = docs.sparkSession.sparkContext.broadcast(model.samples)
    kind = pa.struct([("pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("pred string, score double")
    def sized(texts: pa.Array) -> pa.Array:
        coders = _coders_of(broadcast)
        found = []
        for value in texts:
            data = value.as_py()
            if data is None:
                found.append(None)
                continue
            data = data.encode().translate(_FOLD)
            sizes = sorted((_size(data, *coder), k) for k, coder in enumerate(coders))
            score = 1.0 if len(sizes) == 1 else 1.0 - sizes[0][0] / sizes[1][0]
            found.append({"pred": langs[sizes[0][1]], "score": score})
        return pa.array(found, kind)

    rows = packed(docs, text=text)
    letters = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    nothing = F.lit(None).cast("struct<pred:string,score:double>")
    marked = rows.withColumn("found", sized(letters) if langs else nothing)
    pred, score = F.col("found.pred"), F.col("found.score")
    return marked.select(
        *unpacked(marked, *RESULT),
        F.coalesce(pred, F.lit(UNDETERMINED)).alias("lang_pred"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
        F.coalesce(score < min_margin, F.lit(True)).alias("lang_rejected"),
    )


def _coders_of(broadcast):
    """The coders of a model, made once in a worker."""
    if getattr(broadcast, "_coders", None) is None:
        broadcast._coders = _coders(broadcast.value)
    return broadcast._coders


def accepted(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The documents whose language is clear, with their own columns only."""
    marked = identify(packed(docs, text=text), model).filter(~F.col("lang_rejected"))
    return marked.select("_row.*")
