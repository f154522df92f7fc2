"""Licence scan: whole texts that are a known licence, by digest.

A text is brought to a canonical form in which case, punctuation, line breaks, copyright lines
and equivalent spellings no longer differ. Its digest is then joined with the digests of known
licence texts in the same form.
"""

from __future__ import annotations

import string
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import packed, unpacked, without
from reelstar.operators.joins import lookup_join

_LINE = r"\n[^\p{L}\p{N}\n(]*"
# Rules in the order they apply, to text in ASCII lower case that begins with a line break. They
# are written so that Java and RE2 read them alike.
RULES: list[tuple[str, str]] = [
    # a line that states a copyright: the word and a mark, a year or a blank to be filled in
    (_LINE + r"(copyright[ \t]*(\(c\)|©|[0-9]{4}|<|\[|\{)|\(c\)[ \t]*[0-9]{4}|©)[^\n]*", ""),
    (_LINE + r"all rights reserved[^\p{L}\p{N}\n]*(\n|$)", "\n"),
    # what is no letter or digit parts words; two blanks, so that each word has its own on both
    # sides and a rule can take neighbouring words in one pass
    (r"[^\p{L}\p{N}]+", "  "),
    # equivalent spellings
    (r" (sub)?licence(s|d|e|es|ed|or|ors)? ", " ${1}license${2} "),
    (r"([a-z]{2}[lnrtgmdc])is(e|ed|es|er|ers|ing|ation|ations|able) ", "${1}iz${2} "),
    (r"([a-z]{3})our(s|ed|able|ing)? ", "${1}or${2} "),
    (r" (cent|met|fib)re(s)? ", " ${1}er${2} "),
    (r" (acknowledg|judg)ement(s)? ", " ${1}ment${2} "),
    (r" copyright  owner(s)? ", " copyright  holder${1} "),
    (r" whilst ", " while "),
    (r" https ", " http "),
    (r"  +", " "),
]


def canonical(text: Column) -> Column:
    """The canonical form of a text; NULL stays NULL."""
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    begun = F.concat(F.lit("\n"), folded, F.lit("\n"))
    replaced = reduce(
        lambda t, rule: F.regexp_replace(t, rule[0], rule[1].replace("${", "$").replace("}", "")),
        RULES,
        begun,
    )
    return F.trim(replaced)


def _forms(name: str, text: str) -> set[str]:
    """A licence as it is published, without its title, under its other titles, and up to the
    end of its terms, without the advice on how to apply them."""
    text = text.strip("\n")
    title, _, body = text.partition("\n\n")
    found = {text}
    if body and len(title) < 200:
        # the title's own paragraph may hold a copyright line, which does not count anyway
        found |= {body, *(f"{other}\n\n{body}" for other in TITLES.get(name, ()))}
    for end in ("END OF TERMS AND CONDITIONS", "POSSIBILITY OF SUCH DAMAGES"):
        found |= {f[: f.index(end) + len(end)] for f in found if end in f}
    return found


def known_texts() -> list[tuple[str, str]]:
    """Names and forms of the known licences: those in ``TEXTS`` and in the package's folder."""
    texts = dict(TEXTS)
    for file in sorted(FOLDER.glob("*.txt")):
        texts[file.stem] = file.read_text()
    return [(name, form) for name, text in texts.items() for form in sorted(_forms(name, text))]


def known_licences(spark) -> DataFrame:
    """``licence`` and ``digest`` of the known texts, a few for each licence."""
    rows = spark.createDataFrame(known_texts(), "licence string, text string")
    return rows.select("licence", F.md5(canonical(F.col("text"))).alias("digest"))


def scan(docs: DataFrame, text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """Add ``digest`` and ``licence``, the name of the licence that the whole text is, or NULL.

    ``known`` (``licence``, ``digest``) takes the place of the built-in texts; where it names
    one digest twice, the first name in order counts. A NULL text has neither digest nor
    licence; a text without letters or digits has the digest of the empty one and no licence
    unless that is known. Columns of the two names are replaced, all rows are kept.
    """
    table = known_licences(docs.sparkSession) if known is None else known
    table = table.groupBy("digest").agg(F.min("licence").alias("licence"))
    marked = without(docs, "digest", "licence").withColumn("digest", F.md5(canonical(F.col(text))))
    if known is not None:  # of any size: a hot digest, or none, can be split
        joined = lookup_join(packed(marked, digest="digest"), table, "digest")
        return joined.select(*unpacked(joined, "digest"), "digest", "licence")
    joined = marked.join(F.broadcast(table), "digest", "left")  # as many rows as known_texts
    return joined.select(*[c for c in marked.columns if c != "digest"], "digest", "licence")


# texts of longer licences, as their authors publish them
FOLDER = Path(__file__).parent / "licence_texts"
# Other titles that licences go by.
TITLES: dict[str, tuple[str, ...]] = {
    "MIT": ("The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"),
    "BSD-2-Clause": ("The BSD 2-Clause License", "Simplified BSD License", "BSD License"),
    "BSD-3-Clause": ("The BSD 3-Clause License", "New BSD License", "Modified BSD License", "BSD License"),
    "ISC": ("The ISC License", "ISC License (ISC)"),
    "Zlib": ("The zlib License", "zlib/libpng License"),
}
# The texts of short licences, as their authors publish them.
_WARRANTY_MIT = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
_WARRANTY_BSD = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

"""
TEXTS: dict[str, str] = {
    "MIT": """MIT License

Copyright (c) [year] [fullname]

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

"""
    + _WARRANTY_MIT,
    "BSD-2-Clause": "BSD 2-Clause License\n\nCopyright (c) [year], [fullname]\n\n"
    + _BSD_2
    + _WARRANTY_BSD,
    "BSD-3-Clause": "BSD 3-Clause License\n\nCopyright (c) [year], [fullname]\n\n"
    + _BSD_2
    + """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
    + _WARRANTY_BSD,
    "ISC": """ISC License

Copyright (c) [year] [fullname]

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
""",
    "Zlib": """zlib License

(C) 1995-2024 [fullname]

This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
""",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
}
